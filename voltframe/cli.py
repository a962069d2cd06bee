"""Command line: run a contract."""
from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import dataclass, fields

from .plans.run import DEFAULT_LIVE_METADATA, DEFAULT_METADATA, RunResult, run
from .session import build_session

#: Name, what argparse is told, what it is for. Empty values count as left out.
ARGUMENTS = (
    ("metadata", {"nargs": "?", "const": ""}, "contract file; the packaged one of the mode if left out"),
    ("output", {"default": "output"}, "folder that the run publishes"),
    ("metadata-root", {}, "folder that must hold the contract and its fixtures"),
    ("mode", {"choices": ("fixture", "live"), "default": "fixture"}, "whether live sources are read"),
    ("run-id", {}, "id of an outer orchestration; makes the output write-once"),
    ("metadata-snapshot-id", {"nargs": "?", "const": ""}, "id of the immutable contract snapshot"),
    ("output-format", {"choices": ("jsonl", "parquet"), "default": "jsonl"}, "JSON lines or partitioned tables"),
    ("with-spikes", {"action": "store_true"}, "flag price spikes and write daily metrics"),
    ("master", {}, "Spark master, if spark-submit does not set one"),
)
#: The layers that the last line names, in its order.
REPORTED = ("bronze", "silver", "quarantine", "gold")


@dataclass(frozen=True)
class Request:
    """A run as it is asked for."""

    output: str
    mode: str
    output_format: str
    with_spikes: bool
    metadata: str | None = None
    metadata_root: str | None = None
    run_id: str | None = None
    metadata_snapshot_id: str | None = None
    master: str | None = None

    @classmethod
    def read(cls, argv: Sequence[str] | None) -> Request:
        p = argparse.ArgumentParser(prog="voltframe", description="Run a metadata-driven energy data contract")
        for name, how, purpose in ARGUMENTS:
            p.add_argument(f"--{name}", help=purpose, **how)
        given = vars(p.parse_args(argv))
        return cls(**{f.name: None if given[f.name] == "" else given[f.name] for f in fields(cls)})

    def run(self) -> RunResult:
        own = self.metadata is not None  # packaged contracts lie in no root of the caller's
        packaged = {"fixture": DEFAULT_METADATA, "live": DEFAULT_LIVE_METADATA}[self.mode]
        options = {f.name: getattr(self, f.name) for f in fields(self) if f.name not in ("metadata", "output", "master")}
        return run(build_session(master=self.master), self.metadata if own else packaged, self.output, **options | ({} if own else {"metadata_root": None}))


def main(argv: Sequence[str] | None = None) -> int:
    result = Request.read(argv).run()
    shown = [f"{layer}={result[layer]}" for layer in REPORTED]
    print(f"Pipeline complete: {', '.join(shown)}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
