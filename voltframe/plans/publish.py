"""Publication by a pointer: an output holds versions, and a file that names the one in force.

    output/versions/<id>/...    what a run wrote, whole
    output/CURRENT              the id of the version that readers see

A version is written beside the others and comes into force when CURRENT names it: one small file,
replaced at once, on any storage. A run that fails leaves CURRENT as it was. With write-once, CURRENT
is claimed and never replaced: of runs that race for an output one wins, without locks.
"""
from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import SparkSession

from ..storage import Storage, below, uri

POINTER, VERSIONS = "CURRENT", "versions"


def published(spark: SparkSession, output: str | Path) -> str | None:
    """The folder of the version in force, or None."""
    store, pointer = Storage(spark), below(output, POINTER)
    return below(output, VERSIONS, store.read(pointer).decode()) if store.exists(pointer) else None


def _taken(store: Storage, output: str | Path) -> bool:
    place = uri(output)
    dangling = place.startswith("file:") and Path(place.removeprefix("file://")).is_symlink()
    return dangling or store.exists(output)


@contextlib.contextmanager
def version(spark: SparkSession, output: str | Path, write_once: bool = False) -> Iterator[str]:
    """A folder to write into: in force when the block ends well, removed when it does not."""
    store, name = Storage(spark), uuid.uuid4().hex
    if write_once and _taken(store, output):
        raise FileExistsError("OUTPUT_ALREADY_EXISTS")
    folder, pointer = below(output, VERSIONS, name), below(output, POINTER)
    try:
        yield folder
        if not write_once:
            store.write(pointer, name.encode())
        elif not store.claim(pointer, name.encode()):
            raise FileExistsError("OUTPUT_ALREADY_EXISTS")
    except BaseException:
        store.remove(folder)
        raise
    if not write_once:
        for other in store.names(below(output, VERSIONS)):
            if other != name:
                store.remove(below(output, VERSIONS, other))
