from __future__ import annotations

import importlib
import re
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from voltframe.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events pages".split()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    connection.execute("SET timezone = 'UTC'")
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


def shown(value):
    return round(value, 6) if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_oracles_agree(spark, db, name):
    answer = db.execute(catalog.ORACLES[name])
    names = [d[0] for d in answer.description]
    want = sorted(repr(tuple(shown(v) for _, v in sorted(zip(names, row, strict=True)))) for row in answer.fetchall())
    frame = catalog.QUERIES[name](spark, SF)
    got = sorted(repr(tuple(shown(v) for _, v in sorted(r.asDict().items()))) for r in frame.collect())
    assert sorted(frame.columns) == sorted(names) and got == want


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.count() > 0 and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_works_without_the_llm_folders(monkeypatch):
    real = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *a: None if name.startswith("voltframe.llm") or name == "corpus_pipeline" else real(name, *a))
    assert set(entry.queries()) == set(catalog.QUERIES) and set(entry.oracle_sql()) == set(catalog.ORACLES)


def test_nothing_else_imports_the_llm_folder():
    from pathlib import Path

    root = Path(catalog.__file__).parent.parent
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert not re.search(r"\bllm\b", path.read_text(encoding="utf-8")), path
    assert "voltframe.plans.catalog" in sys.modules
