from __future__ import annotations

import hashlib
import re

import duckdb
import pytest

import __spark_entry__ as entry
from voltframe.llm import catalog

SF = "/root/testdata/sf0.001"
TABLES = ["documents", "benchmark", "pages", "labels"]


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_oracles_agree_on_the_smallest_tables(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    answer = db.execute(catalog.ORACLES[name])
    names = [d[0] for d in answer.description]
    want = sorted(repr(tuple(round(v, 6) if isinstance(v, float) else v for _, v in sorted(zip(names, row, strict=True)))) for row in answer.fetchall())
    frame = catalog.QUERIES[name](spark, SF)
    assert sorted(frame.columns) == sorted(names)
    got = sorted(repr(tuple(round(v, 6) if isinstance(v, float) else v for _, v in sorted(r.asDict().items()))) for r in frame.collect())
    assert got == want


def test_every_operator_is_registered_once():
    numbers = sorted(int(n[2:].split("_")[0]) for n in catalog.QUERIES)
    assert numbers == list(range(1, 11)) and {*catalog.QUERIES, "pipeline"} <= set(entry.queries())


ODD = [None, "", " \n", "x" * 70_000, "mail a@b.example or c@d.example, 10.0.0.1 and 4111 1111 1111 1111", "call +1 (743) 555-3824 now", "MIT License and CC BY, the MIT-license; GNU General Public License", "Apache License Apache License", "é 漢字 😀 ÀPACHE license"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Odd texts and the smallest documents, with a repeated row, as a table of their own."""
    place = tmp_path_factory.mktemp("odd").as_uri()
    rows = [(10_000 + i, t) for i, t in enumerate(ODD)] + [(10_004, ODD[4]), (None, ODD[5])]
    rows += [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{place}/documents.parquet")
    return place, rows


def by_row(rows):
    return sorted(map(repr, rows))


def test_personal_data_query_against_brute_force(spark, folder):
    from tests.llm.test_pii import PATTERNS, brute

    place, rows = folder
    want, base = [], {}
    for i, text in rows:
        found = brute(text or "")
        kinds = list(PATTERNS)
        joined = ",".join(f"{kinds[rank]}:{start}:{end}" for start, rank, end in found)
        want.append((i, *(sum(rank == k for _, rank, _ in found) for k in range(4)), hashlib.sha256(joined.encode()).hexdigest()))
        base[i] = set(filter(None, joined.split(",")))
    got = catalog.QUERIES["op9_pii"](spark, place).collect()
    assert by_row((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == by_row(want)
    assert all(base[r.doc_id] <= set(r.spans.split(",")) for r in got if base[r.doc_id])


def test_licence_query_against_brute_force(spark, folder):
    phrases = {("gnu", "general", "public", "license"): "gpl", ("apache", "license"): "apache", ("cc", "by"): "cc-by", ("mit", "license"): "mit"}
    place, rows = folder
    want = []
    for i, text in rows:
        words = re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        found = [(k, label) for k in range(len(words)) for p, label in phrases.items() if tuple(words[k : k + len(p)]) == p]
        at = [k for k, _ in found]
        want.append((i, len(words), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({label for _, label in found}))))
    got = catalog.QUERIES["op10_licenses"](spark, place).collect()
    assert by_row((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == by_row(want)
    assert all(0 <= r.score <= 1 and (not r.base_labels or set(r.base_labels.split(",")) <= set(r.labels.split(","))) for r in got)


def test_token_count_query_against_the_library(spark, folder):
    tokenizers, public = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
    place, rows = folder
    library = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 512) for i, t in rows]
    got = catalog.QUERIES["op7_token_counts"](spark, place).collect()
    assert by_row((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == by_row(want)
