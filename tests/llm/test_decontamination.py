from __future__ import annotations

import hashlib
import random
import re

import pytest

from voltframe.llm import decontamination as d

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, bench, n=10):
    windows = {}
    for item, t in bench:
        w = words(t)
        for i in range(max(1, len(w) - n + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for i, t in docs:
        w, hit, items = words(t), set(), set()
        for size in {len(k) for k in windows}:
            for k in range(len(w) - size + 1):
                found = windows.get(tuple(w[k : k + size]))
                if found is not None:
                    hit |= set(range(k, k + size))
                    items |= {str(x) for x in found if x is not None}
        out.append((i, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    return out


def corpus(seed):
    rnd = random.Random(seed)
    vocab = ["A", "b", "É", "é", "c1", "漢", "D"]
    bench = [(i, rnd.choice([" ", "-", "!\n"]).join(rnd.choice(vocab) + str(rnd.randint(0, 3)) for _ in range(rnd.choice([0, 1, 3, 9, 10, 11, 25])))) for i in range(25)]
    bench += [(900, None), (901, "..."), (None, "quite a different item of more than ten words it is indeed")]
    docs = []
    for i in range(60):
        parts = [rnd.choice(bench)[1] or "" if rnd.random() < 0.4 else " ".join(rnd.choice(vocab) + str(rnd.randint(0, 99)) for _ in range(rnd.randint(0, 15))) for _ in range(rnd.randint(0, 4))]
        docs.append((i, ". ".join(parts)))
    return [*docs, (100, None), (101, ""), (102, docs[3][1]), (102, docs[3][1])], bench


def frames(spark, docs, bench):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")


def digest(marked):
    from pyspark.sql import functions as F

    rows = marked.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256), "contaminated").collect()
    return sorted(map(tuple, rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed, monkeypatch):
    docs, bench = corpus(seed)
    assert digest(d.mark(*frames(spark, docs, bench))) == sorted(brute(docs, bench))
    monkeypatch.setattr(d, "BROADCAST_BYTES", -1)  # the way beyond the bound
    assert digest(d.mark(*frames(spark, docs, bench))) == sorted(brute(docs, bench))


def test_empty_tables(spark):
    docs, bench = frames(spark, [(1, "a b"), (None, None)], [])
    assert sorted((r.n_words, r.contaminated) for r in d.mark(docs, bench).collect()) == [(0, False), (2, False)]
    docs, bench = frames(spark, [], [(1, "a b")])
    assert d.mark(docs, bench).count() == 0


def test_actions(spark):
    bench = spark.createDataFrame([(1, "one two THREE")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "keep, One two; three! this", "x", 9), (2, "one two four", "y", 8)], "doc_id long, text string, source string, n_hit int")
    kept = d.decontaminate(docs, bench)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [(2, "one two four", "y", 8)]
    cut = {r.doc_id: r.text for r in d.decontaminate(docs.drop("n_hit"), bench, "cut").collect()}
    assert cut == {1: "keep,  ; ! this", 2: "one two four"}
    with pytest.raises(ValueError):
        d.decontaminate(docs, bench, "burn")


def test_names_of_the_input_meet_none_of_the_operators(spark):
    bench = spark.createDataFrame([(1, "one two THREE")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "One two three", 5, "r", "h"), (2, "one", 6, "s", "i")], "doc_id long, text string, _k1 int, row string, hits string")
    assert [tuple(r) for r in d.decontaminate(docs, bench).collect()] == [(2, "one", 6, "s", "i")]
    out = d.mark(docs, bench)
    assert out.columns == ["doc_id", "text", "_k1", "row", *d.ADDED]
    assert sorted((r.doc_id, r["_k1"], r["row"], r.n_hit) for r in out.collect()) == [(1, 5, "r", 3), (2, 6, "s", 0)]


def test_very_long_texts(spark):
    passage = " ".join(f"w{i}" for i in range(12))
    text = "filler word " * 100_000 + passage
    marked = d.mark(*frames(spark, [(1, text), (2, "filler word " * 10)], [(5, passage)])).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_hit) for r in marked] == [(200_012, 12), (20, 0)]


def test_a_third_of_all_rows_share_one_passage(spark):
    passage = " ".join(f"w{i}" for i in range(12))
    docs = [(i, passage if i % 3 == 0 else f"clean text number {i}") for i in range(300)]
    marked = d.mark(*frames(spark, docs, [(5, passage)]))
    assert marked.filter("contaminated").count() == 100 and marked.filter("n_hit = 12").count() == 100
