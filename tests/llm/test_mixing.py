from __future__ import annotations

import random
import re

import pytest

from voltframe.llm import mixing


def fill(sizes, weights=mixing.WEIGHTS, share=1.5, epochs=2.0):
    """Clamp and share again until no source is above its cap."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, clamped = share * sum(sizes.values()), {s for s in names if sizes[s] == 0}
    while True:
        open_ = [s for s in names if s not in clamped]
        left, w = total - sum(epochs * sizes[s] for s in clamped), sum(weight[s] for s in open_)
        aims = {s: epochs * sizes[s] if s in clamped else left * weight[s] / w for s in names}
        over = {s for s in open_ if aims[s] > epochs * sizes[s]}
        if not over:
            return aims
        clamped |= over


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_targets_and_taken_words(spark, seed):
    rnd = random.Random(seed)
    names = ["a", "B", "é", "", "hot", None]
    rows = [(i, "w " * rnd.randint(0, 60), "hot" if rnd.random() < 0.4 else rnd.choice(names)) for i in range(400)]
    rows += [(9000, None, "empty"), (9001, "", "empty"), (7, "x " * 50, "a"), (7, "x " * 50, "a"), (None, "y z", "B")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = mixing.mix(df).collect()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    aims, taken = fill(sizes), {}
    for r in got:
        assert r["size"] == size(r["text"]) and r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - aims[r["source"]]) < 1e-6 * max(1, aims[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    assert len(got) == len(rows) and all(abs(taken[s] - aims[s]) <= 1 for s in aims)
    again = mixing.mix(df.repartition(7)).collect()
    key = lambda r: (r["doc_id"] or -1, r["text"] or "", r["source"] or "", r["taken"])
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string, target string, Size int, lang string")
    out = mixing.mix(df)
    assert out.columns == ["doc_id", "text", "source", "lang", "size", "source_size", "target", "taken"] and out.count() == 0


def test_sample_repeats_rows(spark):
    df = spark.createDataFrame([(1, "a b c d", "x"), (2, "e f", "y"), (3, "g h i j k l m n o p", "z")], "doc_id long, text string, source string")
    mixed = {r.doc_id: r.taken for r in mixing.mix(df).collect()}
    words = {}
    for r in mixing.sample(df).collect():
        assert r.repetition in (0, 1) and 0 < r.words_taken <= r["size"]
        words[r.doc_id] = words.get(r.doc_id, 0) + r.words_taken
    assert words == {k: v for k, v in mixed.items() if v}


def test_names_of_the_input_meet_none_of_the_operators(spark):
    from voltframe.llm import mixing

    names = ("_source", "_bucket", "_order", "_before", "_tie", "row", "held")
    rows = [(i, "w " * (i + 1), "ab"[i % 2], *names) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{n} string" for n in names))
    out = mixing.mix(df)
    assert out.columns == [*df.columns, *mixing.ADDED]
    plain = {r.doc_id: (r.size, r.taken) for r in mixing.mix(df.select("doc_id", "text", "source")).collect()}
    assert all(tuple(r[n] for n in names) == names and plain[r.doc_id] == (r["size"], r["taken"]) for r in out.collect())


def test_very_long_texts(spark):
    from voltframe.llm import mixing

    df = spark.createDataFrame([(1, "w " * 300_000, "a"), (2, None, "a")], "doc_id long, text string, source string")
    assert sorted((r["size"], r["taken"]) for r in mixing.mix(df).collect()) == [(0, 0), (300_000, 450_000)]
