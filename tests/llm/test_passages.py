from __future__ import annotations

import hashlib
import random
import re

import pytest

from voltframe.llm import passages
from voltframe.llm._hashing import mixed, pack, unpack, window_hashes, word_hashes


def brute(docs, n):
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in docs}
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - n + 1):
            first.setdefault(tuple(words[i][k : k + n]), i)
    out = []
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - n + 1):
            if first[tuple(w[k : k + n])] < i:
                gone |= set(range(k, k + n))
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()))
    return sorted(out)


def corpus(seed, size=60):
    rnd = random.Random(seed)
    vocab = ["a", "b", "é", "漢", "Foo", "foo,", "x\x00y"]
    shared = [[rnd.choice(vocab) for _ in range(rnd.randint(4, 30))] for _ in range(4)]
    docs = []
    for i in range(size):
        parts = []
        for _ in range(rnd.randint(0, 4)):
            parts += rnd.choice(shared) if rnd.random() < 0.5 else [rnd.choice(vocab) + str(rnd.randint(0, 99)) for _ in range(rnd.randint(0, 12))]
        docs.append((i * 3, rnd.choice([" ", "\n", "\t  "]).join(parts)))
    return docs + [(1000, None), (1001, ""), (1002, "  \n "), (-5, " ".join(shared[0]))]


def digests(df, n, shard_bytes):
    return sorted((r.row.doc_id, r.n_words, r.n_removed, r.kept) for r in passages._run(df, n, True, shard_bytes).collect())


@pytest.mark.parametrize(("seed", "shard_bytes"), [(1, 200), (2, 1 << 20), (3, 2000)])
def test_against_brute_force(spark, seed, shard_bytes):
    docs = corpus(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert digests(df, 5, shard_bytes) == brute(docs, 5)


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, n_words string, source string")
    out = passages.remove_passages(empty)
    assert out.columns == ["doc_id", "text", "source", "n_words", "n_removed"] and out.count() == 0


def test_equal_ids_and_null_ids(spark):
    text = " ".join(map(str, range(12)))
    df = spark.createDataFrame([(1, text), (1, text), (None, text), (2, text)], "doc_id long, text string")
    got = sorted((r.row.doc_id or 0, r.n_removed) for r in passages._run(df, 5, True, 50).collect())
    assert got == [(0, 0), (1, 12), (1, 12), (2, 12)]


def test_texts_that_lose_nothing_stay_as_they_are(spark):
    df = spark.createDataFrame([(1, "a  b\tc", "x"), (2, " ".join("abcdefg"), "y"), (3, " ".join("zabcdefg"), "z")], "doc_id long, text string, source string")
    got = {r.doc_id: (r.text, r.source, r.n_removed) for r in passages.remove_passages(df, 5).collect()}
    assert got == {1: ("a  b\tc", "x", 0), 2: ("a b c d e f g", "y", 0), 3: ("z", "z", 7)}


def test_hashes_follow_content_only():
    w, c = word_hashes([b"a b", b"", b"b a b"])
    assert c.tolist() == [2, 0, 3] and w[0] == w[3] and w[1] == w[2] == w[4]
    assert word_hashes([b"Ab"], fold=True)[0][0] == word_hashes([b"aB"], fold=True)[0][0] == w.dtype.type(word_hashes([b"ab"])[0][0])
    h = window_hashes(w, 2)
    assert h[0] == h[3] and len(set(h.tolist())) == 3
    values = sorted({int(x) for x in mixed(w)})
    assert unpack(pack(w.__class__((len(values),), w.dtype, buffer=__import__("array").array("Q", values)))).tolist() == values


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    from voltframe.llm import _hashing

    text = b" ".join(b"word%d" % (i % 977) for i in range(60_000))
    pieces = list(_hashing.segments(text, 1000))
    assert len(pieces) > 300 and pieces[0][0] == 0 and pieces[-1][1] == len(text)
    one = {w: word_hashes([w])[0][0] for w in set(text.split())}
    for most in (1 << 30, 1000):
        monkeypatch.setattr(_hashing, "CHUNK", most)
        monkeypatch.setattr(_hashing.segments, "__defaults__", (most,))
        monkeypatch.setattr(_hashing.chunks, "__defaults__", (most,))
        whole, count = word_hashes([text, b"x", b"", text[:50]])
        assert count.tolist() == [60_000, 1, 0, len(text[:50].split())]
        assert whole[:60_000].tolist() == [one[w] for w in text.split()]


def thue_morse(n, letters="ab"):
    return "".join(letters[bin(i).count("1") & 1] for i in range(n))


@pytest.mark.parametrize("size", [1024, 2048, 4096])
def test_words_and_windows_made_to_collide_under_polynomials(spark, size):
    one, two = thue_morse(size), thue_morse(size, "ba")
    assert len(set(word_hashes([one.encode(), two.encode()])[0].tolist())) == 2
    frame = [f"w{i}" for i in range(9)]
    docs = [(1, " ".join([*frame[:5], one, *frame[5:]])), (2, " ".join([*frame[:5], two, *frame[5:]])), (3, " ".join([*frame[:5], one, *frame[5:]]))]
    assert digests(spark.createDataFrame(docs, "doc_id long, text string"), 10, 50) == brute(docs, 10)
    # words of one letter, windows as long as the strings
    docs = [(1, " ".join(one)), (2, " ".join(two)), (3, " ".join(one))]
    assert digests(spark.createDataFrame(docs, "doc_id long, text string"), size, 50) == brute(docs, size)


def test_occurrences_are_compared_word_by_word():
    """A passage that was sent in error, as where hashes collide, removes nothing that differs."""
    automaton = passages.PassageAutomaton([(1, b"a b c d e f g h"), (7, b"p q r s t u")], 5)
    gone = lambda i, text: (lambda g: [] if g is None else g.nonzero()[0].tolist())(automaton.covered(i, text.encode().split()))
    assert gone(2, "x a b c d e y") == [1, 2, 3, 4, 5]
    assert gone(2, "x a b c d z e f g") == []
    assert gone(2, "c d e f g h") == [0, 1, 2, 3, 4, 5]
    assert gone(1, "a b c d e f") == [] and gone(7, "p q r s t u") == [] and gone(8, "q r s t u") == [0, 1, 2, 3, 4]
    # repeats of one letter: every occurrence, also those that overlap
    automaton = passages.PassageAutomaton([(1, b"a a a a a")], 5)
    assert gone(2, "a " * 7 + "b " + "a " * 4) == list(range(7))


def test_names_of_the_input_meet_none_of_the_operators(spark):
    text = " ".join(map(str, range(12)))
    df = spark.createDataFrame([(1, text, "a", 5, "b", "c", "d.e"), (2, text, "f", 6, None, "g", "h")], "doc_id long, text string, row string, shard int, kind string, data string, `x.y` string")
    out = passages.remove_passages(df, 5)
    assert out.columns == [*df.columns, "n_words", "n_removed"]
    assert sorted(map(tuple, out.collect())) == [(1, text, "a", 5, "b", "c", "d.e", 12, 0), (2, "", "f", 6, None, "g", "h", 12, 12)]


def test_more_shards_than_cuts_may_be_held():
    from voltframe.llm._common import Ranges

    class Row(dict):
        def first(self):
            return self

    class Ids:
        def agg(self, *a):
            return Row(top=1000, low=1)

        def select(self, *a):
            return Row(p=[250, 500, 750])

    assert len(Ranges(Ids(), 4_000, most=4)) == 4_000 and len(Ranges(Ids(), 4, most=10)) == 4


def test_finer_ranges_keep_the_order_of_ids(spark):
    from pyspark.sql import functions as F

    from voltframe.llm._common import Ranges

    ids = spark.range(1, 1001).select(F.col("id").alias("_id"))
    ranges = Ranges(ids, 400, most=7)
    rows = ids.select("_id", ranges.index(F.col("_id")).alias("r")).orderBy(F.desc("_id")).collect()
    numbers = [r.r for r in rows]
    assert numbers == sorted(numbers) and numbers[0] == 0 and numbers[-1] < len(ranges) and len(set(numbers)) > 300
