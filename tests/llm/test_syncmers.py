from __future__ import annotations

import hashlib
import random

from pyspark.sql import functions as F

from voltframe.llm import syncmers


def brute_anchors(words, k=syncmers.K, s=syncmers.S, h=hash):
    """Positions whose smallest inner s-mer is the first or the last, by definition."""
    inner = [h(tuple(words[i : i + s])) for i in range(len(words) - s + 1)]
    out = []
    for i in range(len(words) - k + 1):
        window = inner[i : i + k - s + 1]
        if min(window) in (window[0], window[-1]):
            out.append(i)
    return out


def docs_of(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def test_positions_are_closed_syncmers(spark):
    rnd = random.Random(2)
    words = [rnd.choice("abcdefgh") + str(rnd.randint(0, 40)) for _ in range(400)]
    hashed = spark.createDataFrame([(w,) for w in sorted(set(words))], "a string").select("a", F.xxhash64("a").alias("h")).collect()
    order = {(r.a,): r.h for r in hashed}
    df = docs_of(spark, [(1, " ".join(words))]).select(syncmers.anchors(F.col("text")).alias("x"))
    got = df.first().x
    assert [g.pos for g in got] == brute_anchors(words, h=lambda t: order[t])
    assert 100 < len(got) < 200


def test_equal_passages_share_anchors_wherever_they_stand(spark):
    rnd = random.Random(3)
    passage = [str(rnd.random()) for _ in range(60)]
    one, two = "x y z " + " ".join(passage), " ".join(passage) + " tail of the text"
    rows = docs_of(spark, [(1, one), (2, two)]).select(syncmers.distinct(syncmers.placed_anchors(F.col("text"))).alias("a")).collect()
    inside = set(rows[0].a) & set(rows[1].a)
    assert len(inside) >= 0.7 * min(len(rows[0].a), len(rows[1].a))


def test_pairs_against_brute_force(spark):
    rnd = random.Random(4)
    texts = {i * 7: " ".join(rnd.choice(["a", "é", "漢字", "😀", "b\n"]) + str(rnd.randint(0, 9)) for _ in range(rnd.randint(0, 40))) for i in range(500)}
    texts |= {-3: None, 10_000: "", 10_001: "x" * 5000, 10_002: "一" * 300}
    rows = list(texts.items())
    rnd.shuffle(rows)
    got = {r.doc_id: r for r in syncmers.fingerprint_pairs(docs_of(spark, rows).repartition(3)).collect()}
    ids = sorted(texts, reverse=True)
    assert len(got) == len(ids)
    prints = {}
    for i, d in enumerate(ids):
        t, following = texts[d] or "", texts[ids[(i + 1) % len(ids)]] or ""
        cut = len(t) // 3
        edited = t[: len(t) - cut] + following[:cut]
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        parts = lambda x: {x[j : j + 8] for j in range(0, len(x), 8)}
        a, b = parts(r.fingerprint), parts(r.edited_fingerprint)
        assert abs(r.near_edited - (len(a & b) / len(a | b) if a | b else 1.0)) < 1e-12
        n = parts(got[ids[(i + 1) % len(ids)]].fingerprint)
        assert abs(r.near_next - (len(a & n) / len(a | n) if a | n else 1.0)) < 1e-12
        prints.setdefault(t, set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in prints.values())


def test_small_and_odd_tables(spark):
    assert syncmers.fingerprint_pairs(docs_of(spark, [])).count() == 0
    one = syncmers.fingerprint_pairs(docs_of(spark, [(5, "a b c d e f g h i")])).first()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"a b c a b c"[:0] + ("a b c d e f g h i"[:12] + "a b c").encode()[:17]).hexdigest()
    twice = syncmers.fingerprint_pairs(docs_of(spark, [(5, "a b"), (5, "a b"), (None, "c")])).collect()
    assert sorted((r.doc_id or -1) for r in twice) == [-1, 5, 5]


def test_in_place_counts_anchors_at_the_same_places(spark):
    words = [f"w{i}" for i in range(90)]
    rows = [(2, " ".join(words)), (1, " ".join(f"v{i}" for i in range(90)))]
    r = syncmers.fingerprint_pairs(docs_of(spark, rows)).filter("doc_id = 2").first()
    found = [a.pos for a in docs_of(spark, rows[:1]).select(syncmers.anchors(F.col("text")).alias("x")).first().x]
    assert r.edited_in_place == sum(p + 5 <= 60 for p in found) / len(found) and 0.5 < r.edited_in_place < 0.7
    r = syncmers.fingerprint_pairs(docs_of(spark, [(2, "a b"), (1, None)])).collect()
    assert {x.doc_id: x.edited_in_place for x in r} == {1: 1.0, 2: 0.0}  # the text of 2 loses its only anchor


def test_passages_are_matched_by_position(spark):
    rnd = random.Random(8)
    passage = [str(rnd.random()) for _ in range(80)]
    text = lambda n, m: " ".join([*(f"x{rnd.random()}" for _ in range(n)), *passage, *(f"y{rnd.random()}" for _ in range(m))])
    docs = docs_of(spark, [(1, text(13, 4)), (2, "quite another text than that"), (3, None), (4, text(0, 9))])
    found = {(r.doc_id, r["shift"]): r for r in syncmers.passages(docs, docs_of(spark, [(7, text(5, 0)), (8, "")])).collect()}
    assert set(found) == {(1, 8), (4, -5)} and all(r.query_id == 7 for r in found.values())
    assert found[1, 8].first >= 13 and found[1, 8]["last"] <= 13 + 75 and found[1, 8].n_anchors == found[4, -5].n_anchors > 20
    assert syncmers.passages(docs.limit(0), docs).count() == 0


def test_names_of_the_input_meet_none_of_the_operators(spark):
    df = spark.createDataFrame([(i, f"a b c d e f g {i}", i, "p", "q", "t") for i in range(500)], "doc_id long, text string, _id int, place string, made string, row string")
    out = syncmers.with_next(df, {"text": lambda c: c("text")}, rows_per_range=50)
    got = {r["row"]["doc_id"]: (r["row"]["_id"], r["row"]["made"], r["next"]["text"]) for r in out.collect()}
    assert len(got) == 500 and got[7] == (7, "q", "a b c d e f g 6") and got[0][2] == "a b c d e f g 499"


def test_operator_keeps_other_columns(spark):
    df = spark.createDataFrame([(1, "a b c d e f g h", "old", "s")], "doc_id long, text string, Fingerprint string, source string")
    out = syncmers.fingerprints(df)
    assert out.columns == ["doc_id", "text", "source", "anchors", "fingerprint"]
    r = out.first()
    assert len(r.fingerprint) % 8 == 0 and r.fingerprint != "old"
