from __future__ import annotations

import random

import numpy as np

from voltframe.llm import quality


def corpus(n=500, seed=1):
    rnd = random.Random(seed)
    syllables = ["th", "an", "er", "on", "re", "ti", "or", "ne", "sa", "lo"]
    word = lambda: "".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 4)))
    rude = ["blargh", "snorf", "gnark"]
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rnd.randint(20, 120))]
        good, toxic = rnd.random() > 0.25, rnd.random() < 0.2
        if toxic:
            for _ in range(4):
                words[rnd.randrange(len(words))] = rnd.choice(rude)
        text = " ".join(words).capitalize() + "."
        if not good:
            text = " ".join(f"{w}###" for w in words) if rnd.random() < 0.5 else text.upper().replace(" ", "!! ")
        docs.append((i, text, "en", f"src{i % 5}", len(text)))
        if rnd.random() < 0.7:
            labels.append((i, int(good), int(toxic)))
    truth = {d[0]: None for d in docs}
    for i, (d, t) in enumerate(zip(docs, docs, strict=True)):
        truth[d[0]] = not ("###" in t[1] or "!!" in t[1]) and not any(r in t[1] for r in rude)
    return docs, labels, truth


def frames(spark, docs, labels):
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_accepts_clean_documents_and_no_others(spark):
    docs, labels, truth = corpus()
    df, marks = frames(spark, docs, labels)
    out = quality.classify(df, marks)
    assert out.columns == [*df.columns, *quality.ADDED]
    got = {r.doc_id: r for r in out.collect()}
    right = sum(got[i].accepted == truth[i] for i in truth)
    assert right >= 0.97 * len(truth)
    assert all(0 <= r.score <= 1 and abs(r.score - r.p_quality * (1 - r.p_toxic)) < 1e-9 for r in got.values())
    model, _ = quality.fit(df, marks)
    assert model.good.held_out["accuracy"] > 0.95 and model.toxic.held_out["accuracy"] > 0.9
    again = {r.doc_id: r.score for r in quality.classify(df.repartition(5), marks).collect()}
    assert all(abs(again[i] - got[i].score) < 1e-6 for i in got)


def brute_score(model, text, lang, source, n_chars):
    """The score of one document by definition, a feature at a time."""
    words = [w.lower() for w in quality.WORD.findall((text or "").lower())]
    n = len(words)
    one = [np.log1p(n), len(set(words)) / max(n, 1), sum(a == b for a, b in zip(words, words[1:], strict=False)) / max(n - 1, 1), np.log1p(sum(map(len, words)) / max(n, 1))]
    one += [float(v in words) for v in model.vocabulary]
    two = quality.metadata((text or "").encode(), lang, source, n_chars)[model.columns]
    answer = []
    for head in (model.good, model.toxic):
        logits = []
        for view, (a, b), x in zip(head.views, head.platt, (one, two), strict=True):
            z = sum(w * min(8, max(-8, (np.float32(np.float16(v)) - m) * s)) for v, m, s, w in zip(x, view.mean, view.scale, view.weight, strict=True)) + view.bias
            logits.append(a * z + b)
        c, a, b = head.combine
        answer.append(1 / (1 + np.exp(-(c + a * logits[0] + b * logits[1]))))
    return answer[0] * (1 - answer[1])


def test_scores_against_brute_force(spark):
    docs, labels, _ = corpus(200, 6)
    docs += [(900, None, None, None, None), (901, "", "en", "src1", 0), (902, "naïve É 漢字 42", "fr", None, None)]
    df, marks = frames(spark, docs, labels)
    model, _ = quality.fit(df, marks)
    got = {r.doc_id: r.score for r in quality.classify(df, marks, model=model).collect()}
    assert all(abs(got[d[0]] - brute_score(model, *d[1:])) < 1e-3 for d in docs)
    stored = {r.doc_id: r.score for r in quality.score_ids(df, marks).collect()}
    assert stored.keys() == got.keys() and all(abs(stored[i] - got[i]) < 1e-9 for i in got)


def test_odd_rows_and_tables(spark):
    docs, labels, _ = corpus(120)
    df, marks = frames(spark, [*docs, (900, None, None, None, None), (901, "", "en", "src1", 0), (901, "", "en", "src1", 0), (902, "w " * 60000, "en", "new", 120000), (903, "x" * 200_000, "en", "new", 1 << 60)], [*labels, (None, 1, 0), (900, None, None), (5, 0, 1)])
    model, features = quality.fit(df, marks)
    got = quality.classify(df, marks, model=model).collect()
    assert len(got) == features.count() == 125 and all(np.isfinite(r.score) for r in got)
    same = [r.score for r in got if r.doc_id == 901]
    assert same[0] == same[1]
    assert quality.classify(df.limit(0), marks, model=model).count() == 0
    assert quality.score_ids(df.limit(0), marks).count() == 0 and quality.classify(df.limit(0), marks).columns == [*df.columns, *quality.ADDED]


def test_names_of_the_input_meet_none_of_the_operators(spark):
    docs, labels, _ = corpus(60)
    df, marks = frames(spark, docs, labels)
    more = df.selectExpr("*", "1 AS _text", "'r' AS row", "2 AS h", "doc_id AS _lang", "'x' AS score")
    out = quality.classify(more, marks)
    assert out.columns == [c for c in more.columns if c != "score"] + list(quality.ADDED)
    assert all((r["_text"], r["row"], r["h"], r["_lang"]) == (1, "r", 2, r.doc_id) for r in out.collect())
    # without metadata the content decides
    assert quality.classify(df.select("doc_id", "text"), marks).count() == 60


def test_labels_of_copies_do_not_depend_on_the_order(spark):
    docs, labels, _ = corpus(200, 3)
    docs += [(1000 + i, docs[0][1], "en", "src0", docs[0][4]) for i in range(4)]
    labels += [(1000 + i, i % 2, (i + 1) % 2) for i in range(4)]
    one, two = (frames(spark, d, m) for d, m in ((docs, labels), (docs[::-1], labels[::-1])))
    a, b = ({r.doc_id: r.score for r in quality.score_ids(f[0].repartition(n), f[1]).collect()} for f, n in ((one, 2), (two, 7)))
    assert a.keys() == b.keys() and all(abs(a[i] - b[i]) < 1e-6 for i in a)


def test_without_labels_everything_is_accepted(spark):
    df, marks = frames(spark, [(1, "a b", "en", "s", 3), (2, None, None, None, None)], [])
    assert [r.accepted for r in quality.classify(df, marks).collect()] == [True, True]
    assert sorted(r.doc_id for r in quality.score_ids(df, marks).collect() if r.accepted) == [1, 2]
    df, marks = frames(spark, [(i, f"text {i}", "en", "s", 3) for i in range(20)], [(i, 1, 0) for i in range(20)])
    assert all(r.accepted for r in quality.classify(df, marks).collect())


def two_views(seed, n=3000, width=40):
    """Two views, independent given the class, of many weak features each."""
    rng = np.random.default_rng(seed)
    y = rng.random(n) < 0.5
    return [(np.where(y, 0.25, -0.25)[:, None] + rng.normal(size=(n, width))).astype(np.float32) for _ in range(2)], y.astype(float)


def test_rounds_improve_rows_that_nothing_has_seen():
    """Few labels and a large pool: with rounds, rows that took no part are told better than without, seed by seed."""
    gains = []
    for seed in range(6):
        xs, y = two_views(seed)
        labelled, pool, unseen = slice(0, 120), slice(120, 2000), slice(2000, 3000)
        part = np.arange(120) % 20
        part = np.where(part < 8, 0, np.where(part < 14, 1, 2))
        right = []
        for rounds in (0, 4):
            trainer = quality.Trainer([x[labelled] for x in xs], y[labelled], part)
            head = quality.co_train([trainer], quality.ArrayPool([x[pool] for x in xs]), rounds)[0]
            right.append(np.mean((head.probability([x[unseen] for x in xs]) > 0.5) == y[unseen]))
        assert right[1] >= right[0] - 0.01
        gains.append(right[1] - right[0])
    assert np.mean(gains) > 0.02


def test_pool_on_the_executors_covers_all_rows_and_teaches(spark):
    """Confident rows are drawn from the whole table, copies once, about PSEUDO a group however many there are."""
    xs, y = two_views(1, n=1200)
    part = np.zeros(200, int)
    trainer = quality.Trainer([x[:200] for x in xs], y[:200], part)
    rows = [(i, i, bytes(a), bytes(b)) for i, (a, b) in enumerate(zip(*(quality._stored(x) for x in xs), strict=True))]
    features = spark.createDataFrame([(r[0], r[1], bytearray(r[2]), bytearray(r[3])) for r in rows + rows[:50]], quality._FEATURES).repartition(3)
    given = quality.TablePool(features, None, (40, 40)).confident([trainer])[0]
    fewer = quality.TablePool(features, features.filter("doc_id < 600").select("doc_id").distinct(), (40, 40)).confident([trainer])[0]
    assert all(0 < len(f[1]) < len(g[1]) for f, g in zip(fewer, given, strict=True))
    for k in (0, 1):
        p = quality.sigmoid(trainer.views[k].logit(xs[k].astype(np.float16).astype(np.float32)))
        for label, sure in ((1, (p >= quality.CONFIDENT).sum()), (0, (p <= 1 - quality.CONFIDENT).sum())):
            assert (given[k][1] == label).sum() == min(sure, quality.PSEUDO) or sure > quality.PSEUDO


def test_heads_without_two_classes():
    x = [np.zeros((3, 2), np.float32)] * 2
    none = np.zeros(3, int)
    assert quality.Trainer(x, np.ones(3), none).head().probability(x).tolist() == [0.8] * 3
    assert quality.Trainer([x[0][:0]] * 2, np.ones(0), none[:0]).head().rate == 0.5
