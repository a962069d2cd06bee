"""Quality classifier by co-training of two views of a document that share no feature.

The content view sees the words: which of a selected vocabulary occur, how varied they are, how often
one repeats the one before, their length. The metadata view sees the page: language, source, declared
length, and its form (lines, shares of pairs of character classes, in which all letters are alike).
There is one pair of classifiers for quality and one for toxicity.

The labelled rows are split by a hash of doc_id: 13 in 20 train the classifiers (and select the
vocabulary), the others choose rounds, calibrate, and test, each for nothing else. In every round both
views score all unlabelled documents, on the executors. Of those of which a view is confident, a sample
by hash, drawn from all of them, goes to the other view as pseudo-labels, and that learns again; it
keeps what it has learnt if the loss on the choosing rows falls by more than its standard error.
Classes are handed over in the proportion of the training rows. Then each view is calibrated
(Platt), the calibrated views are combined by a logistic model, and all documents are scored. A
document is accepted when its score, p(quality) * (1 - p(toxic)), reaches the threshold.

What the driver fits is bounded: MOST_LABELLED labelled rows, chosen by a hash of doc_id, and about
PSEUDO pseudo-labelled ones a class, view and round. Everything else covers all documents: the
features, from whole texts, the scores and the choice of the confident.

Cases: a null or empty text is scored like any other (no words, no pairs); labels of null are left
out, of several labels of a document the lowest quality and the highest toxicity count; of labelled
rows of equal features one is learnt from, with the lowest quality and highest toxicity; without
labels, or with labels of one class, a head answers with the (smoothed) share of that class, and
everything is accepted when there is none; equal rows get equal scores; very long texts are read
whole; an empty table gives an empty one. Null metadata are a category of their own. Extra columns
are kept by classify, whatever their names; columns named like the added ones are replaced.
"""
from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ._common import checkpoint_dir, packed, table, unpacked

MOST_LABELLED = 8_000
ROUNDS, CONFIDENT, PSEUDO = 2, 0.95, 500
THRESHOLD = 0.5
#: Words of the content view: at most so many, each in so many training documents, so much associated.
MOST_WORDS, LEAST_DOCUMENTS, LEAST_CHI2 = 400, 5, 25.0
#: Twentieths of the labelled rows that train, choose rounds, and calibrate; the rest tests.
TRAIN, CHOOSE, CALIBRATE = 13, 2, 3
WORD = re.compile(r"[^\W\d_]+")

# Classes of bytes: all letters are alike, each ASCII punctuation mark is its own, so are blanks and line ends.
_CLASSES = np.zeros(256, np.int64)
for _b in range(256):
    _c = chr(_b)
    _CLASSES[_b] = 0 if _b >= 128 else 1 if _c.islower() else 2 if _c.isupper() else 3 if _c.isdigit() else 4 if _c in "\n\r" else 5 if _b <= 32 or _b == 127 else 6 + "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~".index(_c)
_N = int(_CLASSES.max()) + 1
_BUCKETS = 24  # one-hot places of the language and of the source each
_SHAPE = 4  # measures of the words, before the vocabulary
_PAGE = 2 * _BUCKETS + 7  # metadata before the shares of pairs


def content(words: list[str], place: dict[str, int]) -> np.ndarray:
    """Measures of the words, then which words of the vocabulary occur."""
    out = np.zeros(_SHAPE + len(place), np.float32)
    n, kinds = len(words), set(words)
    out[:_SHAPE] = (np.log1p(n), len(kinds) / max(n, 1), sum(map(eq, words, islice(words, 1, None))) / max(n - 1, 1), np.log1p(sum(map(len, words)) / max(n, 1)))
    for w in kinds & place.keys():
        out[_SHAPE + place[w]] = 1
    return out


def metadata(text: bytes, lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
    """Language, source, declared length and form of a page; then shares of the pairs of character classes."""
    out = np.zeros(_PAGE + _N * _N, np.float32)
    for at, name in ((0, lang), (_BUCKETS, source)):
        out[at + (0 if name is None else 1 + zlib.crc32(name.encode()) % (_BUCKETS - 1))] = 1
    pairs = np.zeros(_N * _N)
    if len(text) > 1:
        c = _CLASSES[np.frombuffer(text, np.uint8)]
        pairs = np.bincount(c[:-1] * _N + c[1:], minlength=_N * _N)
    square = pairs.reshape(_N, _N)
    lines, pieces = text.count(b"\n") + 1, square[4:6].sum() - square[4:6, 4:6].sum() + 1
    out[2 * _BUCKETS : _PAGE] = (n_chars is None, np.log1p(max(n_chars or 0, 0)), np.log1p(len(text)), np.log1p(lines), np.log1p(pieces), np.log1p(len(text) / pieces), np.log1p(pieces / lines))
    out[_PAGE:] = pairs / max(len(text) - 1, 1)
    return out


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def log_loss(y, p):
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return float(-np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))) if len(y) else float("inf")


@dataclass
class Logistic:
    """Logistic regression on standardised columns, by full-batch Adam."""

    penalty: float = 1e-3
    steps: int = 250
    rate: float = 0.08
    mean: np.ndarray = None
    scale: np.ndarray = None
    weight: np.ndarray = None
    bias: float = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> Logistic:
        self.mean, spread = x.mean(0), x.std(0)
        self.scale = np.where(spread > 1e-6, 1 / np.maximum(spread, 1e-6), 0).astype(np.float32)
        z = np.clip((x - self.mean) * self.scale, -8, 8).astype(np.float32)
        w, b = np.zeros(x.shape[1], np.float32), float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
        m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
        for t in range(1, self.steps + 1):
            e = (sigmoid(z @ w + b) - y).astype(np.float32)
            g, gb = z.T @ e / len(y) + self.penalty * w, float(e.mean())
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
            w -= self.rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
            b -= self.rate * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.999**t)) + 1e-8)
        self.weight, self.bias = w, b
        return self

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) * self.scale, -8, 8) @ self.weight + self.bias


@dataclass
class Head:
    """One question to both views: the two classifiers, their calibration and combination."""

    rate: float = 0.5  # the answer where there is nothing to learn from
    views: list[Logistic] = field(default_factory=list)
    platt: list[tuple[float, float]] = field(default_factory=list)
    combine: tuple[float, float, float] = (0.0, 1.0, 1.0)
    held_out: dict = field(default_factory=dict)

    def calibrated(self, xs) -> list[np.ndarray]:
        return [a * v.logit(x) + b for v, x, (a, b) in zip(self.views, xs, self.platt, strict=True)]

    def probability(self, xs) -> np.ndarray:
        if not self.views:
            return np.full(len(xs[0]), self.rate)
        c, a, b = self.combine
        one, two = self.calibrated(xs)
        return sigmoid(c + a * one + b * two)


def _line(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Bias and non-negative weights of a small logistic model, by Newton steps with a weak prior."""
    x = np.column_stack([np.ones(len(y)), z])
    prior = np.r_[0.0, np.full(x.shape[1] - 1, 1.0 / (x.shape[1] - 1))]
    w = prior.copy()
    for _ in range(50):
        p = sigmoid(x @ w)
        h = x.T @ (x * (p * (1 - p))[:, None]) + 0.5 * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (p - y) + 0.5 * (w - prior))
        w = w - step
        w[1:] = np.maximum(w[1:], 0)
        if np.abs(step).max() < 1e-6:
            break
    return w


class Trainer:
    """One head while its views teach each other."""

    def __init__(self, xs: list[np.ndarray], y: np.ndarray, part: np.ndarray):
        """part: of each row 0 (train), 1 (choose), 2 (calibrate) or 3 (test)."""
        self.xs, self.y, self.part = xs, y, part
        self.views: list[Logistic] = []
        self.accepted: list[tuple[int, int]] = []  # round and view
        rows = self.rows(0)
        if len(np.unique(y[rows])) == 2:
            self.train = [[(x[rows], y[rows])] for x in xs]
            self.views = [Logistic().fit(*t[0]) for t in self.train]
            self.loss = [self._loss(k, v) for k, v in enumerate(self.views)]

    def rows(self, part: int) -> np.ndarray:
        """The rows of a part; those that train where a small table leaves it empty or with one class."""
        mine = np.flatnonzero(self.part == part)
        return mine if part == 0 or len(np.unique(self.y[mine])) == 2 else np.flatnonzero(self.part == 0)

    def _loss(self, k: int, view: Logistic) -> np.ndarray:
        """The loss of each choosing row."""
        rows = self.rows(1)
        y, p = self.y[rows], np.clip(sigmoid(view.logit(self.xs[k][rows])), 1e-6, 1 - 1e-6)
        return -(y * np.log(p) + (1 - y) * np.log(1 - p))

    def _balanced(self, x: list[np.ndarray], label: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """As many of either class as go with the share of classes in the training rows: a view that is sure of one class only teaches nothing."""
        rate = self.y[self.rows(0)].mean()
        sides = [np.flatnonzero(label == c) for c in (0, 1)]
        most = min(len(sides[0]) / (1 - rate), len(sides[1]) / rate)
        rows = np.sort(np.concatenate([side[: int(most * share)] for side, share in zip(sides, (1 - rate, rate), strict=True)]))
        return [v[rows] for v in x], label[rows]

    def learn(self, turn: int, given: list[tuple[list[np.ndarray], np.ndarray]]) -> None:
        """given: by teaching view, pseudo-labelled rows in both views and their labels."""
        before = list(self.views)
        for k in (0, 1):  # each view learns from what the other was sure of
            x, label = self._balanced(*given[1 - k])
            if len(np.unique(label)) < 2:
                continue
            parts = [*self.train[k], (x[k], label)]
            tried = Logistic().fit(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
            now = self._loss(k, tried)
            gain = self.loss[k] - now
            if gain.mean() > gain.std() / np.sqrt(len(gain)):  # by more than its standard error
                before[k], self.loss[k], self.train[k] = tried, now, parts
                self.accepted.append((turn, k))
        self.views = before

    def head(self) -> Head:
        y, xs = self.y, self.xs
        if not self.views:
            return Head(rate=float((y.sum() + 1) / (len(y) + 2)) if len(y) else 0.5)
        head = Head(rate=float(y.mean()), views=self.views)
        rows = self.rows(2)
        for v, x in zip(self.views, xs, strict=True):
            b, a = _line(v.logit(x[rows])[:, None], y[rows])
            head.platt.append((float(a), float(b)))
        head.combine = tuple(float(c) for c in _line(np.column_stack(head.calibrated([x[rows] for x in xs])), y[rows]))
        rows = self.rows(3)
        p = head.probability([x[rows] for x in xs])
        head.held_out = {"rows": len(rows), "accuracy": float(np.mean((p > 0.5) == y[rows])), "log_loss": log_loss(y[rows], p), "accepted": self.accepted}
        return head


class ArrayPool:
    """Unlabelled rows in memory, in both views, in place of a table of features."""

    def __init__(self, xs: list[np.ndarray], seed: int = 7):
        self.xs, self.random = xs, np.random.default_rng(seed)

    def confident(self, trainers: list[Trainer]):
        out = []
        for t in trainers:
            given = []
            for k in (0, 1):
                p = sigmoid(t.views[k].logit(self.xs[k])) if t.views else np.full(len(self.xs[k]), 0.5)
                picked = [rows if len(rows) <= PSEUDO else self.random.choice(rows, PSEUDO, replace=False) for rows in (np.flatnonzero(p >= CONFIDENT), np.flatnonzero(p <= 1 - CONFIDENT))]
                rows = np.concatenate(picked)
                given.append(([x[rows] for x in self.xs], (p[rows] > 0.5).astype(np.float64)))
            out.append(given)
        return out


def co_train(trainers: list[Trainer], pool, rounds: int = ROUNDS) -> list[Head]:
    """Heads from labelled rows in two views and a pool of unlabelled ones in the same views."""
    for turn in range(rounds):
        if not any(t.views for t in trainers):
            break
        for t, given in zip(trainers, pool.confident(trainers), strict=True):
            if t.views:
                t.learn(turn, given)
    return [t.head() for t in trainers]


@dataclass
class Model:
    vocabulary: list[str]
    columns: np.ndarray  # of the metadata features that are used
    good: Head = None
    toxic: Head = None

    def features(self, texts: list[str], langs: list, sources: list, lengths: list) -> list[np.ndarray]:
        place = {w: i for i, w in enumerate(self.vocabulary)}
        one = np.zeros((len(texts), _SHAPE + len(place)), np.float32)
        two = np.zeros((len(texts), len(self.columns)), np.float32)
        for i, t in enumerate(texts):
            one[i] = content(words_of(t), place)
            two[i] = metadata(t.encode("utf-8", "surrogatepass"), langs[i], sources[i], lengths[i])[self.columns]
        # what is stored of them: a model sees the same numbers wherever they come from; counts are logarithms, which fit
        return [x.astype(np.float16).astype(np.float32) for x in (one, two)]

    def scores(self, xs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return self.good.probability(xs), self.toxic.probability(xs)


def _stored(x: np.ndarray) -> list[bytes]:
    return [zlib.compress(row.tobytes(), 1) for row in x.astype(np.float16)]


def _read(column, width: int) -> np.ndarray:
    rows = [np.frombuffer(zlib.decompress(v), np.float16) for v in column]
    return np.stack(rows).astype(np.float32) if rows else np.zeros((0, width), np.float32)


_FEATURES = "doc_id long, h long, content binary, metadata binary"


def _extract(told):
    """Rows (doc_id, text, lang, source, n_chars) to the features of both views, compressed."""

    def run(batches):
        m = told.value
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                one, two = (_stored(x) for x in m.features(*(batch.column(i).to_pylist() for i in range(1, 5))))
                h = [xxhash.xxh3_64_intdigest(a + b) - (1 << 63) for a, b in zip(one, two, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(h, pa.int64()), pa.array(one, pa.binary()), pa.array(two, pa.binary())], names=["doc_id", "h", "content", "metadata"])

    return run


class TablePool:
    """All unlabelled documents, as a table of features on the executors."""

    def __init__(self, features: DataFrame, labelled: DataFrame | None, widths: tuple[int, int]):
        """labelled: the doc_ids that are left out, if any; features themselves are never shuffled."""
        self.features, self.labelled, self.widths = features, labelled, widths

    def confident(self, trainers: list[Trainer]):
        told = self.features.sparkSession.sparkContext.broadcast([t.views for t in trainers])
        widths, groups = self.widths, 4 * len(trainers)

        def sure(batches):
            """Of each document a bit for each group (head, view, label) that it may teach."""
            for batch in batches:
                xs = [_read(batch.column(i + 2).to_pylist(), widths[i]) for i in (0, 1)]
                mask = np.zeros(batch.num_rows, np.int64)
                for i, views in enumerate(told.value):
                    for k, view in enumerate(views):
                        p = sigmoid(view.logit(xs[k]))
                        mask |= ((p <= 1 - CONFIDENT).astype(np.int64) << (4 * i + 2 * k)) | ((p >= CONFIDENT).astype(np.int64) << (4 * i + 2 * k + 1))
                kept = pa.array(mask > 0)
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(kept), batch.column(1).filter(kept), pa.array(mask[mask > 0])], names=["doc_id", "h", "mask"])

        found = self.features.select("doc_id", "h", "content", "metadata").mapInArrow(sure, "doc_id long, h long, mask long")
        if self.labelled is not None:
            found = found.join(self.labelled, "doc_id", "left_anti")
        found = found.select("h", "mask").distinct().checkpoint()  # equal documents share h and are one
        has = lambda g: F.col("mask").bitwiseAND(F.lit(1 << g)) > 0
        counts = found.agg(*[F.count_if(has(g)).alias(f"n{g}") for g in range(groups)]).first()
        # of each group about PSEUDO, by another hash of h
        place = F.pmod(F.xxhash64(F.lit("share"), "h"), F.lit(1 << 40)) / F.lit(float(1 << 40))
        chosen = F.lit(0).cast("bigint")
        for g in range(groups):
            chosen = chosen + F.when(has(g) & (place * float(counts[f"n{g}"]) < PSEUDO), F.lit(1 << g)).otherwise(F.lit(0))
        picked = found.select("h", chosen.alias("given")).filter("given > 0")
        # about groups * PSEUDO rows of two numbers are broadcast, and as many features reach the driver
        rows = self.features.join(F.broadcast(picked), "h").groupBy("h").agg(F.bit_or("given").alias("given"), F.min(F.struct("content", "metadata")).alias("x")).collect()
        rows.sort(key=lambda r: r["h"])
        xs = [_read([bytes(r["x"][name]) for r in rows], width) for name, width in zip(("content", "metadata"), widths, strict=True)]
        given = np.array([r["given"] for r in rows], np.int64)
        out = []
        for i in range(len(trainers)):
            views = []
            for k in (0, 1):
                sides = [np.flatnonzero(given >> (4 * i + 2 * k + label) & 1) for label in (0, 1)]
                at = np.concatenate(sides)
                views.append(([x[at] for x in xs], np.repeat([0.0, 1.0], [len(side) for side in sides])))
            out.append(views)
        return out


def select_words(train: DataFrame) -> list[str]:
    """The words of the training rows most associated (chi-square) with one of the labels."""
    n = F.lit(float(train.count()))
    words = train.select(F.explode("words").alias("word"), (F.col("toxic") > 0).cast("double").alias("y1"), (F.col("quality") <= 0).cast("double").alias("y2"))
    totals = train.agg(F.sum((F.col("toxic") > 0).cast("double")).alias("p1"), F.sum((F.col("quality") <= 0).cast("double")).alias("p2")).first()
    held = words.groupBy("word").agg(F.count("*").cast("double").alias("k"), F.sum("y1").alias("a1"), F.sum("y2").alias("a2"))

    def chi2(a: str, p: float | None):
        if not p:
            return F.lit(0.0)
        a, k, p = F.coalesce(F.col(a), F.lit(0.0)), F.col("k"), F.lit(float(p))
        below = p * (n - p) * k * (n - k)
        return F.when(below > 0, n * F.pow(a * (n - p) - (k - a) * p, F.lit(2.0)) / below).otherwise(F.lit(0.0))

    held = held.filter(F.col("k") >= LEAST_DOCUMENTS).withColumn("score", F.greatest(chi2("a1", totals["p1"]), chi2("a2", totals["p2"])))
    return [r["word"] for r in held.filter(F.col("score") >= LEAST_CHI2).orderBy(F.desc("score"), "word").limit(MOST_WORDS).collect()]


def fit(docs: DataFrame, labels: DataFrame, most_labelled: int = MOST_LABELLED, rounds: int = ROUNDS) -> tuple[Model, DataFrame | None]:
    """A model, learnt from at most most_labelled labelled rows and all others, and the features of all rows."""
    spark = docs.sparkSession
    checkpoint_dir(spark)
    docs = _inputs(docs)
    marks = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    # at most most_labelled rows of three numbers are broadcast, and as many texts looked at
    chosen = marks.orderBy(F.xxhash64(F.lit("labelled"), "doc_id"), "doc_id").limit(most_labelled)
    twentieth = F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(20))
    part = F.when(twentieth < TRAIN, 0).when(twentieth < TRAIN + CHOOSE, 1).when(twentieth < TRAIN + CHOOSE + CALIBRATE, 2).otherwise(3)
    sample = docs.join(F.broadcast(chosen), "doc_id").withColumn("part", part)
    # copies of one text are one row, of the part that comes first and its smallest doc_id
    sample = sample.groupBy("text", "lang", "source", "n_chars").agg(F.min("part").alias("part"), F.min("doc_id").alias("doc_id"), F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    words = "doc_id long, part int, quality int, toxic int, text string, lang string, source string, n_chars long, words array<string>"
    sample = sample.select("doc_id", "part", "quality", "toxic", "text", "lang", "source", "n_chars").mapInArrow(_worded, words).checkpoint()
    model = Model(select_words(sample.filter("part = 0")), np.arange(_PAGE + _N * _N))
    rows = _collected(sample, model)
    if not rows:
        model.good, model.toxic = Head(rate=1.0), Head(rate=0.0)
        return model, None
    part = np.array([r["part"] for r in rows])
    used = np.stack([r["metadata"] for r in rows])
    trained = part == 0 if (part == 0).any() else np.ones(len(part), bool)
    model.columns = np.flatnonzero((np.arange(used.shape[1]) < _PAGE) | ((used[trained] > 0).mean(0) >= 0.005))
    xs = [np.stack([r["content"] for r in rows]), used[:, model.columns]]
    value = lambda name: np.array([-1 if r[name] is None else r[name] for r in rows])
    marked = {"good": value("quality"), "toxic": value("toxic")}
    trainers = [Trainer([x[y >= 0] for x in xs], (y[y >= 0] > 0).astype(np.float64), part[y >= 0]) for y in marked.values()]
    told = spark.sparkContext.broadcast(model)
    features = docs.mapInArrow(_extract(told), _FEATURES).checkpoint()
    pool = TablePool(features, marks.select("doc_id"), (xs[0].shape[1], xs[1].shape[1]))
    for (name, y), head, none in zip(marked.items(), co_train(trainers, pool, rounds), (1.0, 0.0), strict=True):
        setattr(model, name, head if (y >= 0).any() else Head(rate=none))
    return model, features


def _inputs(docs: DataFrame) -> DataFrame:
    names = {c.lower() for c in docs.columns}
    column = lambda c, kind: (F.col(c).try_cast(kind) if c in names else F.lit(None).cast(kind)).alias(c)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), column("lang", "string"), column("source", "string"), column("n_chars", "bigint"))


def _worded(batches):
    for batch in batches:
        words = pa.array([sorted(set(words_of(t))) for t in batch.column(4).to_pylist()], pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([*batch.columns, words], names=[*batch.schema.names, "words"])


def _collected(sample: DataFrame, model: Model) -> list[dict]:
    """The features of the labelled sample, in a fixed order; texts stay on the executors."""
    told = sample.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            one, two = told.value.features(*(batch.column(i).to_pylist() for i in range(4, 8)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(_stored(one), pa.binary()), pa.array(_stored(two), pa.binary())], names=["doc_id", "part", "quality", "toxic", "content", "metadata"])

    rows = sample.drop("words").mapInArrow(run, "doc_id long, part int, quality int, toxic int, content binary, metadata binary").collect()
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["content"]), bytes(r["metadata"])))
    unpack = lambda v: np.frombuffer(zlib.decompress(bytes(v)), np.float16).astype(np.float32)
    return [{**r.asDict(), "content": unpack(r["content"]), "metadata": unpack(r["metadata"])} for r in rows]


ADDED = ("p_quality", "p_toxic", "score", "accepted")
_SCORES = [*[T.StructField(c, T.DoubleType()) for c in ADDED[:3]], T.StructField("accepted", T.BooleanType())]


def _scored(told, threshold: float, schema: pa.Schema, read):
    """The first column as it is, and the scores of what read makes of the others."""

    def run(batches):
        m = told.value
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                good, toxic = m.scores(read(m, [batch.column(i).to_pylist() for i in range(1, batch.num_columns)]))
                score = good * (1 - toxic)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(good), pa.array(toxic), pa.array(score), pa.array(score >= threshold)], schema=schema)

    return run


def _score(rows: DataFrame, model: Model, threshold: float, read) -> DataFrame:
    told = rows.sparkSession.sparkContext.broadcast(model)  # a few thousand weights and words
    out = T.StructType([rows.schema[0], *_SCORES])
    return rows.mapInArrow(_scored(told, threshold, to_arrow_schema(out), read), out)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, model: Model | None = None) -> DataFrame:
    """docs with p_quality, p_toxic, score and accepted."""
    scored = _classified(docs, model or fit(docs, labels)[0], threshold)
    return scored.select(*unpacked(docs, without=ADDED), *ADDED)


def _classified(docs: DataFrame, model: Model, threshold: float) -> DataFrame:
    """The input's rows as structs `row`, and the added columns."""
    given = _inputs(docs).columns
    names = {c.lower() for c in docs.columns}
    value = lambda c: F.col(c) if c in names else F.lit(None)
    kinds = {"text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}
    read = [F.coalesce(F.col("text"), F.lit("")).alias("text"), *[value(c).try_cast(kinds[c]).alias(c) for c in given[2:]]]
    return _score(docs.select(packed(docs), *read), model, threshold, lambda m, columns: m.features(*columns))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that are accepted, with the input's columns, whatever their names."""
    model = fit(docs, labels)[0]
    return _classified(docs, model, threshold).filter("accepted").select(*unpacked(docs))


def score_ids(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id and the scores of all rows, from the features that the fit has stored."""
    model, features = fit(docs, labels)
    if features is None:
        return classify(docs.select("doc_id", "text"), labels, threshold, model).drop("text")
    widths = _SHAPE + len(model.vocabulary), len(model.columns)
    return _score(features.select("doc_id", "content", "metadata"), model, threshold, lambda m, columns: [_read(c, w) for c, w in zip(columns, widths, strict=True)])


def op6_quality(spark, sf_dir: str) -> DataFrame:
    return score_ids(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
