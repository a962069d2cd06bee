"""Token counts by byte-pair merging with a heap and a linked list; no identifiers are made.

A piece of text is a list of symbols, at first one a byte, linked to their neighbours. A heap holds
the adjacent pairs by rank and place; the lowest is popped, its two symbols become one, and the two
new pairs at its sides are pushed. What is left when no pair has a rank is counted: the initial
symbols minus the merges. Counts of pieces are kept in a table of bounded size in each worker.

The vocabulary file is the `tokenizers` JSON of a byte-level BPE; its merges are read from there,
once a worker. Text is cut as the file's pre-tokenizer does, and an added token that stands in a text
counts as one, as the library has it.

Cases: a null text is an empty one with 0 tokens; there are no limits on length; rows keep their
order and number, equal ones too; an empty table gives an empty one. Extra columns are kept;
columns named like the added ones are replaced.
"""
from __future__ import annotations

import functools
import heapq
import json

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ._common import fresh, table

LIMIT = 512
#: Entries of each half of a worker's table of pieces, and of its table of chunks between blanks.
TABLE_SIZE, CHUNK_TABLE_SIZE = 500_000, 250_000
#: How the pre-tokenizer of byte-level BPE files cuts text. White space is Unicode's.
_WHITE = r"\t-\r\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
_SPACE, _SOLID = f"[{_WHITE}]", f"[^{_WHITE}]"
PIECES = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?(?:(?!\p{{L}}|\p{{N}}){_SOLID})+|{_SPACE}+(?!{_SOLID})|{_SPACE}+")
#: Where a blank may be split from what stands before it without a change of pieces.
_RUNS = regex.compile(rf"{_SPACE}{{2}}")
_CUTS = regex.compile(rf"(?<={_SOLID})(?= {_SOLID})")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Halves:
    """A table of bounded size: when the young half is full it becomes the old one, which is let go."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def get(self, key: str) -> int | None:
        n = self.young.get(key)
        if n is None and (n := self.old.get(key)) is not None:
            self.put(key, n)
        return n

    def put(self, key: str, n: int) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = n


class Counter:
    """Counts the tokens of texts with the merges of one vocabulary file."""

    def __init__(self, path: str, table_size: int = TABLE_SIZE, chunk_table_size: int = CHUNK_TABLE_SIZE):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["model"]["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("only byte-level BPE files are read")
        odd = [name for name in ("add_prefix_space", "normalizer", "ignore_merges", "dropout", "byte_fallback") if spec.get(name) or spec["model"].get(name) or spec["pre_tokenizer"].get(name)]
        odd += [t["content"] for t in spec["added_tokens"] if t.get("single_word") or t.get("lstrip") or t.get("rstrip") or t.get("normalized")]
        if odd or spec["pre_tokenizer"].get("use_regex") is False:
            raise ValueError(f"counts would differ from the library's: {odd or ['use_regex']}")
        back = {c: b for b, c in enumerate(byte_symbols())}
        number = {bytes([b]): b for b in range(256)}
        raw = lambda s: bytes(back[c] for c in s)
        #: By left * 2^32 + right: rank * 2^32 + the number of what they make.
        self.ranks: dict[int, int] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = map(raw, pair.split(" ") if isinstance(pair, str) else pair)
            a, b, made = (number.setdefault(x, len(number)) for x in (left, right, left + right))
            self.ranks.setdefault(a << 32 | b, rank << 32 | made)
        added = [t["content"] for t in spec["added_tokens"]]
        self.added = regex.compile("|".join(regex.escape(t) for t in sorted(added, key=len, reverse=True))) if added else None
        self.pieces, self.chunks = Halves(table_size), Halves(chunk_table_size)

    def merged(self, piece: bytes) -> int:
        """Symbols that are left of a piece after all merges."""
        n = left = len(piece)
        if n < 2:
            return n
        rank_of = self.ranks.get
        symbols, after, before = list(piece), list(range(1, n + 1)), list(range(-1, n - 1))
        # an entry is rank, then place, then what the pair makes; equal ranks come by place
        heap = [(r >> 32) * n + i for i in range(n - 1) if (r := rank_of(symbols[i] << 32 | symbols[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = divmod(heapq.heappop(heap), n)
            j = after[i]
            if symbols[i] < 0 or j >= n:
                continue
            r = rank_of(symbols[i] << 32 | symbols[j])
            if r is None or r >> 32 != rank:
                continue  # one of the two has been merged since
            made = symbols[i] = r & 0xFFFFFFFF
            symbols[j], left = -1, left - 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank_of(made << 32 | symbols[k])) is not None:
                    heapq.heappush(heap, (r >> 32) * n + i)
            h = before[i]
            if h >= 0 and (r := rank_of(symbols[h] << 32 | made)) is not None:
                heapq.heappush(heap, (r >> 32) * n + h)
        return left

    def _piece(self, piece: str) -> int:
        n = self.pieces.get(piece)
        if n is None:
            n = self.merged(piece.encode("utf-8", "surrogatepass"))
            if len(piece) <= 64:
                self.pieces.put(piece, n)
        return n

    def _chunk(self, chunk: str) -> int:
        n = self.chunks.get(chunk)
        if n is None:
            n = sum(map(self._piece, PIECES.findall(chunk)))
            if len(chunk) <= 64:
                self.chunks.put(chunk, n)
        return n

    def _plain(self, text: str) -> int:
        if not text:
            return 0
        if _RUNS.search(text):
            words = _CUTS.split(text)
            total, head, rest = 0, words[0], words[1:]
            rest = [w[1:] for w in rest]
        else:
            head, *rest = text.split(" ")
            total = 0
        total += self._chunk(head) if head else 0
        for w in rest:
            w = " " + w
            n = self.chunks.young.get(w)
            total += self._chunk(w) if n is None else n
        return total

    def count(self, text: str) -> int:
        if self.added is None or not self.added.search(text):
            return self._plain(text)
        parts = self.added.split(text)
        return sum(map(self._plain, parts)) + len(parts) - 1


@functools.lru_cache(maxsize=2)
def _counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, vocabulary: str, text: str = "text", limit: int = LIMIT) -> DataFrame:
    """docs with n_bytes, n_tokens and over_limit.

    vocabulary is a path that every worker can read; an installed package's or a shared one.
    """
    docs = fresh(docs, "n_bytes", "n_tokens", "over_limit")
    out = T.StructType([*docs.schema.fields, T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])
    at = docs.columns.index(text)
    keep = [f.name for f in docs.schema.fields]

    def counted(batches):
        counter = _counter(vocabulary)
        for batch in batches:
            sizes, counts = [], []
            for value in batch.column(at):
                t = value.as_py() or ""
                sizes.append(len(t.encode("utf-8", "surrogatepass")))
                counts.append(counter.count(t))
            columns = [*batch.columns, pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), pa.array([c > limit for c in counts], pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "n_bytes", "n_tokens", "over_limit"])

    return docs.mapInArrow(counted, out)


def _digest(docs: DataFrame, vocabulary: str, limit: int = LIMIT) -> DataFrame:
    """Counts alone: the text itself is not carried back from the workers."""

    def counted(batches):
        counter = _counter(vocabulary)
        for batch in batches:
            texts = batch.column(1)
            sizes = [0 if v is None else v for v in pc.binary_length(texts).to_pylist()]
            counts = [counter.count(v.as_py() or "") for v in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), pa.array([c > limit for c in counts], pa.bool_())], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select("doc_id", "text").mapInArrow(counted, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op7_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return _digest(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
