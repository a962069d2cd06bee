"""Words and word windows of many texts at once, as numpy arrays of 64-bit hashes.

Words are runs of bytes that are no white space (space, tab to carriage return). A word's hash is its
XXH3 value; that of a window joins the hashes of its halves, which are joined in the same way, by a
mixing function that is no polynomial: strings made to collide under sums of powers do not. Both
are functions of the content alone: no process, partition or order enters. Sets of hashes travel
between tasks as sorted differences, compressed.
"""
from __future__ import annotations

import re

import numpy as np
import xxhash
import zstandard

U = np.uint64
_LEFT, _RIGHT = U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93)
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
#: Bytes of text that are looked at together, unless one text is longer.
CHUNK = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all of them."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The hash of two pieces that follow each other."""
    return mixed(mixed(a + _LEFT) ^ (b * _RIGHT))


def chunks(texts: list[bytes], most: int = CHUNK):
    """Index ranges of texts of about `most` bytes together."""
    begin = held = 0
    for i, t in enumerate(texts):
        if i > begin and held + len(t) > most:
            yield begin, i
            begin, held = i, 0
        held += len(t) + 1
    if begin < len(texts):
        yield begin, len(texts)


def segments(data: bytes, most: int = CHUNK):
    """Ranges of about `most` bytes that end at white space: a very long text is split piece by piece."""
    at = 0
    while at < len(data):
        cut = _BLANK.search(data, at + most)
        end = cut.start() if cut else len(data)
        yield at, end
        at = end


def word_hashes(texts: list[bytes], fold: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, in order, and the number of words of each text."""
    hashes, counts = [], []
    for a, b in chunks(texts):
        words: list[bytes] = []
        if b - a == 1 and len(texts[a]) > CHUNK:
            size = 0
            for i, j in segments(texts[a]):
                part = texts[a][i:j]
                hashes.append(_hashed((part.lower() if fold else part).split()))
                size += len(hashes[-1])
            counts.append(size)
            continue
        for t in texts[a:b]:
            mine = (t.lower() if fold else t).split()
            counts.append(len(mine))
            words += mine
        hashes.append(_hashed(words))
    return np.concatenate(hashes) if hashes else np.empty(0, np.uint64), np.array(counts, np.int64)


def _hashed(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of words[i : i + n] for each i at which there are n words; across texts as well.

    A window is cut into pieces whose sizes are the powers of two that make up n.
    """
    total = len(words) - n + 1
    if total < 1 or n < 1:
        return np.empty(0, np.uint64)
    out, at, width, piece = None, 0, 1, words
    while width <= n:
        if n & width:
            part = piece[at : at + total]
            out = part.copy() if out is None else joined(out, part)
            at += width
        if 2 * width <= n:
            piece = joined(piece[:-width], piece[width:])
        width *= 2
    return out


def pack(sorted_values: np.ndarray) -> bytes:
    """Sorted uint64 values as compressed differences, byte by byte of equal weight."""
    gaps = np.diff(sorted_values, prepend=U(0)).astype("<u8")
    return zstandard.ZstdCompressor(level=1).compress(gaps.view(np.uint8).reshape(-1, 8).T.tobytes())


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.cumsum(np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").ravel(), dtype=np.uint64)


def pack_columns(*columns: np.ndarray) -> bytes:
    """Arrays of uint64 of any lengths, byte by byte of equal weight, compressed together."""
    planes = [np.ascontiguousarray(c, "<u8").view(np.uint8).reshape(-1, 8).T.tobytes() for c in columns]
    head = np.array([len(columns), *map(len, columns)], "<u4").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(planes))


def unpack_columns(data: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(data)
    count = int(np.frombuffer(data, "<u4", 1)[0])
    at, out = 4 * (count + 1), []
    for n in np.frombuffer(data, "<u4", count, 4).tolist():
        out.append(np.ascontiguousarray(np.frombuffer(data, np.uint8, 8 * n, at).reshape(8, n).T).view("<u8").ravel())
        at += 8 * n
    return out


def member(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(sorted_set):
        return np.zeros(len(values), bool)
    at = np.searchsorted(sorted_set, values)
    at[at == len(sorted_set)] = 0
    return sorted_set[at] == values


def slices(batches, rows: int = 1000):
    """Arrow batches in pieces, so that what a task holds of each stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def utf8(column) -> list[bytes]:
    """The values of an Arrow string column as UTF-8; null is empty."""
    import pyarrow as pa

    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [v or b"" for v in column.cast(kind).to_pylist()]
