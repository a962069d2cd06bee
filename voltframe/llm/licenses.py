"""Licence scans: an Aho-Corasick automaton finds tags and phrases, a shunting-yard parser reads expressions.

Texts are reduced to their words (A-Z lower-cased; digits, a-z and characters beyond ASCII) with one
blank between them, and streamed once through an automaton of all phrases, each with a blank at
either side, so that whole words match. Behind an SPDX tag the original text is parsed: AND binds
stronger than OR, WITH ties an exception to a licence, parentheses group. An expression that cannot
be parsed is reported by the identifiers that it names, up to where prose follows; one of operators
only by its first word.

The score is the permission of what was found: that of the weakest licence of a conjunction, of the
strongest of a choice; over a whole text the lowest of its tags and notices. Without any it is 0.

Cases: a null text is an empty one; overlapping places are all counted; equal rows are kept; an
empty table gives an empty one. Extra columns are kept; columns named like the added are replaced.
"""
from __future__ import annotations

import functools
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ._common import fresh, table

# The phrases and labels that the contract counts, in its order.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Further notices that the method labels.
MORE_PHRASES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "isc license": "isc",
    "boost software license": "bsl",
    "permission is hereby granted free of charge": "mit",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "all rights reserved": "reserved",
    "public domain": "public-domain",
}
TAG = "spdx license identifier"
#: How free a licence family leaves its users, by the start of an SPDX identifier.
PERMISSION = {
    "0bsd": 1.0, "apache": 1.0, "bsd": 1.0, "bsl": 1.0, "cc0": 1.0, "isc": 1.0, "mit": 1.0, "unlicense": 1.0, "zlib": 1.0, "public-domain": 1.0,
    "cc-by": 0.9, "lgpl": 0.6, "mpl": 0.6, "epl": 0.6, "gpl": 0.4, "cc-by-sa": 0.4, "agpl": 0.2, "cc-by-nc": 0.1, "reserved": 0.1,
}
UNKNOWN, EXCEPTION_BONUS = 0.3, 0.2

#: Bytes to words: A-Z lower-cased, other ASCII beside digits and a-z to a blank.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_TOKEN = re.compile(r"\s*(?:([()])|([A-Za-z0-9][A-Za-z0-9.+:-]*))")
_TAG_AT = re.compile(r"SPDX-License-Identifier\s*:\s*(?=[^\r\n])", re.IGNORECASE | re.ASCII)
_LINE_END = re.compile(r"[\r\n]")
_BINDS = {"or": 1, "and": 2, "with": 3}


def permission(identifier: str) -> float:
    name = identifier.lower()
    fits = [p for p in PERMISSION if name == p or name.startswith(p + "-") or name.startswith(p + "+")]
    return PERMISSION[max(fits, key=len)] if fits else UNKNOWN


def tokens(expression: str) -> list[str]:
    """Identifiers, operators and parentheses up to the first other character."""
    out, at = [], 0
    while m := _TOKEN.match(expression, at):
        out.append(m[1] or m[2])
        at = m.end()
    return out


def postfix(parts: list[str]) -> list[str]:
    """Shunting-yard: the expression in postfix order; ValueError if it is none."""
    out: list[str] = []
    held: list[str] = []
    operand_next = True
    for part in parts:
        op = part.lower()
        if op in _BINDS:
            if operand_next:
                raise ValueError(f"operator {part} without operand")
            while held and held[-1] != "(" and _BINDS[held[-1]] >= _BINDS[op]:
                out.append(held.pop())
            held.append(op)
            operand_next = True
        elif part == "(":
            if not operand_next:
                raise ValueError("operator missing")
            held.append(part)
        elif part == ")":
            if operand_next:
                raise ValueError("operand missing")
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held:
                raise ValueError("parenthesis never opened")
            held.pop()
        else:
            if not operand_next:
                raise ValueError("operator missing")
            out.append(part)
            operand_next = False
    if operand_next or "(" in held:
        raise ValueError("expression ends early")
    return out + held[::-1]


def expression_prefix(parts: list[str]) -> list[str]:
    """The longest start of the tokens that is an expression: prose may follow on the line."""
    depth, operand_next, best = 0, True, 0
    for i, part in enumerate(parts):
        op = part.lower()
        if op in _BINDS:
            if operand_next:
                break
            operand_next = True
        elif part == "(":
            if not operand_next:
                break
            depth += 1
        elif part == ")":
            if operand_next or depth == 0:
                break
            depth -= 1
        elif operand_next:
            operand_next = False
        else:
            break
        if not operand_next and depth == 0:
            best = i + 1
    return parts[:best]


def named(parts: list[str]) -> set[str]:
    """Identifiers of tokens that are no expression, up to two operands in a row; not exceptions."""
    out, before = set(), "("
    for part in parts:
        op = part.lower()
        if op not in _BINDS and part not in "()":
            if before not in _BINDS and before not in "()":
                break
            if before != "with":
                out.add(op)
        before = op
    return out or {p.lower() for p in parts[:1] if p not in "()"}


def tagged_expressions(text: str) -> list[list[str]]:
    """The tokens behind each SPDX tag, up to the end of its line or to the next tag."""
    tags = list(_TAG_AT.finditer(text))
    ends = [t.start() for t in tags[1:]] + [len(text)]
    out = []
    for tag, after in zip(tags, ends, strict=False):
        line = _LINE_END.search(text, tag.end(), after)
        out.append(tokens(text[tag.end() : line.start() if line else after]))
    return out


def evaluate(parts: list[str]) -> tuple[set[str], float]:
    """Identifiers of an expression and its permission."""
    stack: list[tuple[set[str], float]] = []
    for part in postfix(parts):
        if part not in _BINDS:
            stack.append(({part.lower()}, permission(part)))
            continue
        (right, b), (left, a) = stack.pop(), stack.pop()
        value = {"or": max(a, b), "and": min(a, b), "with": min(1.0, a + EXCEPTION_BONUS)}[part]
        if part != "with":
            # the larger set takes in the smaller: long expressions take time in proportion
            left, right = (left, right) if len(left) >= len(right) else (right, left)
            left |= right
        stack.append((left, value))
    return stack[0]


@functools.lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase, label in [*BASE_PHRASES.items(), *MORE_PHRASES.items(), (TAG, "")]:
        found.add_word(f" {phrase} ", (phrase, label, len(phrase)))
    found.make_automaton()
    return found


def scan(text: str) -> dict:
    """n_words, places (of base phrases: first word, label), labels, expressions and score of a text."""
    words = text.encode("utf-8", "surrogatepass").translate(_FOLD).split()
    joined = " " + b" ".join(words).decode("latin-1") + " "
    places, labels, scores, expressions = [], set(), [], []
    tagged, at, word = False, 0, -1
    hits = sorted((end - size - 1, phrase, label) for end, (phrase, label, size) in _automaton().iter(joined))
    for start, phrase, label in hits:
        word += joined.count(" ", at, start + 1)
        at = start + 1
        if not label:
            tagged = True
            continue
        labels.add(label)
        scores.append(PERMISSION[label])
        if phrase in BASE_PHRASES:
            places.append((word, label))
    for found in tagged_expressions(text) if tagged else ():
        parts = expression_prefix(found)
        if parts:
            names, score = evaluate(parts)
            expressions.append(" ".join(parts))
        else:
            names, score = named(found), UNKNOWN
        labels |= {f"spdx:{n}" for n in names}
        scores.append(score)
    return {"n_words": len(words), "places": places, "labels": sorted(labels), "expressions": expressions, "score": min(scores, default=0.0)}


_PLACES = T.ArrayType(T.StructType([T.StructField("word", T.LongType()), T.StructField("label", T.StringType())]))
_ADDED = [
    T.StructField("n_words", T.LongType()),
    T.StructField("places", _PLACES),
    T.StructField("labels", T.ArrayType(T.StringType())),
    T.StructField("expressions", T.ArrayType(T.StringType())),
    T.StructField("score", T.DoubleType()),
]
_ARROW = {
    "n_words": pa.int64(),
    "places": pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())])),
    "labels": pa.list_(pa.string()),
    "expressions": pa.list_(pa.string()),
    "score": pa.float64(),
}


def scan_licenses(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """docs (or only the columns in keep) with n_words, places, labels, expressions and score."""
    docs = fresh(docs, *_ARROW)
    keep = [c for c in (docs.columns if keep is None else keep)]
    source = docs.select(*dict.fromkeys([*keep, text]))
    out = T.StructType([*[source.schema[c] for c in keep], *_ADDED])

    def scanned(batches):
        for batch in batches:
            found = [scan(v.as_py() or "") for v in batch.column(batch.schema.get_field_index(text))]
            for f in found:
                f["places"] = [{"word": w, "label": name} for w, name in f["places"]]
            added = [pa.array([f[name] for f in found], kind) for name, kind in _ARROW.items()]
            kept = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays([*kept, *added], names=[*keep, *_ARROW])

    return source.mapInArrow(scanned, out)


def op10_licenses(spark, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    found = scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    words = F.transform("places", lambda p: p["word"])
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min(words).alias("first_word"),
        F.array_max(words).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"]))), ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )
