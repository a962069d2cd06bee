from __future__ import annotations

import random

import pytest

from voltframe.llm import token_counts

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
PATH = public.path("byte_bpe_50k.json")
PARTS = [" ", "  ", "\n", "\t", "\r\n", "a", "foo", "Bar", "'s", "'ll", "12", "½", "²", "é", "é", "漢字", "\U0001f600", " ", " ", "\x1c", "\x1f", "\x85", "<|endoftext|>", "<|endof", "_", "!!", "\x00", "​", "　", "ß", "\x0b", "\x0c", "٣", "﻿", "᠎", " "]


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(PATH)
    return lambda texts: [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]


def test_counts_are_the_librarys(library):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 30))) for _ in range(6000)]
    texts += [" " * 5000, "a" * 3000, "\n" * 999, "<|endoftext|>" * 50, "", "ab" * 2000 + " " + "x" * 70]
    counter = token_counts.Counter(PATH)
    assert [counter.count(t) for t in texts] == library(texts)


def test_small_tables_change_nothing(library):
    texts = [" ".join(f"word{i * j % 37}," for j in range(50)) for i in range(40)]
    counter = token_counts.Counter(PATH, table_size=3, chunk_table_size=2)
    assert [counter.count(t) for t in texts] == library(texts)


def test_merges_by_definition():
    counter = token_counts.Counter(PATH)

    def brute(piece):
        number = list(piece)
        while True:
            best = min(((r >> 32, i) for i in range(len(number) - 1) if (r := counter.ranks.get(number[i] << 32 | number[i + 1])) is not None), default=None)
            if best is None:
                return len(number)
            i = best[1]
            number[i : i + 2] = [counter.ranks[number[i] << 32 | number[i + 1]] & 0xFFFFFFFF]

    rnd = random.Random(1)
    for _ in range(500):
        piece = "".join(rnd.choice("aetn  é!0") for _ in range(rnd.randint(0, 30))).encode()
        assert counter.merged(piece) == brute(piece)


def test_frame(spark, library):
    rows = [(1, "hello world", "x", 5), (2, None, "y", 6), (3, "", "z", 7), (3, "", "z", 7), (4, "long " * 600, "w", 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, N_tokens int")
    out = token_counts.token_counts(df, PATH)
    assert out.columns == ["doc_id", "text", "source", "n_bytes", "n_tokens", "over_limit"]
    got = sorted((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in out.collect())
    assert got == [(1, 11, 2, False), (2, 0, 0, False), (3, 0, 0, False), (3, 0, 0, False), (4, 3000, library(["long " * 600])[0], True)]
    digest = sorted(map(tuple, token_counts._digest(df, PATH).collect()))
    assert digest == got
    assert token_counts.token_counts(df.limit(0), PATH).count() == 0


@pytest.mark.parametrize("change", [{"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"add_prefix_space": True}}, {"pre_tokenizer": {"use_regex": False}}, {"model": {"ignore_merges": True}}, {"added_tokens": [{"content": "x", "lstrip": True}]}])
def test_files_that_would_be_counted_otherwise_are_refused(tmp_path, change):
    import json

    spec = {"model": {"type": "BPE", "merges": ["a b"]}, "pre_tokenizer": {"type": "ByteLevel"}, "added_tokens": []}
    path = tmp_path / "t.json"
    path.write_text(json.dumps(spec))
    assert token_counts.Counter(str(path)).count("ab b") == 3
    for k, v in change.items():
        spec[k] = {**spec[k], **v} if isinstance(spec.get(k), dict) else v
    path.write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        token_counts.Counter(str(path))
