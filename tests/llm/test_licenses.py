from __future__ import annotations

import random
import re

import pytest

from voltframe.llm import licenses
from voltframe.llm.licenses import BASE_PHRASES, evaluate, postfix, scan, tokens

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute(text):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    places = []
    for phrase, label in BASE_PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(w)) if w[i : i + len(p)] == p]
    return len(w), sorted(places)


PARTS = ["GNU", "General", "Public", "License", "apache", "license", "cc", "by", "BY", "mit", " ", "-", "é", " ", "\x85", ",", "\n", "licenses", "SPDX-License-Identifier: MIT"]


def test_places_against_brute_force():
    rnd = random.Random(1)
    texts = [rnd.choice([" ", "-", ""]).join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 30))) for _ in range(3000)] + ["cc by cc by cc by", "", "mit license" * 3]
    for t in texts:
        s = scan(t)
        assert (s["n_words"], sorted(s["places"])) == brute(t)
        assert 0 <= s["score"] <= 1 and {label for _, label in s["places"]} <= set(s["labels"])


@pytest.mark.parametrize(
    ("expression", "names", "score"),
    [
        ("MIT", {"mit"}, 1.0),
        ("MIT OR GPL-2.0-only", {"mit", "gpl-2.0-only"}, 1.0),
        ("MIT AND GPL-2.0-only", {"mit", "gpl-2.0-only"}, 0.4),
        ("GPL-2.0-only WITH Classpath-exception-2.0", {"gpl-2.0-only"}, 0.6),
        ("AGPL-3.0 OR MIT AND GPL-3.0", {"agpl-3.0", "mit", "gpl-3.0"}, 0.4),
        ("(AGPL-3.0 or MIT) and GPL-3.0", {"agpl-3.0", "mit", "gpl-3.0"}, 0.4),
        ("(CC-BY-NC-4.0 AND MIT) OR CC-BY-4.0", {"cc-by-nc-4.0", "mit", "cc-by-4.0"}, 0.9),
        ("Foo-1.0", {"foo-1.0"}, licenses.UNKNOWN),
    ],
)
def test_expressions(expression, names, score):
    found, value = evaluate(tokens(expression))
    assert found == names and abs(value - score) < 1e-9


def test_postfix_order_and_errors():
    assert postfix(tokens("a OR b AND c WITH d")) == ["a", "b", "c", "d", "with", "and", "or"]
    for bad in ("", "AND a", "a b", "(a", "a)", "a AND", "()", "a OR OR b"):
        with pytest.raises(ValueError):
            postfix(tokens(bad))


def test_tags_in_prose():
    s = scan("// SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause some prose\nrest")
    assert s["expressions"] == ["( MIT OR Apache-2.0 ) AND BSD-3-Clause"] and s["score"] == 1.0
    assert s["labels"] == ["spdx:apache-2.0", "spdx:bsd-3-clause", "spdx:mit"]
    assert scan("SPDX-License-Identifier: AND OR")["labels"] == ["spdx:and"] and scan("spdx license identifier")["labels"] == []


def test_long_expressions_are_read_to_the_end_of_the_line():
    names = [f"LicenseRef-Vendor-{i}" for i in range(3000)]
    s = scan("SPDX-License-Identifier: " + " OR ".join([*names, "MIT"]) + "\nOR Zlib")
    assert s["labels"] == sorted([f"spdx:{n.lower()}" for n in names] + ["spdx:mit"]) and s["score"] == 1.0
    assert scan("SPDX-License-Identifier: " + " AND ".join(["MIT"] * 100 + ["AGPL-3.0"]))["score"] == 0.2


def test_each_tag_of_a_line_counts():
    s = scan("SPDX-License-Identifier: MIT " + "word " * 200 + "SPDX-License-Identifier: Apache-2.0 OR SPDX-License-Identifier:Zlib")
    assert s["expressions"] == ["MIT", "Apache-2.0", "Zlib"]
    assert scan("SPDX-License-Identifier:\n")["score"] == 0.0


def test_unparsable_expressions_are_reported_by_their_identifiers():
    named = lambda expression: scan(f"SPDX-License-Identifier: {expression}\nMIT)")["labels"]
    assert named("(GPL-2.0 OR") == ["spdx:gpl-2.0"]
    assert named("((MIT OR Apache-2.0) AND BSL-1.0 some prose") == ["spdx:apache-2.0", "spdx:bsl-1.0", "spdx:mit"]
    assert named("(GPL-2.0 WITH Classpath-exception-2.0 OR") == ["spdx:gpl-2.0"]
    assert named("AND MIT") == ["spdx:mit"] and named("()") == [] and named("AND OR") == ["spdx:and"]


def test_frame(spark):
    rows = [(1, "Released under the MIT License.", "x", "old"), (2, None, "y", "old"), (2, None, "y", "old"), (3, "mit licenses", "z", "old"), (4, "cc by " * 20000, "w", "old")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, Labels string")
    out = licenses.scan_licenses(df)
    assert out.columns == ["doc_id", "text", "source", "n_words", "places", "labels", "expressions", "score"]
    got = sorted((r.doc_id, r.n_words, len(r.places), r.labels, r.score) for r in out.collect())
    assert got == [(1, 5, 1, ["mit"], 1.0), (2, 0, 0, [], 0.0), (2, 0, 0, [], 0.0), (3, 2, 0, [], 0.0), (4, 40000, 20000, ["cc-by"], 0.9)]
    assert licenses.scan_licenses(df.limit(0)).count() == 0
