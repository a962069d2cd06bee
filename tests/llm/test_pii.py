from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from voltframe.llm import pii

PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def brute(text):
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), rank, m.end()))
    return sorted(out)


PARTS = ["1.2.3.4", "999.1.2.3.4.5.6.7", "4111 1111 1111 1111", "4111111111111111", "12-34", "+1 (743) 555-3824", "+12", "a@b.c", "x.y@z.co_q@w.e", " ", "é", ".", "-", "7", "@", "+", "a", "0000255.1.1.1", "1 ", "1-", "😀", "\n"]


def test_base_spans_against_brute_force(spark):
    rnd = random.Random(5)
    docs = [(i, "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 25)))) for i in range(800)]
    docs += [(5000, None), (5001, ""), (5002, "1" * 50000), (5003, "a." * 20000), (5004, "1 " * 20000), (5005, "a@" + "b." * 20000 + "c"), (5006, "+1" + " 2" * 20000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.f for r in df.select("doc_id", pii.spans(F.col("text")).alias("f")).collect()}
    for i, t in docs:
        assert [(x.start, x.rank, x.end) for x in got[i] if x.rank < 4] == brute(t or ""), t


def one(spark, text):
    return [(x.kind, text[x.start : x.end], round(x.score, 2)) for x in spark.createDataFrame([(text,)], "t string").select(pii.spans(F.col("t")).alias("f")).first().f]


def test_checksums_and_context(spark):
    assert one(spark, "iban DE89 3704 0044 0532 0130 00.") == [("iban", "DE89 3704 0044 0532 0130 00", 1.0)]
    assert one(spark, "see DE88 3704 0044 0532 0130 00.") == []
    assert one(spark, "123-45-6789") == [("ssn", "123-45-6789", 0.3)]
    assert one(spark, "my social security number: 123-45-6789") == [("ssn", "123-45-6789", 0.6)]
    secret = "f33e61083db5dbdf4bd2369d2f80176e57f7fda2"
    assert one(spark, f'token = "{secret}"') == [("secret", secret, 0.6)]
    assert one(spark, "a@b.de") == [("email", "a@b.de", 0.9)]


def test_ibans_before_words_and_numbers(spark):
    de, apart, gb = "DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32"
    # of a country that is not listed: the longest that passes
    other = next(f"ZZ{n:02d}1234 5678 9012 345" for n in range(2, 99) if int(f"1234567890123453535{n:02d}") % 97 == 1)
    tails = ("", " Please", " Thanks", " 2024", " BIC X", " 2024 BIC COBADEFFXXX AND MORE TO COME", "\nX")
    cases = {f"é {iban}{tail}": [iban] for iban in (de, apart, gb, "NO93 8601 1117 947", "MT84MALT011000012345MTLCAST001S") for tail in tails}
    cases |= {f"{other} Please": [other], f"{apart} {gb} {de}, {de}": [apart, gb, de, de]}
    cases |= {bad: [] for bad in (f"{de}x", f"{de}1", f"x{de}", "DE89 3704 0044 0532 0130 01 Please", "DE89 " * 2000)}
    found = spark.createDataFrame([(t,) for t in cases], "t string").select("t", pii.spans(F.col("t")).alias("f")).collect()
    assert {r.t: [r.t[x.start : x.end] for x in r.f if x.kind == "iban"] for r in found} == cases
    text = f"pay to {apart} Please, or {de} 2024"
    assert pii.redact(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().text == "pay to <IBAN> Please, or <IBAN> 2024"


def test_context_counts_whatever_matches_lie_between(spark):
    a, b = "0123456789abcdef" * 2, "f" * 32
    cases = {
        "Social security numbers: 123-45-6789, 234-56-7890, 345-67-8901": [0.6, 0.6, 0.3],  # 40 code points reach the second
        "é ssn: 123-45-6789, 234-56-7890, 345-67-8901": [0.6, 0.6, 0.6],
        "é 123-45-6789, 234-56-7890 ssn": [0.6, 0.6],
        f"keys: {a}, {b}": [0.6, 0.6],
        f"keys:  {a}, {b}": [0.6, 0.3],
        "123-45-6789 " + "x" * 15 + " 234-56-7890 ssn": [0.3, 0.6],
    }
    found = spark.createDataFrame([(t,) for t in cases], "t string").select("t", pii.spans(F.col("t")).alias("f")).collect()
    assert {r.t: [round(x.score, 2) for x in r.f if x.kind in ("ssn", "secret")] for r in found} == cases
    text = "ssn: 123-45-6789, 234-56-7890."
    assert pii.redact(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().text == "ssn: <SSN>, <SSN>."


def test_mod97(spark):
    row = spark.range(1).select(pii.mod97(F.lit("GB82WEST12345698765432")), pii.mod97(F.lit("GB83WEST12345698765432")), pii.luhn(F.lit("79927398713")), pii.luhn(F.lit("79927398710"))).first()
    assert tuple(row) == (True, False, True, False)


def test_redaction_and_columns(spark):
    docs = spark.createDataFrame([(1, "é call +1 (743) 555-3824 or a@b.de!", "x", "old"), (2, None, None, None), (3, "clean", "z", "old")], "doc_id long, text string, source string, pii string")
    out = pii.redact(docs)
    assert out.columns == docs.columns or out.columns == ["doc_id", "text", "source"]
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == {1: "é call <PHONE> or <EMAIL>!", 2: None, 3: "clean"}
    again = {r.doc_id: r.text for r in pii.redact(out).collect()}
    assert again == got
    assert pii.redact(docs.limit(0)).count() == 0


def test_overlapping_kinds_leave_nothing_behind(spark):
    text = "ip 10.0.0.1@mail.example.com end"
    got = pii.redact(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().text
    assert "10.0.0" not in got and "mail.example" not in got and got.startswith("ip <") and got.endswith(" end")


def test_names_of_the_input_meet_none_of_the_operators(spark):
    from voltframe.llm import pii

    df = spark.createDataFrame([(1, "to a@b.example now", "mine", "row", "w")], "doc_id long, text string, pii string, row string, whole string")
    out = pii.redact(df)
    assert out.columns == df.columns and tuple(out.first()) == (1, "to <EMAIL> now", "mine", "row", "w")
    assert pii.redact(df.limit(0)).count() == 0 and pii.find_pii(df.limit(0)).count() == 0
