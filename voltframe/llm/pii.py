"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

SQL functions only. Matches of one kind are leftmost and do not overlap; the pieces between them,
which a split by the same pattern yields, give positions in code points. Nearby words are looked for
in the whole text, whatever other matches lie between.

Kinds: email, ip (parts at most 255), card (14 to 19 digits passing Luhn), phone (10 to 15 digits);
these need no context. Further kinds: iban (mod 97; of its country's length, and for countries not
listed the longest that ends with a word), ssn and secret (long hexadecimal strings), of
which the last two count only where words nearby speak for them.

Cases: a null text has no spans and stays null when redacted; equal spans of different kinds are
all reported; equal rows are kept; an empty table gives an empty one. Extra columns are kept; find_pii
replaces one named pii, redact returns the input's columns, whatever their names. The patterns use possessive quantifiers, so that long runs of digits or letters take time
in proportion to their length.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import fresh, let, packed, table, unpacked


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    score: float
    near: str  # words nearby that raise the score
    label: str


_LOCAL = "A-Za-z0-9._%+-"
KINDS = (
    # A match begins where a run of its characters does, or where the match before it has ended.
    Kind("email", rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 0.9, r"e-?mail|contact|write|mailto|reach", "<EMAIL>"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 0.6, r"ip|address|host|server|login|logged|client", "<IP>"),
    # Only whole runs of 14 to 19 digits: what a greedy match of any length, checked afterwards, leaves.
    Kind("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])", 0.7, r"card|visa|master|amex|credit|debit|pay|paid|billing", "<CARD>"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0.6, r"phone|call|tel|mobile|fax|cell|whatsapp", "<PHONE>"),
    # Only the first four characters: where it ends is for _iban to find, and the next may begin inside of what follows.
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?:\x20?[A-Z0-9]){11})", 0.8, r"iban|bank|account|konto|compte|cuenta", "<IBAN>"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", 0.3, r"ssn|social|security|taxpayer", "<SSN>"),
    Kind("secret", r"(?<![A-Za-z0-9])[A-Fa-f0-9]{32,64}+(?![A-Za-z0-9])", 0.3, r"token|secret|key|password|passwd|pwd|bearer|auth", "<SECRET>"),
)
BASE = ("email", "ip", "card", "phone")
THRESHOLD, BONUS = 0.5, 0.3
#: Code points before and after a match in which context words count.
BEFORE, AFTER = 40, 20
#: Characters of an IBAN without blanks, by its country.
IBAN_LENGTH = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
#: An IBAN of 34 characters with a blank between any two behind the first four, and the character after it.
IBAN_REACH = 4 + 2 * 30 + 1
SPAN = "array<struct<start:bigint,rank:int,end:bigint,kind:string,score:double>>"


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    turned = F.split(F.reverse(digits), "")
    value = lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0))
    return F.aggregate(F.transform(turned, value), F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an IBAN without blanks passes the mod-97 check: the first four characters go last."""
    moved = F.split(F.concat(F.substring(iban, 5, 64), F.substring(iban, 1, 4)), "")
    code = lambda c: F.ascii(c)
    step = lambda a, c: F.when(code(c) <= 57, (a * 10 + code(c) - 48) % 97).otherwise((a * 100 + code(c) - 55) % 97)
    return F.aggregate(moved, F.lit(0), step) == 1


def _valid(kind: str, match: Column) -> Column | None:
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: F.coalesce(p.try_cast("bigint") <= 255, F.lit(False)))
    if kind == "card":
        return luhn(digits_of(match))
    if kind == "phone":
        return F.length(digits_of(match)).between(10, 15)
    if kind == "iban":
        return match.isNotNull()
    return None


def _iban(ahead: Column) -> Column:
    """The IBAN that a text of IBAN_REACH characters begins with, or null."""
    lengths = F.create_map(*[F.lit(v) for n, countries in IBAN_LENGTH.items() for c in countries.split() for v in (c, n)])

    def within(w: Column) -> Column:
        def good(end: Column) -> Column:
            bare = F.replace(F.left(w, end), F.lit(" "), F.lit(""))
            fits = F.left(w, end).rlike(r"\A[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}\z") & ~F.substring(w, end + 1, F.lit(1)).rlike("[A-Za-z0-9]")
            return fits & (F.length(bare) == F.coalesce(F.try_element_at(lengths, F.left(w, F.lit(2))), F.length(bare))) & mod97(bare)

        ends = F.filter(F.sequence(F.length(w), F.lit(15), F.lit(-1)), good)
        return F.left(w, F.get(ends, F.lit(0)))

    return let(ahead, within)


def _spans(text: Column, kind: Kind, rank: int) -> Column:
    none = F.array().cast(SPAN)
    gaps = F.split(text, kind.pattern, -1)

    def part(at: Column, size: Column) -> Column:
        return F.substring(text, at.cast("int") + 1, size.cast("int"))

    def located(m: Column, g: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            start = acc["at"] + F.length(x["gap"])

            def added(match: Column) -> Column:
                end = start + F.length(match)
                near = F.concat_ws(" ", part(F.greatest(start - BEFORE, F.lit(0)), F.least(start, F.lit(BEFORE))), part(end, F.lit(AFTER)))
                score = F.lit(kind.score) + F.when(near.rlike(rf"(?i)(?<![A-Za-z])(?:{kind.near})"), F.lit(BONUS)).otherwise(F.lit(0.0))
                good = _valid(kind.name, match)
                span = F.struct(start.cast("bigint").alias("start"), F.lit(rank).alias("rank"), end.cast("bigint").alias("end"), F.lit(kind.name).alias("kind"), F.least(score, F.lit(1.0)).alias("score"))
                return F.array(span) if good is None else F.when(good, F.array(span)).otherwise(none)

            if kind.name == "iban":
                # heads may lie in an IBAN that has been found
                until = F.coalesce(F.get(acc["out"], F.size(acc["out"]) - 1)["end"], F.lit(0))
                more = let(F.when(start >= until, _iban(part(start, F.lit(IBAN_REACH)))), added)
            else:
                more = added(x["match"])
            return F.struct((start + F.length(x["match"])).cast("bigint").alias("at"), F.concat(acc["out"], more).alias("out"))

        rows = F.transform(m, lambda x, i: F.struct(F.get(g, i).alias("gap"), x.alias("match")))
        return F.aggregate(rows, F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("out")), step, lambda acc: acc["out"])

    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    return let(matches, lambda m: F.when(F.size(m) > 0, let(gaps, lambda g: located(m, g))).otherwise(none))


def spans(text: Column, kinds=KINDS) -> Column:
    """All confirmed spans of a text, ordered by start, then by kind: start, rank, end, kind, score."""
    text = F.coalesce(text, F.lit(""))
    return F.sort_array(F.concat(*[_spans(text, k, i) for i, k in enumerate(kinds)]))


def find_pii(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs with `pii`: the spans whose score reaches the threshold."""
    docs = fresh(docs, "pii")
    return docs.withColumn("pii", F.filter(spans(F.col(text)), lambda x: x["score"] >= threshold))


def redact(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs with the label of its kind in place of every span; of overlapping spans the first counts."""
    marked = docs.select(packed(docs), F.col(text).alias("whole"), F.filter(spans(F.col(text)), lambda x: x["score"] >= threshold).alias("pii"))
    labels = F.create_map(*[F.lit(v) for k in KINDS for v in (k.name, k.label)])
    whole = F.col("whole")

    def step(acc: Column, x: Column) -> Column:
        inside = x["end"] <= acc["at"]
        fresh_text = F.concat(F.substring(whole, acc["at"].cast("int") + 1, F.greatest(x["start"] - acc["at"], F.lit(0)).cast("int")), F.when(x["start"] >= acc["at"], F.element_at(labels, x["kind"])).otherwise(F.lit("")))
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), F.when(inside, acc["out"]).otherwise(F.concat(acc["out"], fresh_text)).alias("out"))

    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    rest = lambda acc: F.concat(acc["out"], F.substring(whole, acc["at"].cast("int") + 1, F.length(whole)))
    clean = F.when(F.size("pii") > 0, F.aggregate("pii", zero, step, rest)).otherwise(whole)
    return marked.select(*[clean.alias(c) if c.lower() == text.lower() else value for c, value in zip(docs.columns, unpacked(docs), strict=True)])


def _joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def op9_pii(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    base = lambda x: x["kind"].isin(*BASE)
    found = docs.select("doc_id", spans(F.col("text")).alias("found"))
    # base spans stay whatever their score; the others need theirs
    found = found.select("doc_id", F.filter("found", lambda x: base(x) | (x["score"] >= THRESHOLD)).alias("found"))
    count = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count(kind) for kind in BASE],
        F.sha2(_joined(F.filter("found", base)).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("found")).alias("spans"),
    )
