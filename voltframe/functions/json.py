"""Dynamically typed JSON as VARIANT: what a value is, told from what it could be cast to."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What a line needs to be more than blank: anything but Unicode white space.
NOT_BLANK = r"[^\s\x1C-\x1F\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"


def parse_strict(text: Column) -> Column:
    """VARIANT of a text that is one JSON value and nothing else; null otherwise.

    The parser stops after the first value. What follows it would have to close both an array and an
    object to pass in both wrappings, which no text can.
    """
    in_array = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    in_object = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    return F.when(in_array.isNotNull() & in_object.isNotNull(), F.try_parse_json(text))


def is_object(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))


class Field:
    """One field of a VARIANT object. Missing, null and values of any kind are told apart."""

    def __init__(self, record: Column, name: str):
        quoted = name.replace("\\", "\\\\").replace('"', '\\"')
        self.value = F.try_variant_get(record, f'$["{quoted}"]', "variant")
        self.kind = F.schema_of_variant(self.value)

    def as_type(self, kind: str) -> Column:
        return F.try_variant_get(self.value, "$", kind)

    @property
    def missing(self) -> Column:
        return self.value.isNull()

    @property
    def is_string(self) -> Column:
        return F.coalesce(self.kind == "STRING", F.lit(False))

    @property
    def number(self) -> Column:
        """The value as a double if it is a JSON number, else null; true and "1" are no numbers."""
        return F.when(self.kind.rlike("^(BIGINT|DECIMAL|DOUBLE)"), self.as_type("double"))

    @property
    def finite(self) -> Column:
        x = self.number
        return F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))

    @property
    def truthy(self) -> Column:
        """False for missing, null, false, 0, "", [] and {}."""
        return (
            F.when(self.missing | (self.kind == "VOID"), False)
            .when(self.kind == "BOOLEAN", self.as_type("boolean"))
            .when(self.kind == "STRING", self.as_type("string") != "")
            .when(self.number.isNotNull(), self.number != 0)
            .otherwise(~F.to_json(self.value).isin("[]", "{}"))
        )

    def whole(self, default: int) -> Column:
        """The value if it is a JSON integer, the default if the field is missing, else null."""
        return F.when(self.missing, F.lit(default).cast("bigint")).when(self.kind == "BIGINT", self.as_type("bigint"))
