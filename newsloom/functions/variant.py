"""JSON messages as VARIANT values.

Messages have no fixed schema, and an absent key, a null and an empty value are
three different inputs. A VARIANT keeps them apart; a struct would not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.once import computed
from newsloom.functions.text import strip

JSON_BLANKS = " \t\n\r"


def is_object(value: Column, parsed: Column) -> Column:
    """True when the JSON text was parsed and is an object (judged by its first character)."""
    return parsed.isNotNull() & F.startswith(F.ltrim(value, F.lit(JSON_BLANKS)), F.lit("{"))


def field(message: Column, name: str) -> Column:
    """The field as VARIANT: SQL null when the key is absent, variant null when it is null."""
    return F.try_variant_get(message, f"$['{name}']", "variant")


def with_fields(parsed: DataFrame, names: list[str]) -> DataFrame:
    """Add the fields ``names`` of the message ``_m`` as VARIANT columns ``_<name>``."""
    return computed(parsed, **{f"_{name}": field(F.col("_m"), name) for name in names})


def read_objects(messages: DataFrame, names: list[str]) -> DataFrame:
    """Add the parsed JSON text ``_m`` of ``value``, ``_is_object``, and the fields ``names``
    as VARIANT columns ``_<name>``."""
    parsed = computed(messages, _m=F.try_parse_json("value"))
    return with_fields(parsed.withColumn("_is_object", is_object(F.col("value"), F.col("_m"))), names)


def absent(v: Column) -> Column:
    return v.isNull()


def given(v: Column) -> Column:
    """True when the key is there with a value other than null."""
    return v.isNotNull() & ~F.is_variant_null(v)


def kind(v: Column) -> Column:
    """Type name of the value: STRING, BIGINT, BOOLEAN, VOID, ARRAY<...>, OBJECT<...>."""
    return F.schema_of_variant(v)


def is_text(v: Column) -> Column:
    return v.isNotNull() & (kind(v) == "STRING")


def is_nested(v: Column) -> Column:
    return v.isNotNull() & (kind(v).startswith("ARRAY") | kind(v).startswith("OBJECT"))


def as_text(v: Column) -> Column:
    """A scalar as text (``True``/``False`` for booleans), a list or object as JSON;
    null when absent or null."""
    flag, text = F.try_variant_get(v, "$", "boolean"), F.try_variant_get(v, "$", "string")
    # A whole number that fits in a long is no decimal, so a short decimal without a point was written with a zero behind one.
    return (
        F.when(kind(v) == "BOOLEAN", F.when(flag, F.lit("True")).otherwise(F.lit("False")))
        .when(is_nested(v), F.to_json(v))
        .when(kind(v).startswith("DECIMAL") & ~text.contains(".") & (F.length(text) <= 18), F.concat(text, F.lit(".0")))
        .otherwise(text)
    )


def text_or(v: Column, default: str | Column = "") -> Column:
    """The value as text; ``default`` when the key is absent, an empty text when it is null."""
    fallback = F.lit(default) if isinstance(default, str) else default
    return F.when(absent(v), fallback).otherwise(F.coalesce(as_text(v), F.lit("")))


def truthy(v: Column) -> Column:
    """False for absent, null, false, zero and empty values, else true ("false" is true)."""
    empty = F.to_json(v).isin("false", "0", "0.0", "-0.0", '""', "[]", "{}")
    return given(v) & ~empty


def text_list(v: Column) -> Column:
    """A list of texts: null items dropped, a blank text gives an empty list, any other
    single value a list of one."""
    none = F.array().cast("array<string>")
    items = F.try_variant_get(v, "$", "array<variant>")
    words = F.transform(F.filter(items, given), as_text)
    single = F.try_variant_get(v, "$", "string")
    return (
        F.when(~given(v), none)
        .when(kind(v).startswith("ARRAY"), words)
        .when(is_text(v), F.when(strip(single) == "", none).otherwise(F.array(single)))
        .otherwise(F.array(as_text(v)))
    )


def json_text(v: Column) -> Column:
    """JSON with sorted keys and unescaped characters; an absent value is an empty object."""
    return F.when(absent(v), F.lit("{}")).when(F.is_variant_null(v), F.lit("null")).otherwise(F.to_json(v))
