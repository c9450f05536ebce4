"""Rules that depend on the JSON kind of a value.

Parsed records carry such fields as VARIANT. An absent key is SQL NULL, a JSON
null is a variant of kind VOID, and a quoted "true" differs from a bare true.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Filled with the record's text exactly where a field of it could not be read.
UNREADABLE = "_corrupt_record"


def record_schema(text_fields=(), variant_fields=()) -> T.StructType:
    """Schema for one ``from_json`` pass over a raw record."""
    return T.StructType(
        [T.StructField(n, T.StringType()) for n in text_fields]
        + [T.StructField(n, T.VariantType()) for n in variant_fields]
    )


def read_record(text: Column, text_fields=(), variant_fields=()) -> Column:
    """A record's fields, and ``UNREADABLE``, which tells an absent field from a bad one.

    Of a repeated member the last value counts, for VARIANT fields under the setting
    that ``tierlake.session`` requires.
    """
    schema = record_schema(text_fields, variant_fields).add(UNREADABLE, T.StringType())
    return F.from_json(text, schema, {"columnNameOfCorruptRecord": UNREADABLE})


def array_elements(text: Column) -> Column:
    """Element texts of a JSON array; a single NULL when the text is not one array."""
    # The outer brackets make text after the array's end a parse error. The array around
    # the result lets a function look at it several times and the text be parsed once.
    parsed = F.array(F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<array<string>>"))
    refused = F.array(F.lit(None).cast("string"))

    def whole(outer: Column) -> Column:
        return F.when((F.size(outer) == 1) & outer[0].isNotNull(), outer[0]).otherwise(refused)

    return F.flatten(F.transform(parsed, whole))


def is_missing(v: Column) -> Column:
    return v.isNull()


def member(v: Column, name: str) -> Column:
    """Field of a JSON object as a variant; NULL when the key is absent."""
    return F.try_variant_get(v, f"$.{name}", "variant")


def text_of(v: Column) -> Column:
    """Unquoted text of a scalar; NULL for an absent key and for JSON null."""
    return F.try_variant_get(v, "$", "string")


def string_only(v: Column) -> Column:
    """The text if the value is a JSON string, else NULL."""
    return F.when(F.schema_of_variant(v) == "STRING", text_of(v))


def elements(v: Column, to: str = "variant") -> Column:
    """Elements of a JSON array, NULL if the value is anything else.

    One that is not of the type ``to`` is NULL; with a struct of variants, absent members are.
    """
    return F.try_variant_get(v, "$", f"array<{to}>")


def is_falsy(v: Column) -> Column:
    """Absent, null, false, zero, empty string, empty array or empty object."""
    written = F.to_json(v)
    return is_missing(v) | written.isin("null", "false", '""', "[]", "{}", "0", "0.0", "-0.0")


def is_container(v: Column) -> Column:
    """An array or an object; false for an absent key."""
    return F.coalesce(F.substring(F.to_json(v), 1, 1).isin("[", "{"), F.lit(False))


def flag(v: Column) -> Column:
    """1 for a bare true or a number equal to one, else 0 (absent and quoted values too)."""
    return F.when(F.to_json(v).isin("true", "1", "1.0"), 1).otherwise(0)


def real_text(v: Column) -> Column:
    """Text from which a REAL cast reads its number; booleans count as 1 and 0."""
    return (
        F.when(F.schema_of_variant(v) == "BOOLEAN", F.try_variant_get(v, "$", "int").cast("string"))
        .otherwise(text_of(v))
    )


def strict_money(v: Column) -> Column:
    """Number, boolean or fully numeric string as DECIMAL(18,4); NULL otherwise."""
    return F.try_variant_get(v, "$", "decimal(18,4)")


def strict_int(v: Column) -> Column:
    """Number cut toward zero, or a string of an integer; NULL otherwise ("2.5" too)."""
    return F.try_variant_get(v, "$", "bigint")


def when_missing(v: Column, default: Column, otherwise: Column) -> Column:
    """Default for an absent key only. A JSON null falls through to ``otherwise``."""
    return F.when(is_missing(v), default).otherwise(otherwise)
