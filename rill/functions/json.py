"""JSON message parsing and rendering as Column expressions.

Strict parsing fails the job on the first malformed message; lenient
parsing drops messages that are not JSON objects and keeps partly bad
objects with NULL in the fields that did not convert. Missing fields are
NULL in both modes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rill.functions.columns import as_col

# A message that may be an object: its first character past white space.
_OBJECT_START = r"^\s*\{"


def is_json_object(value) -> Column:
    """True iff the text is a syntactically valid JSON object.

    False for non-JSON text, JSON scalars, arrays and NULL input. Reads the
    object's top-level keys only; no value is materialised.
    """
    return F.json_object_keys(as_col(value)).isNotNull()


def parse_json(value, schema: str, *, lenient: bool = False) -> Column:
    """JSON text -> struct of the declared schema.

    Lenient parsing passes no options (PERMISSIVE is the default); strict
    parsing must fail on any malformed message, so it is never pruned.
    """
    options = {} if lenient else {"mode": "FAILFAST"}
    return F.from_json(as_col(value), schema, options)


def parse_messages(
    df: DataFrame,
    schema: str,
    *,
    value_col: str = "value",
    lenient: bool = False,
    keep: list[str] | tuple[str, ...] = (),
) -> DataFrame:
    """Parse a column of JSON messages into top-level columns.

    ``keep`` names source columns (e.g. topic partition / offset / record
    time) carried next to the parsed fields.

    Each message is parsed once, whole. The parse sits in a generator
    (``inline`` of a one-element array), through which neither the lenient
    check nor a later filter on a parsed field is pushed; as a projection
    it would be copied into those filters and run again. The lenient check
    reads the parsed struct; only a message that did not parse cleanly is
    looked at a second time, to tell partly bad objects (kept) from text
    that is no object (dropped).
    """
    fields = [f"`{f.name}`" for f in T.StructType.fromDDL(schema).fields]
    if not lenient:
        return df.select(*keep, F.inline(F.array(parse_json(value_col, schema)))).select(*keep, *fields)
    corrupt = df.sparkSession.conf.get("spark.sql.columnNameOfCorruptRecord")
    text = F.col(value_col)

    def is_object(message: Column) -> Column:
        clean = message[corrupt].isNull() & text.rlike(_OBJECT_START)
        return clean | (message[corrupt].isNotNull() & is_json_object(text))

    parsed = F.array(parse_json(value_col, f"{schema}, `{corrupt}` STRING", lenient=True))
    return df.select(*keep, F.inline(F.filter(parsed, is_object))).select(*keep, *fields)


def tuple_json(f0, f1, *, keep_nulls: bool = False) -> Column:
    """Two-field record -> ``{"f0":...,"f1":...}``.

    NULL fields are left out unless ``keep_nulls``.
    """
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    return F.to_json(F.struct(as_col(f0).alias("f0"), as_col(f1).alias("f1")), opts)


def record_json(*cols, keep_nulls: bool = False) -> Column:
    """Several named columns -> one JSON object text."""
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    return F.to_json(F.struct(*[as_col(c) for c in cols]), opts)


def require_fields(df: DataFrame, fields: list[str] | tuple[str, ...]) -> DataFrame:
    """Fail the job when a parsed message lacks a declared field.

    ``from_json`` fills missing fields with NULL; a source declared with
    fail-on-missing-field turns that into an error. Runs inside the same
    projection (no extra pass).
    """
    missing = F.concat_ws(
        ",", *[F.when(F.col(f).isNull(), F.lit(f)) for f in fields]
    )
    check = F.when(missing == "", F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("message is missing field(s): "), missing))
    )
    return df.where(check)

