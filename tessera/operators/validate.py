"""Record validation (V1-V4) and the pair filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import is_blank

# Rejection reasons, in rule order.
MALFORMED = "malformed"
NOT_OBJECT = "not_object"
NOT_STRING = "not_string"
EMPTY = "empty"


def _field_type(field: str):
    return F.expr(f"schema_of_variant(variant_get(value, '$.{field}'))")


def classify_qa(raw: DataFrame) -> DataFrame:
    """Add ``error`` (NULL when the record is good) plus typed ``question`` and
    ``answer`` (V1).

    The first failing rule wins: not JSON at all (a NULL value); not an object; question or answer missing or
    not a string (a JSON null is not a string); question or answer empty after
    Unicode strip. Text is only read as a string when its JSON type is string,
    so a number never passes as text.
    """
    kind = F.expr("schema_of_variant(value)")
    q_ok = _field_type("question") == "STRING"
    a_ok = _field_type("answer") == "STRING"
    q = F.when(q_ok, F.expr("variant_get(value, '$.question', 'string')"))
    a = F.when(a_ok, F.expr("variant_get(value, '$.answer', 'string')"))
    typed = raw.select("*", q.alias("question"), a.alias("answer"), kind.alias("_kind"))
    err = (F.when(F.col("value").isNull(), F.lit(MALFORMED))
           .when(~F.col("_kind").startswith("OBJECT"), F.lit(NOT_OBJECT))
           .when(F.col("question").isNull() | F.col("answer").isNull(), F.lit(NOT_STRING))
           .when(is_blank("question") | is_blank("answer"), F.lit(EMPTY)))
    return typed.withColumn("error", err).drop("_kind")


def classify_typed(df: DataFrame) -> DataFrame:
    """V1 for typed string columns (tables, Parquet): NULL is 'not_string'."""
    err = (F.when(F.col("question").isNull() | F.col("answer").isNull(), F.lit(NOT_STRING))
           .when(is_blank("question") | is_blank("answer"), F.lit(EMPTY)))
    return df.withColumn("error", err)


def first_bad(classified: DataFrame) -> DataFrame:
    """The rejected record with the lowest index, or no row: a top-1, no full sort."""
    return classified.filter(F.col("error").isNotNull()).orderBy("idx").limit(1)


def assert_valid(classified: DataFrame) -> DataFrame:
    """Fail on the lowest-index bad record, quoting its index and reason (V2).

    An empty corpus passes. One row at most comes to the driver. Returns the input
    for chaining.
    """
    cols = ["idx", "error"] + (["value"] if "value" in classified.columns else [])
    first = first_bad(classified).select(*cols)
    if "value" in cols:
        first = first.withColumn("value", F.to_json("value"))
    rows = first.collect()
    if rows:
        r = rows[0]
        shown = f": {r['value']}" if "value" in cols else ""
        raise ValueError(f"record {r['idx']} rejected ({r['error']}){shown}")
    return classified


def quarantine(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split into (good, rejected) so one bad row does not sink a large job (V3)."""
    good = classified.filter(F.col("error").isNull()).drop("error")
    bad = classified.filter(F.col("error").isNotNull())
    if "value" in bad.columns:
        bad = bad.withColumn("value", F.to_json("value"))
    return good, bad


def validation_report(classified: DataFrame) -> DataFrame:
    """Rows per outcome ('ok' or the reason) with the first index of each (V4).

    A map-side partial aggregate: a few rows leave each partition.
    """
    return (classified.groupBy(F.coalesce("error", F.lit("ok")).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("n_records"), F.min("idx").alias("first_idx")))


def has_pair(df: DataFrame) -> DataFrame:
    """Keep records with both fields present."""
    return df.filter(F.col("question").isNotNull() & F.col("answer").isNotNull())
