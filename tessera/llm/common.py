"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import cut_lineage, ensure_checkpoint_dir  # noqa: F401  re-exported


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str) -> Column:
    """Column by exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def boxed(df: DataFrame) -> DataFrame:
    """The input row as one struct column ``row``, so that working columns can
    have any name without meeting an input column of that name."""
    return df.select(F.struct(*[col(c) for c in df.columns]).alias("row"))


def row_schema(df: DataFrame, ddl: str) -> T.StructType:
    """The schema of the boxed ``row`` and the columns of ``ddl`` (a DDL text of the row's own
    type would not hold names with dots or blanks)."""
    return T.StructType([df.schema["row"], *T.StructType.fromDDL(ddl).fields])


def field(name: str) -> Column:
    return F.col("row").getField(name)


def unboxed(df: DataFrame, **out: Column) -> DataFrame:
    """Back to the input's columns plus ``out``; an input column whose name
    (in any case) is that of an output column is replaced by it."""
    taken = {k.lower() for k in out}
    names = [f.name for f in df.schema["row"].dataType.fields if f.name.lower() not in taken]
    return df.select(*[field(c).alias(c) for c in names], *[v.alias(k) for k, v in out.items()])


def _hashable(t: T.DataType) -> bool:
    if isinstance(t, T.StructType):
        return all(_hashable(f.dataType) for f in t.fields)
    if isinstance(t, T.ArrayType):
        return _hashable(t.elementType)
    return not isinstance(t, (T.MapType, T.VariantType))


def row_hash(df: DataFrame, seed: int) -> Column:
    """64-bit hash of the boxed row (maps and variants left out): rows that tie
    on it and on the order key before it are interchangeable."""
    names = [f.name for f in df.schema["row"].dataType.fields if _hashable(f.dataType)]
    return F.xxhash64(F.lit(seed), *[field(c) for c in names])


def text_key(text: Column) -> Column:
    """128-bit content key of a text: two independently seeded 64-bit hashes."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit("second"), text).alias("b"))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the session's shared folder: like a checkpoint, but
    packed, and readers take only the columns they need."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BROADCAST_BYTES = 32 << 20


def small(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df`` with a broadcast hint if its measured size allows one, else as it is.
    The rows are counted first (call it on a written table), so what is broadcast
    never grows past ``BROADCAST_BYTES``; the result's rows are the same either way."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else (``lower`` alone would fold É too)."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
