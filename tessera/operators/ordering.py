"""Global order without a single-partition window.

``Window.orderBy(...)`` with no partition key moves every row to one task. The
helpers here do what ``zipWithIndex`` does, in DataFrame form:

1. range-partition on the order keys (Spark samples the keys, so buckets are
   balanced even when the key distribution is not);
2. aggregate one partial per bucket (a few hundred rows), turn those into
   bucket offsets with a window over that tiny table, and broadcast them
   (the offsets table has one row per bucket: its size is the bucket count);
3. finish inside each bucket.

Order keys must form a unique key, so that the result does not depend on how
ties fall and a recomputed partition (lost executor) gives the same numbers.

The bucketed frame is written once with a reliable ``checkpoint()`` before
it is read twice (bucket totals, in-bucket pass). Both reads then see the
same rows in the same buckets: adaptive execution plans each branch on its
own and may read a shuffle differently in each, which would put a row in
different buckets. The checkpoint also cuts lineage, so a lost executor
re-reads files instead of replaying the plan, and downstream plans stay flat.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage, shuffle_partitions

_LOCAL_BITS = 33  # monotonically_increasing_id: partition index << 33 | row position


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def bucketed(df: DataFrame, order: Sequence, buckets: int | None = None) -> DataFrame:
    """``df`` in range buckets ``_b`` with positions ``_local`` inside them, written
    once: the shared start of several scans along one order."""
    nb = buckets or shuffle_partitions(df.sparkSession)
    order = _cols(order)
    ranged = df.repartitionByRange(nb, *order).sortWithinPartitions(*order)
    mid = F.monotonically_increasing_id()
    return cut_lineage(ranged.withColumn("_mid", mid)
                       .withColumn("_b", F.shiftrightunsigned("_mid", _LOCAL_BITS))
                       .withColumn("_local", F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)))
                       .drop("_mid"))


def global_rank(df: DataFrame, order: Sequence, out: str = "rank", buckets: int | None = None) -> DataFrame:
    """Add ``out`` = 1-based position of each row in the total order ``order``.

    One range shuffle; per-bucket counts are a map-side partial aggregate.
    """
    b = bucketed(df, order, buckets)
    counts = b.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    offs = counts.select(
        "_b",
        F.coalesce(F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    return (b.join(F.broadcast(offs), "_b")
            .withColumn(out, (F.col("_off") + F.col("_local") + 1).cast("bigint"))
            .drop("_b", "_local", "_off"))


_OPS = {"sum": F.sum, "min": F.min, "max": F.max}


def _combine(op: str, a: Column, b: Column) -> Column:
    if op == "sum":
        return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
    f = F.least if op == "min" else F.greatest  # both skip NULLs
    return f(a, b)


def segmented_scan(df: DataFrame, order: Sequence, value: Column, op: str, out: str,
                   partition_by: Sequence = (), exclusive: bool = False,
                   buckets: int | None = None) -> DataFrame:
    """Running ``op`` (sum/min/max) of ``value`` along ``order``, restarted per
    ``partition_by`` group.

    A group that holds a large share of the rows is split over many buckets:
    each (bucket, group) slice is scanned on its own, and the carry-in from the
    group's earlier buckets comes from a table with one row per (bucket, group).
    With ``exclusive`` the current row is left out (NULL before the first row
    for min/max, 0 for sum).
    """
    parts = list(partition_by)
    b = bucketed(df.withColumn("_v", value), [*parts, *order], buckets)
    return bucket_scan(b, F.col("_v"), op, out, parts, exclusive).drop("_b", "_local", "_v")


def bucket_scan(b: DataFrame, value: Column, op: str, out: str, partition_by: Sequence = (),
                exclusive: bool = False) -> DataFrame:
    """``segmented_scan`` of an already ``bucketed`` frame, which keeps its buckets,
    so that several scans share one bucketing (and one write)."""
    agg = _OPS[op]
    parts = list(partition_by)
    b = b.withColumn("_v", value)
    partials = b.groupBy("_b", *parts).agg(agg("_v").alias("_p"))
    carry_w = Window.partitionBy(*parts).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = partials.select("_b", *parts, agg("_p").over(carry_w).alias("_carry"))
    hi = -1 if exclusive else 0
    local_w = Window.partitionBy("_b", *parts).orderBy("_local").rowsBetween(Window.unboundedPreceding, hi)
    local = b.withColumn("_run", agg("_v").over(local_w))
    if not parts:
        carry = F.broadcast(carry)  # one row per bucket: its size is the bucket count
    res = local.join(carry, ["_b", *parts], "left").withColumn(out, _combine(op, F.col("_carry"), F.col("_run")))
    if op == "sum" and exclusive:
        res = res.withColumn(out, F.coalesce(F.col(out), F.lit(0)))
    return res.drop("_v", "_carry", "_run")


def prefix_sum(df: DataFrame, order: Sequence, value: Column, out: str,
               exclusive: bool = True, buckets: int | None = None) -> DataFrame:
    """Running sum over the whole table in ``order`` (exclusive by default)."""
    return segmented_scan(df, order, value, "sum", out, (), exclusive, buckets)


def hash_rank(df: DataFrame, hash_col: str, key: str, out: str = "rank", prefix_hex: int = 4) -> DataFrame:
    """1-based position in the order ``(hash_col, key)`` where ``hash_col`` is a
    hex digest (uniform over its prefixes).

    Buckets are the first ``prefix_hex`` hex digits, a pure function of the
    row, so no sampling pass and no materialisation are needed: per-bucket
    counts (a partial aggregate) become an offsets table of at most
    ``16 ** prefix_hex`` rows (broadcast), and rows are numbered inside their
    bucket by a window partitioned on the bucket.
    """
    spark = df.sparkSession
    b = df.withColumn("_hb", F.substring(hash_col, 1, prefix_hex))
    counts = sorted((r["_hb"], r["n"]) for r in b.groupBy("_hb").agg(F.count(F.lit(1)).alias("n")).collect())
    offs, run = [], 0
    for bucket, n in counts:
        offs.append((bucket, run))
        run += n
    if not offs:
        return df.withColumn(out, F.lit(None).cast("bigint"))
    off_df = F.broadcast(spark.createDataFrame(offs, "_hb STRING, _off BIGINT"))
    w = Window.partitionBy("_hb").orderBy(hash_col, key)
    return (b.withColumn("_local", F.row_number().over(w)).join(off_df, "_hb")
            .withColumn(out, (F.col("_off") + F.col("_local")).cast("bigint"))
            .drop("_hb", "_local", "_off"))
