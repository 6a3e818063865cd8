"""Sharding by proportional stratified interleaving.

Rows of each source are put in a seeded random order; the k-th of n rows of a
source gets the fractional rank (k - 1/2) / n; all rows are sorted by that
fraction and the order is cut into shards of equal row count (at most one row
apart). Every contiguous cut of the order holds each source in its share of the
corpus, to within a row or two, so every shard has the corpus mixture.

No window ever sees a whole source or the whole table. A source is numbered in
``buckets`` slices of its hash order, the global order in ``buckets`` slices of
the fraction; slice counts are small aggregates whose running sums are added
back. A source with a third of all rows is thus spread over all slices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import boxed, cut_lineage, field, row_hash, unboxed

BUCKET_BITS = 10


def interleave_shards(docs: DataFrame, n_shards: int, stratum: str = "source", id_col: str = "doc_id",
                      seed: int = 17, bucket_bits: int = BUCKET_BITS) -> DataFrame:
    """Add ``shard`` int (0..n_shards-1) and ``slot`` long (gapless from 0 in a shard).

    Null ``stratum`` values form a stratum of their own. Null or repeated ids are
    allowed: rows that tie on the seeded hash of the id are ordered by a hash of
    the whole row, and rows that tie on that too are interchangeable. Fewer rows
    than shards leave the surplus shards empty; an empty table gives no rows. An
    input column called ``shard`` or ``slot`` is replaced. Text is carried, never
    read. The ranked rows are written once to the checkpoint folder: pass only
    the columns that are needed.
    """
    buckets = 1 << bucket_bits
    rows = boxed(docs)
    rows = rows.select(
        "row",
        F.coalesce(F.concat(F.lit("="), field(stratum).cast("string")), F.lit("null")).alias("s"),
        F.xxhash64(F.lit(seed), field(id_col)).alias("u"),
        row_hash(rows, seed).alias("tie"),
    ).withColumn("b", F.shiftright("u", 64 - bucket_bits))

    running = Window.partitionBy("s").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    slices = (rows.groupBy("s", "b").agg(F.count(F.lit(1)).alias("n"))
              .select("s", "b", F.coalesce(F.sum("n").over(running), F.lit(0)).alias("before"),
                      F.sum("n").over(Window.partitionBy("s")).alias("total")))
    within = Window.partitionBy("s", "b").orderBy("u", "tie")
    ranked = (rows.withColumn("k", F.row_number().over(within)).join(slices, ["s", "b"])
              .withColumn("odd", 2 * (F.col("before") + F.col("k")) - 1)
              # (k - 1/2) / n, and its slice in exact integer arithmetic
              .withColumn("g", F.expr(f"cast((cast(odd as decimal(38,0)) * {buckets}) div (2 * total) as int)"))
              .withColumn("frac", F.col("odd") / (2.0 * F.col("total")))
              .select("row", "s", "u", "tie", "g", "frac"))
    ranked = cut_lineage(ranked)  # read twice: slice counts, then the order itself

    above = Window.orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("g").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cuts = (ranked.groupBy("g").agg(F.count(F.lit(1)).alias("n"))  # at most `buckets` rows
            .select("g", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("above"),
                    F.sum("n").over(everything).alias("rows")))
    order = Window.partitionBy("g").orderBy("frac", "s", "u", "tie")
    placed = (ranked.withColumn("j", F.row_number().over(order)).join(cuts, "g")
              .withColumn("pos", F.col("above") + F.col("j") - 1)
              .withColumn("shard", F.expr(f"cast((pos * {n_shards}) div rows as int)"))
              .withColumn("first", F.expr(f"(shard * rows + {n_shards - 1}) div {n_shards}")))
    return unboxed(placed, shard=F.col("shard"), slot=(F.col("pos") - F.col("first")).cast("bigint"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order inside each file."""
    sharded.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
