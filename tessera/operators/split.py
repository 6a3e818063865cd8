"""Exact split, batching, prompt padding, masks and positions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.arrays import pad_mask as _pad_mask
from tessera.functions.arrays import pad_right
from tessera.functions.hashing import hash_key
from tessera.operators.ordering import global_rank, hash_rank
from tessera.operators.vocab import PAD


def split_exact(df: DataFrame, ratio: float, seed: int = 42, key: str = "window_idx",
                out: str = "split", prefix_hex: int = 4) -> DataFrame:
    """Label exactly ``int(n * ratio)`` rows 'train', the rest 'val' (D6).

    The permutation is the order of ``(md5(seed|key), key)``; train is its
    first ``int(n * ratio)`` rows, i.e. every row up to the k-th smallest
    hash. That threshold is found without moving the rows:

    1. count rows per hash prefix (``16 ** prefix_hex`` buckets, a map-side
       partial aggregate; md5 spreads rows evenly over the prefixes);
    2. on the driver, walk the bucket counts (at most ``16 ** prefix_hex``
       rows) to the bucket holding the k-th row;
    3. sort that one bucket (about ``n / 16 ** prefix_hex`` rows) to read the
       threshold, then label every row by a comparison (narrow, no shuffle).

    ``randomSplit`` is not used: its sizes are only expected sizes.
    """
    if not 0 <= ratio <= 1:
        raise ValueError("ratio must be between 0 and 1")
    hd = df.withColumn("_split_h", hash_key(seed, key)).withColumn(
        "_split_b", F.substring("_split_h", 1, prefix_hex))
    counts = sorted((r["_split_b"], r["n"]) for r in
                    hd.groupBy("_split_b").agg(F.count(F.lit(1)).alias("n")).collect())
    n = sum(c for _, c in counts)
    n_train = int(n * ratio)
    if n_train == 0:
        return df.withColumn(out, F.lit("val"))
    if n_train >= n:
        return df.withColumn(out, F.lit("train"))
    before = 0
    for b, c in counts:
        if before + c >= n_train:
            break
        before += c
    need = n_train - before  # rows to take from bucket b, 1 <= need <= c
    thr = (hd.filter(F.col("_split_b") == b).select("_split_h", key)
           .orderBy("_split_h", key).offset(need - 1).limit(1).first())
    h_thr, k_thr = thr["_split_h"], thr[key]
    is_train = (F.col("_split_h") < F.lit(h_thr)) | (
        (F.col("_split_h") == F.lit(h_thr)) & (F.col(key) <= F.lit(k_thr)))
    return hd.withColumn(out, F.when(is_train, "train").otherwise("val")).drop("_split_h", "_split_b")


def assign_batches(df: DataFrame, batch_size: int, seed: int = 42, epoch: int = 0, shuffle: bool = True,
                   key: str = "window_idx", out: str = "batch_id", buckets: int | None = None) -> DataFrame:
    """Add ``out`` (0-based batch) and ``batch_pos`` (0-based place in it).

    Shuffled order is ``md5(seed|epoch|key)``, so each epoch has its own
    order; unshuffled order is ``key``. The last short batch is kept.
    """
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    if shuffle:
        h = "_batch_h"
        ranked = hash_rank(df.withColumn(h, hash_key(seed, F.lit(epoch), key)), h, key, "_r").drop(h)
    else:
        ranked = global_rank(df, [key], "_r", buckets)
    return (ranked.withColumn(out, F.floor((F.col("_r") - 1) / batch_size).cast("bigint"))
            .withColumn("batch_pos", ((F.col("_r") - 1) % batch_size).cast("bigint")).drop("_r"))


def batch_splits(df: DataFrame, batch_size: int, seed: int = 42, epoch: int = 0,
                 split_col: str = "split", key: str = "window_idx") -> DataFrame:
    """Train rows shuffled per epoch, validation rows in order, each split batched."""
    train = assign_batches(df.filter(F.col(split_col) == "train"), batch_size, seed, epoch, True, key)
    val = assign_batches(df.filter(F.col(split_col) == "val"), batch_size, seed, epoch, False, key)
    return train.unionByName(val)


def pad_batches(df: DataFrame, batch_size: int, pad: int = PAD, key: str = "row_id",
                tokens: str = "tokens", out: str = "padded", buckets: int | None = None) -> DataFrame:
    """Group rows into batches of ``batch_size`` in ``key`` order and pad each
    sequence to the longest of its batch (D9). A batch is at most
    ``batch_size`` rows, so the per-batch maximum is a small window."""
    from pyspark.sql import Window
    b = global_rank(df, [key], "_r", buckets).withColumn(
        "batch_id", F.floor((F.col("_r") - 1) / batch_size).cast("bigint")).drop("_r")
    longest = F.max(F.size(tokens)).over(Window.partitionBy("batch_id"))
    return b.withColumn(out, pad_right(tokens, longest, pad))


def with_pad_mask(df: DataFrame, col: str = "x", pad: int = PAD, out: str = "mask") -> DataFrame:
    """Add ``out ARRAY<BOOLEAN>``: true at real tokens."""
    return df.withColumn(out, _pad_mask(col, pad))


def positions(df: DataFrame, col: str = "x", key: str = "window_idx") -> DataFrame:
    """Long form ``key, pos, token`` with 0-based positions."""
    return df.select(key, F.posexplode(col).alias("pos", "token"))
