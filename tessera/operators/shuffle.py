"""Seeded shuffle (P5) and training-input sampling (T5)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tessera.functions.hashing import hash_key
from tessera.operators.ordering import hash_rank


def seeded_shuffle(df: DataFrame, key: str, seed: int = 42, out: str = "shuffle_rank") -> DataFrame:
    """Add ``out``: 1-based position in a seeded permutation of the rows.

    The permutation is the order of ``md5(seed|key)`` (ties by ``key``), so it
    is the same on any cluster and any partitioning. The rank comes from
    hash-prefix buckets plus per-bucket offsets, never from a single-task sort.
    """
    h = "_shuffle_h"
    return hash_rank(df.withColumn(h, hash_key(seed, key)), h, key, out).drop(h)


def sample_input(df: DataFrame, key: str, n: int | None, seed: int = 42) -> DataFrame:
    """Training-input sample: the first ``n`` rows of the seeded permutation.

    The limit is the feature (a sampling cap on trainer input). ``None`` keeps
    every row. Selection is a top-n on the hash, not a full sort.
    """
    if n is None:
        return df
    h = "_sample_h"
    return df.withColumn(h, hash_key(seed, key)).orderBy(h, key).limit(n).drop(h)
