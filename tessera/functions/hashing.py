"""Seeded, engine-independent randomness from ``md5``.

``rand``/``randomSplit`` are neither reproducible across partitionings nor
checkable by an outside oracle; an md5 of ``seed|key`` is both, and is computed
per row with no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_key(seed, *keys) -> Column:
    """Hex md5 of ``seed|k1|k2...``; sorting by it is a seeded permutation."""
    parts = [F.lit(str(seed))]
    for k in keys:
        parts += [F.lit("|"), (F.col(k) if isinstance(k, str) else k).cast("string")]
    return F.md5(F.concat(*parts))


def hash_unit(seed, *keys) -> Column:
    """Uniform double in [0, 1) from the first 32 bits of ``hash_key``."""
    h = hash_key(seed, *keys)
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
