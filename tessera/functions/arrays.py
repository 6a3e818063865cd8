"""Array column helpers for token sequences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pad_right(c, length: int | Column, pad: int) -> Column:
    """Right-pad to ``length`` with ``pad`` (longer arrays are left alone)."""
    a = _col(c)
    n = F.lit(length) if isinstance(length, int) else length
    return F.concat(a, F.array_repeat(F.lit(pad), F.greatest(n - F.size(a), F.lit(0))))


def pad_mask(c, pad: int) -> Column:
    """True where the token is real, false where it is padding."""
    return F.transform(_col(c), lambda t: t != F.lit(pad))


def ensure_bos(c, bos: int) -> Column:
    """Prepend ``bos`` unless the sequence already starts with it.
    An empty sequence becomes ``[bos]``."""
    a = _col(c)
    return F.when((F.size(a) > 0) & (F.element_at(a, 1) == F.lit(bos)), a).otherwise(
        F.concat(F.array(F.lit(bos)), a))


def truncate_context(c, n: int) -> Column:
    """Keep the last ``n`` ids."""
    a = _col(c)
    return F.when(F.size(a) > n, F.slice(a, -n, n)).otherwise(a)


def trim_at_eos(c, eos: int) -> Column:
    """Cut after the first ``eos``, which is kept."""
    a = _col(c)
    p = F.array_position(a, F.lit(eos))
    return F.when(p > 0, F.slice(a, 1, p.cast("int"))).otherwise(a)


def ints_text(c) -> Column:
    """Space-joined ids, the scalar form used for oracle comparison."""
    return F.array_join(_col(c).cast("array<string>"), " ")
