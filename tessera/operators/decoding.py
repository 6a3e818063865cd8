"""Decoding over long score tables ``row_id, token, logit``.

One row per (row, candidate token). Per-row work (max, normaliser, running
mass) is a window partitioned by ``row_id``; a row's partition holds its
candidates, at most the vocabulary size. Nothing loops over rows in Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.arrays import trim_at_eos as _trim_at_eos
from tessera.functions.arrays import truncate_context as _truncate_context
from tessera.functions.hashing import hash_unit


def temperature(df: DataFrame, t: float, logit: str = "logit") -> DataFrame:
    """Divide logits by the temperature (G1); applied before the penalty."""
    if t <= 0:
        raise ValueError("temperature must be positive")
    return df.withColumn(logit, F.col(logit) / F.lit(float(t)))


def repetition_penalty(df: DataFrame, seen: DataFrame, penalty: float, mode: str = "divide",
                       row: str = "row_id", token: str = "token", logit: str = "logit") -> DataFrame:
    """Penalise each already-seen token once per row.

    ``seen`` is ``row_id, token`` (duplicates allowed: a token is penalised
    once). ``divide`` divides the logit, which *raises* a negative logit;
    ``sign_aware`` divides positive and multiplies negative logits, so a seen
    token always loses mass. The join key (row, token) is unique on both sides.
    """
    if mode not in ("divide", "sign_aware"):
        raise ValueError("mode is 'divide' or 'sign_aware'")
    s = seen.select(F.col(row).alias(row), F.col(token).alias(token)).distinct().withColumn("_seen", F.lit(True))
    j = df.join(s, [row, token], "left")
    pen = F.lit(float(penalty))
    if mode == "divide":
        hit = F.col(logit) / pen
    else:
        hit = F.when(F.col(logit) < 0, F.col(logit) * pen).otherwise(F.col(logit) / pen)
    return j.withColumn(logit, F.when(F.col("_seen"), hit).otherwise(F.col(logit))).drop("_seen")


def softmax(df: DataFrame, row: str = "row_id", logit: str = "logit", out: str = "prob") -> DataFrame:
    """Per-row softmax with the max subtracted for stability."""
    w = Window.partitionBy(row)
    z = F.exp(F.col(logit) - F.max(logit).over(w))
    return df.withColumn("_z", z).withColumn(out, F.col("_z") / F.sum("_z").over(w)).drop("_z")


def _desc_order(row: str, prob: str, token: str):
    return Window.partitionBy(row).orderBy(F.desc(prob), F.asc(token))


def top_p(df: DataFrame, p: float, row: str = "row_id", token: str = "token", prob: str = "prob",
          renormalise: bool = True) -> DataFrame:
    """Nucleus filter (G4) and renormalisation.

    Candidates are sorted by probability, ties by token id. A token is dropped
    iff the mass strictly before it exceeds ``p``, so the top token always
    stays, ``p = 0`` keeps one token and ``p = 1`` keeps all.
    """
    if not 0 <= p <= 1:
        raise ValueError("top_p must be between 0 and 1")
    before = F.sum(prob).over(_desc_order(row, prob, token).rowsBetween(Window.unboundedPreceding, -1))
    kept = df.withColumn("_before", F.coalesce(before, F.lit(0.0))).filter(F.col("_before") <= F.lit(float(p)))
    kept = kept.drop("_before")
    if renormalise:
        kept = kept.withColumn(prob, F.col(prob) / F.sum(prob).over(Window.partitionBy(row)))
    return kept


def sample_token(df: DataFrame, seed: int, step: int | str = 0, row: str = "row_id", token: str = "token",
                 prob: str = "prob", out: str = "next_token") -> DataFrame:
    """One token per row by inverse CDF.

    ``u = md5(seed|row|step)`` as a unit double; the pick is the first
    candidate, in (probability desc, token asc) order, whose running mass
    exceeds ``u`` times the row's total. ``step`` may name a column.
    """
    # as text, which is no part of generated code: a loop over steps compiles its plan once
    st = F.col(step) if isinstance(step, str) else F.lit(str(step))
    w = _desc_order(row, prob, token)
    cum = F.sum(prob).over(w.rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum(prob).over(Window.partitionBy(row))
    u = hash_unit(seed, row, st)
    ranked = (df.withColumn("_cum", cum).withColumn("_tot", total)
              .withColumn("_pos", F.row_number().over(w)))
    # one aggregate: the first position past u (min_by skips NULL positions),
    # and the last candidate for when rounding leaves u * total above every sum
    hit_pos = F.when(F.col("_cum") > u * F.col("_tot"), F.col("_pos"))
    return ranked.groupBy(row).agg(
        F.coalesce(F.min_by(F.col(token), hit_pos), F.max_by(F.col(token), F.col("_pos"))).alias(out))


def truncate_context(df: DataFrame, n: int, col: str = "tokens") -> DataFrame:
    """Keep the last ``n`` ids."""
    return df.withColumn(col, _truncate_context(col, n))


def trim_at_eos(df: DataFrame, eos: int, col: str = "tokens") -> DataFrame:
    """Cut each sequence after its first eos, eos kept."""
    return df.withColumn(col, _trim_at_eos(col, eos))
