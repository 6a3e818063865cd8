"""Run-log analysis.

A run log is ``run_id, iter, val_loss`` (plus anything else). Running minima
and "evaluations since the last improvement" are segmented scans: a run that
holds a large share of the log is split over range buckets instead of being
one window partition, and per-run results are partial aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.ordering import bucket_scan, bucketed, segmented_scan


def number_iters(log: DataFrame, order: list, run: str = "run_id", out: str = "iter") -> DataFrame:
    """Add 0-based ``out`` per run in ``order`` (a running count)."""
    n = segmented_scan(log, order, F.lit(1), "sum", "_n", [run])
    return n.withColumn(out, (F.col("_n") - 1).cast("bigint")).drop("_n")


def eval_points(log: DataFrame, every: int, include_last: bool = False, run: str = "run_id",
                it: str = "iter") -> DataFrame:
    """Keep evaluation iterations: ``iter % every == 0`` (iteration 0 included);
    ``include_last`` also keeps each run's last iteration (R1), a partial aggregate."""
    cond = (F.col(it) % every) == 0
    if include_last:
        last = log.groupBy(F.col(run).alias("_run")).agg(F.max(it).alias("_last"))
        return log.join(last, F.col(run).eqNullSafe(F.col("_run"))).filter(cond | (F.col(it) == F.col("_last"))).drop("_run", "_last")
    return log.filter(cond)


def _improved(b: DataFrame, run: str, loss: str) -> DataFrame:
    # a loss must be strictly below the best before it, +inf at the start; NaN (which sorts
    # above +inf) and a missing loss never are
    prev = bucket_scan(b, F.col(loss), "min", "prev_best", [run], exclusive=True)
    prev = prev.withColumn("prev_best", F.least(F.coalesce("prev_best", F.lit(float("inf"))), F.lit(float("inf"))))
    return (prev.withColumn("improved", F.coalesce(F.col(loss) < F.col("prev_best"), F.lit(False)))
            .withColumn("best_so_far", F.least(F.col(loss), F.col("prev_best"))))


def mark_improved(log: DataFrame, run: str = "run_id", it: str = "iter", loss: str = "val_loss") -> DataFrame:
    """Add ``prev_best`` (best loss before this evaluation, +inf before the first),
    ``improved`` (strict ``<``, so a first loss of +inf or NaN is none) and
    ``best_so_far`` (R2)."""
    return _improved(bucketed(log, [run, it]), run, loss).drop("_b", "_local")


def early_stop(log: DataFrame, patience: int = 5, run: str = "run_id", it: str = "iter",
               loss: str = "val_loss") -> DataFrame:
    """Evaluations a run performs under early stopping.

    ``since`` counts evaluations since the last improvement (since the start if
    there was none). The first one with ``since >= patience`` is the last kept; rows
    after it are dropped. Adds ``improved``, ``since`` and ``stopped_here``. All scans
    share one bucketing of the log; the stop itself is a partial aggregate per run.
    """
    m = _improved(bucketed(log, [run, it]), run, loss)
    pos = bucket_scan(m, F.lit(1), "sum", "_pos", [run])
    last = bucket_scan(pos, F.when(F.col("improved"), F.col("_pos")), "max", "_last", [run])
    s = (last.withColumn("since", (F.col("_pos") - F.coalesce("_last", F.lit(0))).cast("bigint"))
         .withColumn("stopped_here", F.col("since") >= patience))
    stop = s.groupBy(F.col(run).alias("_run")).agg(F.min(F.when(F.col("stopped_here"), F.col("_pos"))).alias("_stop"))
    return (s.join(stop, F.col(run).eqNullSafe(F.col("_run"))).filter(F.col("_stop").isNull() | (F.col("_pos") <= F.col("_stop")))
            .drop("_pos", "_last", "_stop", "_run", "_b", "_local", "prev_best", "best_so_far"))


def best_checkpoint(log: DataFrame, run: str = "run_id", it: str = "iter", loss: str = "val_loss") -> DataFrame:
    """Per run: the earliest iteration with the lowest loss (R5), i.e. the last
    checkpoint saved under strict improvement: none (null, best loss +inf) if no loss
    was below +inf. A partial aggregate."""
    counts = F.col(loss) < F.lit(float("inf"))
    return log.groupBy(run).agg(
        F.min_by(F.when(counts, F.col(it)), F.when(counts, F.struct(F.col(loss), F.col(it)))).alias("best_iter"),
        F.coalesce(F.min(F.when(counts, F.col(loss))), F.lit(float("inf"))).alias("best_val_loss"))
