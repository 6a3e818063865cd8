"""R1-R5, and the segmented scan on a run that holds a third of the log."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators.ordering import global_rank, segmented_scan
from tessera.operators.runlog import best_checkpoint, early_stop, eval_points, mark_improved


def test_patience_fixture(spark):
    losses = [5, 4, 4, 4, 4, 4, 4, 3]
    log = spark.createDataFrame([(1, i * 1000, float(v)) for i, v in enumerate(losses)],
                                "run_id BIGINT, iter BIGINT, val_loss DOUBLE")
    kept = early_stop(log, patience=5).orderBy("iter").collect()
    assert len(kept) == 7  # stops at the 7th evaluation
    assert kept[-1]["stopped_here"] and not any(r["stopped_here"] for r in kept[:-1])
    best = best_checkpoint(early_stop(log, 5)).first()
    assert best["best_iter"] == 1000  # the 2nd evaluation; equal losses do not improve
    imp = [r["improved"] for r in mark_improved(log).orderBy("iter").collect()]
    assert imp == [True, True, False, False, False, False, False, True]


def test_eval_points(spark):
    log = spark.createDataFrame([(1, i, 1.0) for i in range(2500)] + [(2, i, 1.0) for i in range(10)],
                                "run_id BIGINT, iter BIGINT, val_loss DOUBLE")
    base = sorted((r["run_id"], r["iter"]) for r in eval_points(log, 1000).collect())
    impr = sorted((r["run_id"], r["iter"]) for r in eval_points(log, 1000, include_last=True).collect())
    assert base == [(1, 0), (1, 1000), (1, 2000), (2, 0)]
    assert impr == [(1, 0), (1, 1000), (1, 2000), (1, 2499), (2, 0), (2, 9)]


def test_hot_run_is_split_and_exact(spark):
    rng = random.Random(5)
    rows = [(0, i, rng.random()) for i in range(3000)]  # one run with a third of all rows
    rows += [(r, i, rng.random()) for r in range(1, 301) for i in range(20)]
    log = spark.createDataFrame(rows, "run_id BIGINT, iter BIGINT, val_loss DOUBLE")
    got = segmented_scan(log, ["iter"], F.col("val_loss"), "min", "m", ["run_id"], buckets=16)
    want = log.withColumn("m2", F.min("val_loss").over(
        Window.partitionBy("run_id").orderBy("iter").rowsBetween(Window.unboundedPreceding, 0)))
    bad = got.join(want, ["run_id", "iter"]).filter(F.col("m") != F.col("m2")).count()
    assert bad == 0
    # the hot run spans several buckets
    b = global_rank(log, ["run_id", "iter"], "r", buckets=16).filter("run_id = 0")
    assert b.agg(F.min("r"), F.max("r")).first()[1] - b.agg(F.min("r")).first()[0] + 1 == 3000


def test_diverged_losses_never_improve(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, i, v) for i, v in enumerate([inf, nan, 3.0, inf, nan, 2.0])] + [(2, i, inf) for i in range(4)] + [(3, 0, None), (3, 1, 1.0)]
    log = spark.createDataFrame(rows, "run_id bigint, iter bigint, val_loss double")
    got = {(r["run_id"], r["iter"]): r["improved"] for r in mark_improved(log).collect()}
    assert {k for k, v in got.items() if v} == {(1, 2), (1, 5), (3, 1)}
    kept = sorted((r["run_id"], r["iter"], r["since"]) for r in early_stop(log, 2).collect())
    assert kept == [(1, 0, 1), (1, 1, 2), (2, 0, 1), (2, 1, 2), (3, 0, 1), (3, 1, 0)]
    best = {r["run_id"]: (r["best_iter"], r["best_val_loss"]) for r in best_checkpoint(log).collect()}
    assert best == {1: (5, 2.0), 2: (None, inf), 3: (1, 1.0)}


def test_early_stop_writes_its_input_once(spark, monkeypatch):
    from tessera.operators import ordering
    calls = []
    monkeypatch.setattr(ordering, "cut_lineage", lambda df: calls.append(df.columns) or df.checkpoint())
    log = spark.createDataFrame([(i % 3, i, float(i % 5)) for i in range(60)], "run_id bigint, iter bigint, val_loss double")
    early_stop(log, 3).collect()
    assert len(calls) == 1
