"""Exact sizes, determinism, independence from partitioning."""

import pytest
from pyspark.sql import functions as F

from tessera.operators.split import assign_batches, pad_batches, positions, split_exact, with_pad_mask


@pytest.mark.parametrize("n", [1, 2, 9, 10, 11, 351])
@pytest.mark.parametrize("ratio", [0.9, 0.0, 1.0])
def test_exact_sizes(spark, n, ratio):
    df = spark.range(n).withColumnRenamed("id", "window_idx")
    got = split_exact(df, ratio).groupBy("split").count().collect()
    sizes = {r["split"]: r["count"] for r in got}
    assert sizes.get("train", 0) == int(n * ratio)
    assert sizes.get("val", 0) == n - int(n * ratio)


def test_split_is_the_hash_order_prefix(spark):
    import hashlib
    n = 500
    df = spark.range(n).withColumnRenamed("id", "window_idx")
    got = {r["window_idx"] for r in split_exact(df, 0.3, seed=7).filter("split = 'train'").collect()}
    order = sorted(range(n), key=lambda i: (hashlib.md5(f"7|{i}".encode()).hexdigest(), i))
    assert got == set(order[:int(n * 0.3)])


def test_batches_cover_and_do_not_depend_on_partitions(spark):
    df = spark.range(70).withColumnRenamed("id", "window_idx")
    runs = []
    for parts in (1, 4, 200):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        runs.append(sorted((r["window_idx"], r["batch_id"], r["batch_pos"])
                           for r in assign_batches(df.repartition(3), 32, seed=1, epoch=2).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert runs[0] == runs[1] == runs[2]
    sizes = {}
    for _, b, _ in runs[0]:
        sizes[b] = sizes.get(b, 0) + 1
    assert sizes == {0: 32, 1: 32, 2: 6}  # last short batch kept
    other_epoch = sorted((r["window_idx"], r["batch_id"]) for r in assign_batches(df, 32, seed=1, epoch=3).collect())
    assert other_epoch != [(a, b) for a, b, _ in runs[0]]


def test_pad_batches_mask_positions(spark):
    df = spark.createDataFrame([(0, [2, 5]), (1, [2, 5, 6, 7]), (2, [2]), (3, [2, 9]), (4, [2, 8, 8])],
                               "row_id BIGINT, tokens ARRAY<INT>")
    got = {r["row_id"]: (r["batch_id"], list(r["padded"])) for r in pad_batches(df, 4).collect()}
    assert got[0] == (0, [2, 5, 0, 0]) and got[2] == (0, [2, 0, 0, 0]) and got[4] == (1, [2, 8, 8])
    m = with_pad_mask(spark.createDataFrame([(0, [3, 4, 0, 0])], "window_idx BIGINT, x ARRAY<INT>")).first()
    assert list(m["mask"]) == [True, True, False, False]
    pos = positions(spark.createDataFrame([(0, [3, 4])], "window_idx BIGINT, x ARRAY<INT>")).collect()
    assert [(r["pos"], r["token"]) for r in pos] == [(0, 3), (1, 4)]


def test_split_plan_moves_no_rows(spark):
    df = spark.range(1000).withColumnRenamed("id", "window_idx")
    plan = split_exact(df, 0.9)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
