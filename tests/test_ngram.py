"""L1-L4 and L2 against plain-Python counting on a small window table."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators.sparse_scores import Merged, Shared
from tessera.operators.ngram import eval_loss, fit_ngram, score_interpolated, score_next, token_losses

WINDOWS = [(0, [5, 6, 7, 5], [6, 7, 5, 6]), (1, [7, 5, 6, 0], [5, 6, 0, 0]), (2, [6, 6, 7, 8], [6, 7, 8, 5])]
LAM = (0.1, 0.2, 0.3, 0.4)
V = 12


def py_model(wins):
    c = Counter()
    for _, x, y in wins:
        for t, tok in enumerate(y):
            if tok == 0:
                continue
            c[(1, "", tok)] += 1
            c[(2, str(x[t]), tok)] += 1
            if t >= 1:
                c[(3, f"{x[t-1]} {x[t]}", tok)] += 1
    tot = Counter()
    for (k, h, _), n in c.items():
        tot[(k, h)] += n
    return c, tot


def py_prob(c, tot, x, t, tok):
    num, den = LAM[0] / V, LAM[0]
    ctx = {1: "", 2: str(x[t])}
    if t >= 1:
        ctx[3] = f"{x[t-1]} {x[t]}"
    for k, h in ctx.items():
        if (k, h) in tot:
            num += LAM[k] * c[(k, h, tok)] / tot[(k, h)]
            den += LAM[k]
    return num / den


@pytest.fixture()
def wins(spark):
    return spark.createDataFrame(WINDOWS, "window_idx BIGINT, x ARRAY<INT>, y ARRAY<INT>")


def test_counts_and_losses(spark, wins):
    lm = fit_ngram(wins.filter("window_idx < 2"), 3, V, LAM)
    c, tot = py_model(WINDOWS[:2])
    got = {(r["order"], r["ctx"], r["token"]): r["n"] for r in lm.counts.collect()}
    assert got == dict(c)
    tl = {(r["window_idx"], r["t"]): r["loss"] for r in token_losses(wins.filter("window_idx = 2"), lm).collect()}
    _, x, y = WINDOWS[2]
    for t, tok in enumerate(y):
        assert tl[(2, t)] == pytest.approx(-math.log(py_prob(c, tot, x, t, tok)))
    batched = wins.withColumn("batch_id", F.col("window_idx"))
    ev = eval_loss(batched, lm).first()
    assert ev["n_batches"] == 3


def test_no_training_targets_is_an_error(spark, wins):
    with pytest.raises(ValueError, match="no training windows"):
        fit_ngram(wins.filter("window_idx > 5"), 3, V, LAM)


def test_score_next_backoff(spark, wins):
    lm = fit_ngram(wins, 3, V, LAM)
    ctx = spark.createDataFrame([(0, [5, 6]), (1, [9, 9, 7]), (2, [9, 9])], "row_id BIGINT, tokens ARRAY<INT>")
    sc = score_next(ctx, lm).collect()
    for row in (0, 1, 2):
        assert sum(math.exp(r["logit"]) for r in sc if r["row_id"] == row) == pytest.approx(1.0)
    assert {r["ctx_order"] for r in sc if r["row_id"] == 0} == {3}
    assert {r["ctx_order"] for r in sc if r["row_id"] == 1} == {2}
    assert {r["ctx_order"] for r in sc if r["row_id"] == 2} == {1}  # nothing seen: the counts of all ids


def test_empty_validation_is_infinite_and_order_one_always_scores(spark, wins):
    lm = fit_ngram(wins, 3, V, LAM)
    empty = wins.filter("window_idx > 5").withColumn("batch_id", F.col("window_idx"))
    r = eval_loss(empty, lm).first()
    assert r["n_batches"] == 0 and r["val_loss"] == float("inf")
    assert eval_loss(empty, lm, empty=0.0).first()["val_loss"] == 0.0  # the base script's rule
    uni = fit_ngram(wins, 1, V, (0.1, 0.9))
    sc = score_next(spark.createDataFrame([(0, [5]), (1, [])], "row_id BIGINT, tokens ARRAY<INT>"), uni).collect()
    assert sum(math.exp(r["logit"]) for r in sc) == pytest.approx(2.0)


def test_interpolated_scores_cover_the_vocabulary_with_the_loss_model(spark, wins):
    lm = fit_ngram(wins, 3, V, LAM)
    c, tot = py_model(WINDOWS)
    asked = [[5, 6], [9, 9, 7], [9, 9], [7], []]
    ctx = spark.createDataFrame(list(enumerate(asked)), "row_id BIGINT, tokens ARRAY<INT>")
    got = {(r["row_id"], r["token"]): math.exp(r["logit"]) for r in score_interpolated(ctx, lm).collect()}
    assert set(got) == {(i, w) for i in range(len(asked)) for w in range(V)}
    for i, x in enumerate(asked):
        for w in range(V):
            want = py_prob(c, tot, x, len(x) - 1, w) if x else (LAM[0] / V + LAM[1] * c[(1, "", w)] / tot[(1, "")]) / (LAM[0] + LAM[1])
            assert got[(i, w)] == pytest.approx(want)
        assert sum(p for (j, _), p in got.items() if j == i) == pytest.approx(1.0)


@pytest.mark.parametrize("chunk, bound", [(3, 64 << 20), (7, -1), (1 << 14, 64 << 20)])
def test_interpolated_scores_are_filled_by_chunks(spark, wins, monkeypatch, chunk, bound):
    """No join of rows times vocabulary; repeated and null keys and a null context keep their rows."""
    from tessera.operators import ngram
    monkeypatch.setattr(ngram, "CHUNK", chunk)
    monkeypatch.setattr(ngram, "BROADCAST_BYTES", bound)
    c, tot = py_model(WINDOWS)
    asked = [("a", [5, 6]), ("a", [9, 9, 7]), (None, [9, 9]), (None, [5, 6]), ("b", [])]
    want = sorted((k or "", w, round(math.log(py_prob(c, tot, x, len(x) - 1, w) if x else (LAM[0] / V + LAM[1] * c[(1, "", w)] / tot[(1, "")]) / (LAM[0] + LAM[1])), 9))
                  for k, x in asked for w in range(V))
    ctx = spark.createDataFrame([*asked, ("n", None)], "who STRING, tokens ARRAY<INT>")
    out = score_interpolated(ctx, fit_ngram(wins, 3, V, LAM), "who")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "Join" in x and "token" in x]
    rows = out.collect()
    assert out.columns == ["who", "token", "logit"] and sum(r["who"] == "n" for r in rows) == V
    assert sorted((r["who"] or "", r["token"], round(r["logit"], 9)) for r in rows if r["who"] != "n") == want
    # without a floor an id of no probability has no row
    bare = score_interpolated(ctx.filter("who = 'b'"), fit_ngram(wins, 1, V + 4, (0.0, 1.0)), "who").collect()
    assert sorted(r["token"] for r in bare) == sorted(w for w in range(V) if c[(1, "", w)])


def test_generation_reaches_ids_outside_the_longest_context(spark, wins):
    from tessera.config import Config
    from tessera.operators.generate import generate_ids
    lm = fit_ngram(wins, 3, V, (0.1, 0.9, 1e-6, 1e-6))  # nearly all weight on order 1
    rows = spark.range(60).select(F.col("id").alias("row_id"), F.array(F.lit(2), F.lit(7), F.lit(5)).alias("tokens"))
    cfg = Config.of(top_p=1.0, repetition_penalty=1.0)
    drawn = lambda **k: {r["gen"][0] for r in generate_ids(rows, lm, cfg, max_new=1, **k).collect()}
    assert drawn(scores="backoff") == {6}  # 7 5 is always followed by 6 in training
    assert drawn() > {5, 6, 7}


def _dense_draw(base, den, own, seen, t, penalty, mode, p, u):
    """Draw from the whole distribution, written out and sorted."""
    logit = [math.log((b + own.get(w, 0.0)) / den) / t for w, b in enumerate(base)]
    for w in seen:
        logit[w] = logit[w] * penalty if mode == "sign_aware" and logit[w] < 0 else logit[w] / penalty
    z = [math.exp(x - max(logit)) for x in logit]
    order = sorted(range(len(z)), key=lambda w: (-z[w], w))
    kept, run = [], 0.0
    for w in order:
        if run > p * sum(z):
            break
        kept.append(w)
        run += z[w]
    run, total = 0.0, sum(z[w] for w in kept)
    for w in kept:
        run += z[w]
        if run > u * total:
            return w
    return kept[-1]


@pytest.mark.parametrize("mode", ["sign_aware", "divide"])
def test_sparse_draws_equal_dense_draws(mode):
    rng = np.random.default_rng(9)
    for case in range(400):
        v = int(rng.integers(1, 60))
        base = np.where(rng.random(v) < 0.5, 1e-3, rng.integers(1, 5, v) / 7.0)  # many ties
        t, penalty, p = float(rng.choice([0.3, 1.0, 2.0])), float(rng.choice([1.0, 1.2, 0.7])), float(rng.choice([0.0, 0.5, 0.9, 1.0]))
        own = {int(w): float(rng.random()) for w in rng.choice(v, rng.integers(0, v + 1), replace=False)}
        seen = np.unique(rng.choice(v, rng.integers(0, v + 1)))
        den = float(base.sum() + sum(own.values()))
        ids = np.array(sorted(own), np.int64)
        merged = Merged(Shared(base, t), ids, np.array([own[w] for w in ids]), seen, den, penalty, mode)
        for u in (0.0, float(rng.random()), float(rng.random()), 1 - 2.0 ** -32):
            assert merged.draw(p, u) == _dense_draw(base, den, own, seen, t, penalty, mode, p, u), case


def test_the_shared_table_takes_eight_bytes_a_token(spark, wins, monkeypatch):
    """Its bound is of token and place: the rest is a row for each different weight."""
    from tessera.operators import sparse_scores
    lm = fit_ngram(wins, 3, V, LAM)
    monkeypatch.setattr(sparse_scores, "BROADCAST_BYTES", 8 * V)
    base = sparse_scores.shared_base(lm)
    c, tot = py_model(WINDOWS)
    assert base is not None and base == pytest.approx([LAM[0] / V + LAM[1] * c[(1, "", w)] / tot[(1, "")] for w in range(V)])
    base = np.repeat([0.5, 0.25, 1e-6], [3, 7, 100_000])
    table = sparse_scores.Shared(base, 0.7)
    assert sum(x.nbytes for x in vars(table).values() if isinstance(x, np.ndarray)) < 8 * len(base) + 1000
    assert table.before(np.array([0, 3, 10, len(base)])) == pytest.approx(np.concatenate([[0], np.cumsum((base / 0.5) ** (1 / 0.7))])[[0, 3, 10, len(base)]])


def test_generation_is_the_same_written_out_or_not(spark, wins):
    from tessera.config import Config
    from tessera.operators.generate import generate_ids
    rows = spark.createDataFrame([(i, [2, 5 + i % 4, 6 + i % 3]) for i in range(25)] + [(90, []), (91, [2, 1, 1])], "row_id BIGINT, tokens ARRAY<INT>")
    for order, lam, cfg in ((3, LAM, Config.of(block_size=5)), (2, (0.1, 0.2, 0.7), Config.of(temperature=0.6, top_p=0.7, penalty_mode="divide")),
                            (1, (0.1, 0.9), Config.of(top_p=1.0))):
        lm = fit_ngram(wins, order, V, lam)
        for mode in ("all", "generated"):
            draws = [{r["row_id"]: r["gen"] for r in generate_ids(rows, lm, cfg, max_new=4, scores=s, seen_mode=mode).collect()} for s in ("interpolated", "dense")]
            assert draws[0] == draws[1] and len(draws[0]) == 27


def test_a_generation_step_does_not_move_the_model(spark, wins):
    """Without broadcasts, the model's side of the context join has no exchange, and no
    row meets the vocabulary."""
    from tessera.operators.sparse_scores import additions
    lm = fit_ngram(wins, 3, V, LAM)
    lm.continuations()
    rows = spark.createDataFrame([(0, [5, 6])], "row_id BIGINT, tokens ARRAY<INT>")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = additions(rows, lm, F.col("tokens"), "row_id", None)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = plan[plan.index("SortMergeJoin"):].splitlines()
    scan = next(i for i, x in enumerate(join) if "FileScan" in x)
    assert "Bucketed: true" in join[scan] and sum("Exchange" in x for x in join) == 1  # the rows' own
    assert not any("Exchange" in x for x in join[scan - 4:scan])


def test_a_generation_step_reads_only_its_contexts_folders(spark, wins, monkeypatch):
    """Folders of a large model that hold no context of the rows are not read; the draws are the same."""
    from tessera.config import Config
    from tessera.operators import ngram
    from tessera.operators.generate import generate_ids
    from tessera.operators.sparse_scores import additions
    rows = spark.createDataFrame([(i, [2, 5 + i % 4, 6 + i % 3]) for i in range(9)] + [(90, []), (91, [2, 1, 1])], "row_id BIGINT, tokens ARRAY<INT>")
    draws = lambda lm: {r["row_id"]: r["gen"] for r in generate_ids(rows, lm, Config.of(block_size=5), max_new=4).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        whole, lm = fit_ngram(wins, 3, V, LAM), fit_ngram(wins, 3, V, LAM)
        want = draws(whole)
        assert whole.folders == 2 and "folder" not in whole._continuations.columns
        monkeypatch.setattr(ngram, "FOLDER_CONTEXTS", 1)
        monkeypatch.setattr(ngram, "FEWEST_FOLDERS", 1)
        assert draws(lm) == want and lm.folders > 6 and "folder" in lm._continuations.columns
        plan = additions(rows.filter("row_id = 0"), lm, F.col("tokens"), "row_id", 1)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    scan = next(x for x in plan.splitlines() if "FileScan" in x and "adds" in x)
    assert "folder" in scan[scan.index("PartitionFilters: ["):].split("]")[0]


def test_losses_do_not_move_the_model(spark, wins):
    """Without automatic broadcasts, orders 2 and up are joined with no exchange above the
    model's tables; only the targets move."""
    lm = fit_ngram(wins, 3, V, LAM)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = token_losses(wins, lm)._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    tables = [i for i, x in enumerate(plan) if "FileScan" in x and "Bucketed: true" in x]
    assert len(tables) == 4  # counts and totals of orders 2 and 3
    for i in tables:
        j = i - 1
        while "Join" not in plan[j]:
            assert "Exchange" not in plan[j] or plan[j].count(":") < plan[i].count(":"), plan[j:i + 1]
            j -= 1


def test_capped_vocabulary_sorts_no_more_than_it_keeps(spark):
    """Ties at the cap go by spelling; the same ids as from ranking all words."""
    from tessera.operators.vocab import top_words, word_vocab
    counts = [(f"w{i * 37 % 100:03d}", 1 + (i % 7) * (i % 3)) for i in range(100)]
    df = spark.createDataFrame(counts, "word STRING, n BIGINT").repartition(5)
    order = [w for w, _ in sorted(counts, key=lambda r: (-r[1], r[0]))]
    for k in (0, 1, 2, 13, 50, 99, 100, 150):
        assert sorted(r["word"] for r in top_words(df, k).collect()) == sorted(order[:k])
        ids = {r["piece"]: r["id"] for r in word_vocab(df, k + 4).filter("id >= 4").collect()}
        assert ids == {w: i + 4 for i, w in enumerate(order[:k])}
    plan = top_words(df, 13)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


def test_backoff_moves_the_contexts_and_not_the_model(spark):
    """With few rows the model's tables are read where they lie, and rows are the same as
    by shuffles of both sides."""
    wins = spark.createDataFrame(WINDOWS, "window_idx BIGINT, x ARRAY<INT>, y ARRAY<INT>")
    lm = fit_ngram(wins, 3, V, LAM)
    asked = spark.createDataFrame([(1, [5, 6]), (2, [6, 9]), (3, [9, 9]), (4, []), (5, [9, 7, 7])], "row_id INT, tokens ARRAY<INT>")
    few, many = score_next(asked, lm, n_contexts=20), score_next(asked, lm, n_contexts=1 << 40)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan and plan.count("BroadcastHashJoin") == 3
    rows = lambda df: sorted((r["row_id"], r["token"], round(r["logit"], 12), r["ctx_order"]) for r in df.collect())
    c, tot = py_model(WINDOWS)
    used = {1: (3, "5 6"), 2: (2, "6"), 3: (1, ""), 4: (1, ""), 5: (2, "7")}
    want = sorted((r, t, round(math.log(n / tot[h]), 12), h[0]) for r, h in used.items() for (*k, t), n in c.items() if tuple(k) == h)
    assert rows(few) == rows(many) == rows(score_next(asked, lm)) == want
