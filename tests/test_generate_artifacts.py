"""G9/G10 end to end on a tiny corpus, S4-S8 round trips, L5."""

import math

from pyspark.sql import functions as F

from tessera.config import Config
from tessera.operators.generate import generate
from tessera.operators.infer import infer
from tessera.operators.ngram import fit_ngram
from tessera.operators.split import split_exact
from tessera.operators.tokenize import encode
from tessera.operators.windows import pack_windows
from tessera.plans.corpus import word_tokenizer
from tessera.sources import artifacts as A


def _setup(spark):
    text = spark.createDataFrame(
        [(i, f"Q: what is {w}? A: {w} is a thing that works.") for i, w in enumerate(["x", "y", "z", "w"] * 5)],
        "idx BIGINT, text STRING")
    tok = word_tokenizer(text)
    wins = pack_windows(encode(text, tok), 16, 8)
    lm = fit_ngram(split_exact(wins, 1.0), 3, tok.size)
    return tok, lm


def test_generation(spark):
    tok, lm = _setup(spark)
    cfg = Config.of(block_size=16, step_size=8, max_generate_length=6)
    prompts = spark.createDataFrame([(0, "what is x?"), (1, "zzz unknown")], "row_id BIGINT, question STRING")
    out = {r["row_id"]: r for r in generate(prompts, lm, tok, cfg).collect()}
    assert 1 <= len(out[0]["answer_ids"]) <= 6
    assert out[0]["text"].startswith("Q: what is x? A:")
    again = {r["row_id"]: list(r["answer_ids"]) for r in generate(prompts, lm, tok, cfg).collect()}
    assert again[0] == list(out[0]["answer_ids"])  # seeded
    assert [list(r["answer_ids"]) for r in generate(prompts, lm, tok, cfg, max_new=0).collect()] == [[], []]


def test_artifacts(spark):
    tok, lm = _setup(spark)
    p = A.shared_path(spark, "test-tok")
    A.save_tokenizer(tok, p)
    back = A.load_tokenizer(spark, p)
    assert back.size == tok.size and back.mode == "word"
    m = A.shared_path(spark, "test-model")
    A.save_model(lm, m, {"iter": 3000, "best_val_loss": 1.5})
    lm2, it, best = A.load_model(spark, m)
    assert (it, best) == (3000, 1.5) and lm2.counts.count() == lm.counts.count()
    assert A.load_model(spark, m + "-missing") == (None, 0, math.inf)
    txt = A.shared_path(spark, "test-prepared")
    df = spark.createDataFrame([(1, "a\nb"), (2, "c")], "shuffle_rank BIGINT, text STRING")
    A.write_prepared(df, txt)
    assert sorted(r["value"] for r in spark.read.text(txt).collect()) == ["a b", "c"]
    A.write_prepared(df, txt, newline="keep")
    assert spark.read.text(txt).count() == 3  # the reference's raw form splits the record


def test_infer_keeps_rows(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(10)], "k BIGINT, x ARRAY<DOUBLE>")

    def make():
        return lambda a: a.sum(axis=1)
    got = {r["k"]: r["prediction"] for r in infer(df, make, "x", batch_size=4, input_length=2).collect()}
    assert got == {i: i + 1.0 for i in range(10)}


def test_config_rejects_unknown_and_ranges():
    import pytest
    with pytest.raises(ValueError, match="unknown"):
        Config.of(top_k=10)
    with pytest.raises(ValueError):
        Config.of(top_p=1.5)
    with pytest.raises(ValueError):
        Config.of(block_size=0)
    assert Config.of(step_size=None, block_size=64).step_size == 64


def test_generation_seen_modes_and_cap(spark):
    tok, lm = _setup(spark)
    cfg = Config.of(block_size=16, step_size=8, max_generate_length=3)
    prompts = spark.createDataFrame([(0, "what is y?")], "row_id BIGINT, question STRING")
    for mode in ("all", "generated"):
        r = generate(prompts, lm, tok, cfg, seen_mode=mode).first()
        assert 1 <= len(r["answer_ids"]) <= 3
        if len(r["answer_ids"]) < 3:
            assert r["answer_ids"][-1] == cfg.eos_id


def test_models_are_saved_again_where_they_came_from(spark):
    _, lm = _setup(spark)
    path = A.shared_path(spark, "test-resume")
    A.save_model(lm, path, {"iter": 1, "best_val_loss": 2.0, "config": {"a": 1}})
    rows = sorted(map(tuple, lm.counts.collect()))
    for i in (2, 3):
        back, it, best = A.load_model(spark, path)
        A.save_model(back, path, {"iter": it + 1, "best_val_loss": best / 2, "config": {"a": i}})
        again, it, best = A.load_model(spark, path)
        assert (it, best, A.model_config(spark, path)) == (i, 2.0 ** (2 - i), {"a": i})
        assert sorted(map(tuple, again.counts.select(lm.counts.columns).collect())) == rows
        assert sorted(map(tuple, back.counts.select(lm.counts.columns).collect())) == rows  # a loaded model outlives the save
    assert len(A.versions(spark, path)) == 3
    text = spark.createDataFrame([(0, [2, 5, 6])], "row_id BIGINT, tokens ARRAY<INT>")
    from tessera.operators.ngram import score_interpolated
    a, b = (sorted((r["token"], round(r["logit"], 9)) for r in score_interpolated(text, m).collect()) for m in (lm, again.partitioned()))
    assert a == b


def test_a_save_broken_off_leaves_the_old_artifact(spark):
    from dataclasses import replace

    import pytest
    tok, lm = _setup(spark)
    path = A.shared_path(spark, "test-broken")
    A.save_model(lm, path, {"iter": 1, "best_val_loss": 2.0})
    fails = lm.totals.withColumn("total", F.expr("cast(raise_error('lost') as bigint)"))
    with pytest.raises(Exception, match="lost"):
        A.save_model(replace(lm, counts=lm.counts.limit(1), totals=fails), path, {"iter": 99, "best_val_loss": 0.0})
    back, it, best = A.load_model(spark, path)
    assert (it, best) == (1, 2.0) and back.counts.count() == lm.counts.count()
    with pytest.raises(Exception, match="lost"):  # a first save broken off is no model
        A.save_model(replace(lm, totals=fails), path + "-new")
    assert A.load_model(spark, path + "-new") == (None, 0, math.inf)
    # tables without a row in the manifest (written, then the driver died) are not seen
    lm.counts.limit(1).write.parquet(f"{path}/data/half/counts")
    assert A.load_model(spark, path)[1] == 1
    A.save_tokenizer(tok, path + "-tok")
    with pytest.raises(Exception, match="lost"):
        A.save_tokenizer(replace(tok, vocab=tok.vocab.withColumn("piece", F.expr("raise_error('lost')"))), path + "-tok")
    assert A.load_tokenizer(spark, path + "-tok").size == tok.size
    with pytest.raises(FileNotFoundError):
        A.load_tokenizer(spark, path + "-none")
    # of two saves with the same number the later one counts
    rows = spark.read.parquet(f"{path}/manifest")
    rows.selectExpr("seq", "saved_at + 1 AS saved_at", "'other' AS version", "info").write.mode("append").parquet(f"{path}/manifest")
    assert A._last(spark, path)["version"] == "other"


def test_failing_batches_lose_only_themselves(spark):
    from tessera.operators.infer import batch_losses, mean_loss
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(12)], "k BIGINT, x ARRAY<DOUBLE>").coalesce(1)

    def make():
        def predict(a):
            if (a[:, 0] == 5).any():
                raise RuntimeError("five")
            return a.sum(axis=1)
        return predict
    got = {r["k"]: (r["prediction"], r["error"]) for r in infer(df, make, "x", batch_size=4, input_length=2, on_error="skip").collect()}
    assert got == {i: (None, "RuntimeError: five") if 4 <= i < 8 else (i + 1.0, None) for i in range(12)}
    wins = spark.createDataFrame([(i, i // 2, [i, i], [i, 7]) for i in range(7)], "window_idx BIGINT, batch_id BIGINT, x ARRAY<INT>, y ARRAY<INT>")

    def loss_fn():
        def loss(x, y):
            assert y.shape == x.shape
            return 1 / (4 - x[0, 0])  # numpy gives inf at 4, plain integers raise
        return lambda x, y: 1 / (4 - int(x[0, 0])) + loss(x, y) * 0 if int(x[0, 0]) != 4 else 1 / 0
    rows = {r["batch_id"]: r for r in batch_losses(wins, loss_fn).collect()}
    assert rows[2]["loss"] is None and rows[2]["error"].startswith("ZeroDivisionError") and rows[3]["n_windows"] == 1
    m = mean_loss(batch_losses(wins, loss_fn)).first()
    assert (m["n_batches"], m["n_skipped"]) == (3, 1) and abs(m["val_loss"] - (1 / 4 + 1 / 2 - 1 / 2) / 3) < 1e-12
    none = mean_loss(batch_losses(wins.filter("batch_id = 2"), loss_fn)).first()
    assert none["val_loss"] == math.inf and none["n_batches"] == 0
