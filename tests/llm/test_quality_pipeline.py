import zlib

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tessera.llm import decontaminate, quality
from tests.conftest import SF_SMALL

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    out = entry.queries()["op7_quality"](spark, SF).toPandas()
    assert len(out) == 1000
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in zip(out.doc_id, out.held_out))
    assert (out.predicted == (out.score >= 0.3)).all() and out.score.between(0, 1).all()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id").quality
    test = out[out.held_out & out.doc_id.isin(labels.index)]
    y = labels[test.doc_id].to_numpy()
    assert (test.predicted.to_numpy() == y).mean() > 0.95 and (test.predicted.to_numpy()[y == 1] == 1).mean() > 0.98


def test_scores_do_not_depend_on_batches_or_labels(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1), (4, 0), (4, 1), (6, None), (None, 1), (99, 0), (8, 0)], "doc_id bigint, quality int")
    model = quality.fit(docs, labels)
    a = quality.score(docs, model)
    assert a.columns[-2:] == ["score", "predicted"] and len(a.columns) == len(docs.columns) + 1
    one = sorted(r["score"] for r in a.collect())
    assert np.allclose(one, sorted(r["score"] for r in quality.score(docs.repartition(7), model).collect()), rtol=0, atol=1e-12)
    assert quality.score(empty, model).count() == 0
    untaught = quality.fit(docs, labels.filter("false"))
    assert {round(r["score"], 9) for r in quality.score(docs, untaught).collect()} == {0.5}


def test_chunks_change_no_feature():
    text = ("word än %%% " * 3000).encode()
    whole, split = quality.hashed([text])[0], [quality.hashed([p])[0] for p in quality.chunks(text, 1000)]
    for k in range(len(quality.GRAMS) + 1):  # n-grams and words; pairs are kept inside a part
        assert np.array_equal(np.sort(whole[k][1]), np.sort(np.concatenate([s[k][1] for s in split])))
    assert b"".join(quality.chunks(text, 1000)) == text and b"".join(quality.chunks(b"x" * 5000, 1000)) == b"x" * 5000


def test_pipeline_stages(spark):
    """Each stage on its own input: columns, what goes and what stays."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "simhash", "decontaminate", "pack"]
    stage = dict(corpus_pipeline.STAGES)
    before = docs
    seen = {}
    for name in ("quality", "line_dedup", "simhash", "decontaminate"):
        after = stage[name](spark, before, SF_SMALL)
        assert after.columns == docs.columns
        seen[name] = (before.toPandas(), after.toPandas())
        before = after
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet").toPandas()
    good = set(labels[labels.quality == 1].doc_id)
    a, b = seen["quality"]
    assert len(good & set(b.doc_id)) >= 0.98 * len(good & set(a.doc_id)) and len(b) < len(a)
    a, b = seen["line_dedup"]
    assert sorted(a.doc_id) == sorted(b.doc_id) and (b.n_chars == b.text.str.len()).all()
    a, b = seen["simhash"]
    assert b.text.nunique() == len(b) and set(b.doc_id) <= set(a.doc_id)
    a, b = seen["decontaminate"]
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    dirty = {r["doc_id"] for r in decontaminate.mark(spark.createDataFrame(a), bench).filter("contaminated").collect()}
    assert set(a.doc_id) - set(b.doc_id) == dirty
    packed = corpus_pipeline.run(spark, SF_SMALL)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == set(b.doc_id)


def test_stages_survive_odd_rows(spark, docs, empty):
    for name, stage in corpus_pipeline.STAGES:
        for df in (docs, empty):
            out = stage(spark, df, SF_SMALL)
            out.write.format("noop").mode("overwrite").save()
            assert name == "pack" or out.columns == df.columns
    assert corpus_pipeline.STAGES[1][1](spark, docs.withColumn("n_chars", F.lit(1)), SF_SMALL).filter("n_chars <> length(text)").count() == 0


def _plain_features(text, bits):
    """Buckets of a text's n-grams, words and word pairs, one at a time in Python integers."""
    p, m = int(quality._P), (1 << 64) - 1
    joined = b" " + text + b" "
    blank, byte = [c <= 32 for c in joined], [max(c, 32) + 1 for c in joined]
    out, words = [], []
    for g in quality.GRAMS:
        for i in range(len(joined) - g + 1):
            if not any(blank[i + 1:i + g - 1]):
                h = 0
                for x in byte[i:i + g]:
                    h = h * p + x & m
                out.append((((h * p & m) ^ h >> 29) * p & m) >> 64 - bits)
    for w in text.translate(bytes(32 if c <= 32 else c for c in range(256))).split(b" "):
        if w:
            words.append(sum((c + 1) * pow(p, i, 1 << 64) for i, c in enumerate(w)) & m)
    out += [((((h + 77) * p & m) ^ h >> 29) * p & m) >> 64 - bits for h in words]
    for a, b in zip(words, words[1:]):
        x = (b - a + 33) * p & m
        out.append(((x ^ x >> 29) * p & m) >> 64 - bits)
    return out


def test_scores_from_the_models_own_vectors(spark):
    """Average of the features' vectors, output layer, softmax: in plain numpy, a text at a time."""
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = quality.fit(df, spark.read.parquet(f"{SF_SMALL}/labels.parquet"), quality.Settings(bits=14, dim=8, least_steps=300))
    rows = quality.score(df.filter("length(text) < 3000 or text is null"), model).collect()
    assert len(rows) > 50 and len({round(r["score"], 3) for r in rows}) > 10
    for r in rows:
        ids = _plain_features((r["text"] or "").encode(), 14)
        hidden = model.vectors[ids].astype(float).mean(0) if ids else np.zeros(8)
        z = model.output.astype(float) @ hidden + model.bias
        assert abs(r["score"] - np.exp(z[1]) / np.exp(z).sum()) < 1e-5
        assert r["predicted"] == int(r["score"] >= 0.3)
