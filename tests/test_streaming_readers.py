"""Streaming path, the Parquet reader and the queries that write what they read."""

import json

from pyspark.sql import functions as F

from tessera.operators.validate import classify_qa
from tessera.plans.corpus import word_tokenizer
from tessera.sources import artifacts as A
from tessera.sources.qa import read_qa
from tessera.streaming import prepare as ST


def test_stream_encodes_every_user_turn(spark, tmp_path):
    turns = spark.createDataFrame(
        [(1, 0, "user", "  hello there "), (1, 1, "assistant", "hi"), (2, 0, "user", "hello again")],
        "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    folder = str(tmp_path / "turns")
    turns.repartition(2).write.parquet(folder)
    text = spark.createDataFrame([(0, "Q: hello there A: again")], "idx BIGINT, text STRING")
    tok = word_tokenizer(text)
    stream = ST.prompt_records(ST.stream_table(spark, folder, turns.schema))
    sink, ckpt = A.shared_path(spark, "t-sink"), A.shared_path(spark, "t-ckpt")
    ST.encode_batches(stream, tok, sink, ckpt).awaitTermination()
    got = {(r["conv_id"], r["turn"]): r["tokens_text"] for r in spark.read.parquet(sink).collect()}
    ids = {r["piece"]: r["id"] for r in tok.vocab.collect()}
    want1 = " ".join(str(ids[w]) for w in ["Q:", "hello", "there", "A:"])
    assert got[(1, 0)] == want1 and set(got) == {(1, 0), (2, 0)}
    assert got[(2, 0)] == " ".join(str(ids[w]) for w in ["Q:", "hello", "again", "A:"])


def test_parquet_reader_applies_the_same_rules(spark, tmp_path):
    df = spark.createDataFrame([(0, "q", "a"), (1, None, "a"), (2, " ", "a")],
                               "idx BIGINT, question STRING, answer STRING")
    path = str(tmp_path / "qa.parquet")
    df.write.parquet(path)
    got = {r["idx"]: r["error"] for r in classify_qa(read_qa(spark, path, fmt="parquet")).collect()}
    assert got == {0: None, 1: "not_string", 2: "empty"}


def test_quarantine_stream_restarts_and_replays(spark, tmp_path):
    """Two sinks; a restart takes new files only, and a replayed batch adds nothing."""
    import json
    import shutil
    source, good, rejected, ckpt = (str(tmp_path / x) for x in ("in", "good", "rejected", "ckpt"))
    kinds = [json.dumps({"question": "q", "answer": "a"}), '"text"', '{"question": 1, "answer": "b"}', '{"question": " ", "answer": "b"}', "{", None]
    want = [None, "not_object", "not_string", "empty", "malformed", "malformed"]

    def add(first):
        rows = [(first + i, kinds[i % 6]) for i in range(12)]
        spark.createDataFrame(rows, "idx BIGINT, value STRING").coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = ST.stream_table(spark, source, "idx BIGINT, value STRING")
        ST.quarantine_batches(stream, good, rejected, ckpt).awaitTermination()
        out = [(r["idx"], None) for r in spark.read.parquet(good).collect()] + [(r["idx"], r["error"]) for r in spark.read.parquet(rejected).collect()]
        return sorted(out)

    add(0)
    add(12)
    assert run() == [(i, want[i % 6]) for i in range(24)]
    assert run() == [(i, want[i % 6]) for i in range(24)]
    add(24)
    expected = [(i, want[i % 6]) for i in range(36)]
    assert run() == expected
    for name in ("2", ".2.crc"):  # the last batch was written but not committed: it is run again
        (tmp_path / "ckpt" / "commits" / name).unlink(missing_ok=True)
    shutil.rmtree(tmp_path / "rejected" / "batch=2")  # and had lost its second write
    assert run() == expected
    report = {r["outcome"]: r["n_records"] for r in ST.quarantine_report(spark, good, rejected).collect()}
    assert report == {"ok": 6, "not_object": 6, "not_string": 6, "empty": 6, "malformed": 12}


def _turns(spark, n):
    """Conversations of two turns, and one of a system turn and a question without an answer."""
    rows = [(c, t, ("user", "assistant")[t], f"text {c} {t}") for c in range(n) for t in range(2)]
    return spark.createDataFrame([*rows, (n, 0, "system", "rules"), (n, 1, "user", "open")], "conv_id BIGINT, turn BIGINT, role STRING, text STRING")


def test_stream_reads_a_table_that_is_a_folder_of_files(spark, tmp_path):
    from tessera.plans.registry import REGISTRY
    _turns(spark, 20).repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
    _turns(spark, 50).write.parquet(str(tmp_path / "other.parquet"))
    got = REGISTRY["st_encode_prompts_stream"](spark, str(tmp_path)).collect()
    assert sorted((r["conv_id"], r["turn"]) for r in got) == [*((c, 0) for c in range(20)), (20, 1)]


def test_stream_reads_a_table_that_is_one_file(spark, tmp_path):
    from tessera.plans.registry import REGISTRY
    _turns(spark, 5).toPandas().to_parquet(str(tmp_path / "conversations.parquet"))
    got = REGISTRY["st_encode_prompts_stream"](spark, str(tmp_path)).collect()
    assert sorted((r["conv_id"], r["turn"]) for r in got) == [*((c, 0) for c in range(5)), (5, 1)]


def test_single_line_arrays_are_whole_files_however_joins_are_cut(spark, tmp_path):
    """Settings under which Spark deals a join's partition to several tasks."""
    from tessera.plans import registry
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "0.1", "spark.sql.adaptive.forceOptimizeSkewedJoin": "true"}
    raw = spark.range(430, numPartitions=8).select(F.col("id").alias("idx"), F.parse_json(F.concat(F.lit('{"question":"} '), "id", F.lit('","answer":"["}'))).alias("value")).checkpoint()
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        registry._write_single_lines(raw, str(tmp_path / "out"), 100)
    finally:
        for k in settings:
            spark.conf.unset(k)
    files = sorted((tmp_path / "out").glob("chunk=*/part-*.txt"))
    assert [[r["question"] for r in json.loads(f.read_text())] for f in files] == [[f"}} {i}" for i in range(a, min(a + 100, 430))] for a in range(0, 430, 100)]
