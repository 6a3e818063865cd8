"""Structured Streaming for the per-record operators.

Validation, strip, formatting (V1-P4), pad masks (D10) and word-mode encoding
(T6) look at one record at a time, so they run on a stream unchanged: the
projections directly, encoding per micro-batch through ``foreachBatch``
(each record lies whole inside one micro-batch, so no state is kept). Output
goes to a file sink folder per batch id, rewritten if a batch is replayed, so
a restart from the checkpoint does not duplicate rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.functions.arrays import ints_text
from tessera.functions.text import format_prompt, strip_ws
from tessera.operators.tokenize import encode
from tessera.operators.validate import classify_qa, quarantine, validation_report
from tessera.operators.vocab import Tokenizer


def prompt_records(turns: DataFrame) -> DataFrame:
    """User turns as inference prompts ``Q: {question} A:`` (stateless)."""
    return (turns.filter(F.col("role") == "user")
            .select("conv_id", "turn", format_prompt(strip_ws("text")).alias("prompt")))


def encode_batches(stream: DataFrame, tok: Tokenizer, sink: str, checkpoint: str, key: str = "turn_key",
                   text_col: str = "prompt", keep: tuple = ("conv_id", "turn")) -> StreamingQuery:
    """Encode every micro-batch with ``tok`` and write ``keep..., tokens_text``
    under ``sink/batch=<id>``; runs until the input available now is done."""

    def run(batch: DataFrame, batch_id: int) -> None:
        keyed = batch.withColumn(key, F.concat_ws(":", *keep))
        ids = encode(keyed.select(key, text_col), tok, text_col, key)
        out = keyed.select(key, *keep).join(ids, key).select(*keep, ints_text("tokens").alias("tokens_text"))
        out.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

    return (stream.writeStream.foreachBatch(run)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())


def quarantine_batches(stream: DataFrame, good: str, rejected: str, checkpoint: str) -> StreamingQuery:
    """Validate a stream of ``idx, value`` (JSON text) and write every micro-batch to two
    sinks (V1, V3): records that pass to ``good/batch=<id>`` as ``idx, question, answer``,
    the others to ``rejected/batch=<id>`` as ``idx, value, error``; ``quarantine_report``
    reads the outcome counts (V4). Runs until the input available now is done.

    Both folders of a batch are rewritten if the batch is replayed, after a failure
    between the two writes as well, so a restart adds nothing twice and loses nothing.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        records = batch.select("idx", F.col("value").alias("_text"), F.try_parse_json("value").alias("value"))
        records = classify_qa(records).persist()  # read by both writes
        try:
            ok, bad = quarantine(records)
            ok.select("idx", "question", "answer").write.mode("overwrite").parquet(f"{good}/batch={batch_id}")
            bad.select("idx", F.col("_text").alias("value"), "error").write.mode("overwrite").parquet(f"{rejected}/batch={batch_id}")
        finally:
            records.unpersist()

    return (stream.writeStream.foreachBatch(run)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())


def quarantine_report(spark: SparkSession, good: str, rejected: str) -> DataFrame:
    """``outcome, n_records, first_idx`` over both sinks, as ``validation_report`` (V4)."""
    ok = spark.read.parquet(good).select("idx", F.lit(None).cast("string").alias("error"))
    return validation_report(ok.unionByName(spark.read.parquet(rejected).select("idx", "error")))


def stream_table(spark: SparkSession, folder: str, schema, pattern: str = "*.parquet",
                 max_files: int = 1) -> DataFrame:
    """A streaming reader over the Parquet files of ``folder`` matching ``pattern``. What
    matches may be a folder of Parquet files too, as Spark writes a table."""
    # a pattern and not a plain path, which would have to be a folder
    at = pattern if any(c in pattern for c in "*?[{") else f"{{{pattern}}}"
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
            .parquet(f"{folder.rstrip('/')}/{at}"))
