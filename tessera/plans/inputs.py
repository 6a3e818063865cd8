"""Inputs read from the given tables, in the schemas the operators expect.

These only read and rename: no operator work happens here.

* Q&A pairs: ``conversations`` user turn ``t`` + assistant turn ``t + 1`` (S3).
* Raw records: every user turn as a JSON object ``{question, answer}`` (answer
  missing when no assistant turn follows) and every system turn as a bare JSON
  string, in (conv_id, turn) order.
* Run log: ``events`` with run = ``user_id``, loss = ``value``.
* Logits: ``embeddings`` with row = ``vec_id``, token = array position.
* Prompts: ``benchmark`` texts as questions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.ordering import global_rank
from tessera.session import spread
from tessera.sources.qa import pairs_from_turns


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def qa_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs_from_turns(table(spark, sf_dir, "conversations"))


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = table(spark, sf_dir, "conversations")
    user = conv.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    asst = conv.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    objs = user.join(asst, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", F.to_json(F.struct("question", "answer")).alias("js"))
    system = conv.filter(F.col("role") == "system").select("conv_id", "turn", F.to_json(F.array("text")).alias("js"))
    system = system.select("conv_id", "turn", F.expr("substring(js, 2, length(js) - 2)").alias("js"))
    recs = objs.unionByName(system)
    ranked = global_rank(recs, ["conv_id", "turn"], "idx")
    return ranked.select((F.col("idx") - 1).alias("idx"), F.parse_json("js").alias("value"))


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("user_id").alias("run_id"), "ts", "event_id", F.col("value").alias("val_loss"))


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(F.col("vec_id").alias("row_id"), F.posexplode("embedding").alias("token", "logit")).select(
        "row_id", F.col("token").cast("int"), F.col("logit").cast("double"))


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = table(spark, sf_dir, "benchmark")
    return b.select(F.col("item_id").alias("row_id"), F.col("text").alias("question"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("idx"), "text")
