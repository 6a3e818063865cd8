"""Training-data pipeline over ``documents``.

``STAGES`` are (name, function) pairs; each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next stage's
``docs``. All stages but the last return the columns of ``documents``:

1. ``quality``: documents that the quality classifier rejects go.
2. ``line_dedup``: lines that stand on many sites, or on five if they have three
   words, are taken out of the texts (``n_chars`` follows); no document goes.
3. ``simhash``: one document of each group of near copies stays.
4. ``decontaminate``: documents that hold a benchmark window go.
5. ``pack``: what is left as token pieces in sequences of at most 4096 tokens.

Each stage is its operator from ``tessera.llm``, whole, on all that the stage
before kept; nulls, empty texts, repeated rows and empty tables are as stated there.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, line_dedup, packing, quality, simhash
from tessera.llm.common import col, table
from tessera.session import ensure_checkpoint_dir

#: SQL cannot express the learned scores, the fingerprints' hash and the tokenizer.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    # boxed, so that a column of the documents called like a score stays as it is
    row = F.struct(*[col(c) for c in docs.columns]).alias("row")
    scored = quality.score(docs.select(row, F.col("text").alias("scored_text")), model, text_col="scored_text")
    return scored.filter("predicted = 1").select("row.*")


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup.remove_boilerplate(docs, few_sites=line_dedup.FEW_SITES)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[col(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return packing.pack(packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", drop_boilerplate),
    ("simhash", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; each result goes through a table in the shared checkpoint folder."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
