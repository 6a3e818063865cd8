"""Sinks and artifacts (S4-S8): prepared text, tokenizer, model.

Everything is Parquet or text written by Spark to a shared path; nothing is
gathered on the driver. Tokenizers and models are versioned: a save writes its tables
into a fresh folder ``data/<version>`` and then appends one row, which names the folder
and holds all metadata, to ``manifest``. A loader takes the last row of the manifest,
so it never sees tables of one save with the metadata of another, a save that is
broken off changes nothing, and a model may be saved where it was loaded from.
"""

from __future__ import annotations

import json
import logging
import math
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tessera.operators.ngram import NgramModel
from tessera.operators.vocab import Tokenizer
from tessera.session import ensure_checkpoint_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera-out/{name}-{uuid.uuid4().hex}"


def write_prepared(df: DataFrame, path: str, text_col: str = "text", order_col: str | None = "shuffle_rank",
                   newline: str = "space") -> None:
    """Write prepared text, one record per line.

    ``newline="space"`` turns line breaks inside a record into one space, so a
    record stays one line; ``"keep"`` writes them raw as the reference does
    (a record then spans several lines). Output is sorted by ``order_col`` when
    given (a range-partitioned sort, many part files, no single writer).
    """
    if newline not in ("space", "keep"):
        raise ValueError("newline is 'space' or 'keep'")
    t = F.col(text_col)
    if newline == "space":
        t = F.regexp_replace(t, r"\r\n|[\n\r\x{85}\x{2028}\x{2029}]", " ")
    out = df.select(t.alias("value"), *([order_col] if order_col else []))
    if order_col:
        out = out.orderBy(order_col)
    out.select("value").write.mode("overwrite").text(path)


MANIFEST = "seq BIGINT, saved_at BIGINT, version STRING, info STRING"


def _save(spark: SparkSession, path: str, tables: dict[str, DataFrame], info: dict) -> str:
    """Write ``tables`` as a new version of the artifact at ``path``; its number. The row
    in the manifest is one file of one task, which Spark moves into place when it is whole."""
    version = uuid.uuid4().hex
    for name, df in tables.items():
        df.write.parquet(f"{path}/data/{version}/{name}")
        try:
            spark.read.parquet(f"{path}/data/{version}/{name}").limit(1).count()
        except AnalysisException as e:
            raise FileNotFoundError(f"artifact {path}/data/{version}/{name} was not created") from e
    try:
        seq = 1 + _last(spark, path)["seq"]
    except AnalysisException:
        seq = 1
    row = (seq, time.time_ns(), version, json.dumps({**info, "tables": list(tables)}))
    spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    return version


def _last(spark: SparkSession, path: str):
    """The manifest's last row. Of saves made at the same time, the later one counts."""
    rows = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    row = rows.orderBy(F.desc("seq"), F.desc("saved_at"), F.desc("version")).first()
    if row is None:
        raise ValueError(f"the manifest at {path} is empty")
    return row


def _load(spark: SparkSession, path: str) -> tuple[dict[str, DataFrame], dict]:
    """Tables and metadata of the last complete save at ``path``."""
    row = _last(spark, path)
    info = json.loads(row["info"])
    return {t: spark.read.parquet(f"{path}/data/{row['version']}/{t}") for t in info["tables"]}, info


def versions(spark: SparkSession, path: str) -> list[str]:
    """Complete versions of the artifact at ``path``, the oldest first."""
    rows = spark.read.schema(MANIFEST).parquet(f"{path}/manifest").orderBy("seq", "saved_at", "version").select("version").collect()
    return [r["version"] for r in rows]


def save_tokenizer(tok: Tokenizer, path: str) -> None:
    """Write vocabulary (and merges) as Parquet, and confirm that they exist."""
    tables = {"vocab": tok.vocab} | ({} if tok.merges is None else {"merges": tok.merges})
    _save(tok.vocab.sparkSession, path, tables, {"mode": tok.mode})


def load_tokenizer(spark: SparkSession, path: str) -> Tokenizer:
    """Read a saved tokenizer; a missing artifact is an error."""
    try:
        tables, info = _load(spark, path)
        return Tokenizer.of(tables["vocab"], info["mode"], tables["merges"] if info["mode"] == "bpe" else None)
    except (AnalysisException, KeyError, ValueError) as e:
        raise FileNotFoundError(f"no tokenizer at {path}") from e


def save_model(lm: NgramModel, path: str, meta: dict | None = None) -> None:
    """Write count tables and their metadata: config, iteration, best loss."""
    m = dict(meta or {})
    best = float(m.get("best_val_loss", math.inf))
    _save(lm.counts.sparkSession, path, {"counts": lm.counts, "totals": lm.totals}, {
        "order": lm.order, "n_tokens": lm.n_tokens, "vocab_size": lm.vocab_size, "lambdas": list(lm.lambdas),
        "config": m.get("config", {}), "iter": int(m.get("iter", 0)), "best_val_loss": None if math.isinf(best) else best})


def load_model(spark: SparkSession, path: str) -> tuple[NgramModel | None, int, float]:
    """``(model, iter, best_val_loss)`` (S8). No artifact, or one that cannot be
    read, gives ``(None, 0, inf)``: start from scratch. The model's tables are read as
    they were saved; ``partitioned`` buckets them for many scorings."""
    try:
        tables, info = _load(spark, path)
        lm = NgramModel(info["order"], tables["counts"], tables["totals"], info["n_tokens"], info["vocab_size"], tuple(info["lambdas"]))
        best = info["best_val_loss"]
        return lm, int(info["iter"]), math.inf if best is None else float(best)
    except Exception as e:
        # absent, not Parquet, or not this layout; any other failure (storage out of reach) goes through
        unreadable = any(x in str(e) for x in ("CANNOT_READ_FILE_FOOTER", "is not a Parquet file"))
        if not (unreadable or isinstance(e, (AnalysisException, KeyError, TypeError, ValueError))):
            raise
        logging.getLogger(__name__).warning("no model at %s, starting from scratch: %s", path, str(e).splitlines()[0] if str(e) else type(e).__name__)
        return None, 0, math.inf


def model_config(spark: SparkSession, path: str) -> dict:
    """The configuration saved with a model."""
    return json.loads(_last(spark, path)["info"])["config"]
