"""Batch inference with a user's own model.

``make_predict_fn`` runs once per Python worker and returns a function from a
numpy batch to a numpy batch (``pyspark.ml.functions.predict_batch_udf``), so
the model loads once per worker, batches are of fixed size and row order
inside a partition is kept. The model is the user's; the library feeds it.

A batch on which the model raises can be skipped: its rows keep a null result and the
reason, the others theirs. ``batch_losses`` and ``mean_loss`` do the same for a
validation loss by batches (L4).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, StringType, StructField, StructType


def infer(df: DataFrame, make_predict_fn: Callable, input_col: str, batch_size: int = 4,
          out: str = "prediction", return_type: DataType = DoubleType(),
          input_length: int | None = None, on_error: str = "raise") -> DataFrame:
    """Add ``out`` = the user's model applied to ``input_col`` in batches.

    With ``on_error="skip"`` the rows of a batch on which the model raises get a null
    ``out``, and ``error`` (added; null for the others) holds the exception. A model
    that cannot be made fails the job in both cases.
    """
    from pyspark.ml.functions import predict_batch_udf

    if on_error not in ("raise", "skip"):
        raise ValueError("on_error is 'raise' or 'skip'")

    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    shape = [input_length] if input_length else None
    shapes = [shape] if shape else None
    if on_error == "raise":
        udf = predict_batch_udf(make_predict_fn, return_type=return_type, batch_size=batch_size, input_tensor_shapes=shapes)
        return df.withColumn(out, udf(F.col(input_col)))

    def make_guarded():
        predict = make_predict_fn()

        def guarded(x):
            value, error = np.full(len(x), None, object), np.full(len(x), None, object)
            try:
                value[:] = list(predict(x))
            except Exception as e:
                error[:] = f"{type(e).__name__}: {e}"
            return {"value": value, "error": error}
        return guarded

    kind = StructType([StructField("value", return_type), StructField("error", StringType())])
    udf = predict_batch_udf(make_guarded, return_type=kind, batch_size=batch_size, input_tensor_shapes=shapes)
    got = df.withColumn("_got", udf(F.col(input_col)))
    return got.withColumn(out, F.col("_got.value")).withColumn("error", F.col("_got.error")).drop("_got")


def batch_losses(windows: DataFrame, make_loss_fn: Callable, batch_col: str = "batch_id", order_col: str = "window_idx") -> DataFrame:
    """``batch_col, n_windows, loss, error``: the user's loss of every batch of windows.

    ``make_loss_fn`` runs once a task and returns a function of two integer arrays, x and
    y of the batch's windows in order, to a number. Where it raises, the loss is null and
    ``error`` holds the exception; other batches are not touched. A batch is one group.
    """
    made: list[Callable] = []

    def loss(pdf: pd.DataFrame) -> pd.DataFrame:
        if not made:
            made.append(make_loss_fn())
        pdf = pdf.sort_values("o")
        value, error = None, None
        try:
            value = float(made[0](np.stack(pdf["x"].to_numpy()), np.stack(pdf["y"].to_numpy())))
        except Exception as e:
            error = f"{type(e).__name__}: {e}"
        return pd.DataFrame({"b": pdf["b"].iloc[:1], "n": [len(pdf)], "loss": pd.array([value], "Float64"), "error": [error]})

    rows = windows.select(F.col(batch_col).alias("b"), F.col(order_col).alias("o"), "x", "y")
    kind = rows.schema["b"].dataType.simpleString()
    out = rows.groupBy("b").applyInPandas(loss, f"b {kind}, n bigint, loss double, error string")
    return out.select(F.col("b").alias(batch_col), F.col("n").alias("n_windows"), "loss", "error")


def mean_loss(losses: DataFrame, empty: float = float("inf")) -> DataFrame:
    """``val_loss, n_batches, n_skipped``: the unweighted mean over the batches that did not
    fail (L4); ``empty`` if none is left."""
    sound = F.col("error").isNull()
    return losses.agg(F.coalesce(F.avg(F.when(sound, F.col("loss"))), F.lit(float(empty))).alias("val_loss"),
                      F.count(F.when(sound, 1)).alias("n_batches"), F.count("error").alias("n_skipped"))
