"""Token stream offsets and training windows.

The corpus is one token stream: records in ``idx`` order, each record's ids in
order. The stream is never built as one array. Each record learns its global
start (D1) and is cut into the pieces that fall into each chunk of the stream that
it touches; the chunks, a few blocks each, are stored, and windows are slices of
them (D3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage

from tessera.functions.arrays import pad_right
from tessera.operators.ordering import prefix_sum
from tessera.operators.vocab import PAD


def global_offsets(df: DataFrame, key: str = "idx", tokens: str = "tokens",
                   buckets: int | None = None) -> DataFrame:
    """Add ``n`` (ids in the record) and ``start`` (ids before it in ``key`` order).

    The two-level prefix sum (range buckets on ``key``, bucket totals, running
    sum inside each bucket) runs on narrow ``key, n`` rows only; the starts
    are joined back on ``key``. When ``df`` is already hash-partitioned on
    ``key`` (as ``encode``'s output is), only the narrow side moves.
    """
    sizes = df.select(key, F.size(tokens).cast("bigint").alias("n"))
    starts = prefix_sum(sizes, [key], F.col("n"), "start", exclusive=True, buckets=buckets)
    return df.join(starts, key)


def n_windows(n_tokens: int, block: int, step: int) -> int:
    """1 if the stream is shorter than a block, else floor((N - block) / step) + 1."""
    if n_tokens < block:
        return 1
    return (n_tokens - block) // step + 1


def window_count(df: DataFrame, block: int, step: int, tokens: str = "tokens") -> DataFrame:
    """One row: ``n_tokens``, ``n_windows`` (D2). Trailing ids past the last full
    window are not counted as a window."""
    total = F.coalesce(F.sum(F.size(tokens)), F.lit(0)).cast("bigint")
    return df.agg(total.alias("n_tokens")).select(
        "n_tokens",
        F.when(F.col("n_tokens") < block, F.lit(1))
        .otherwise(F.floor((F.col("n_tokens") - block) / step) + 1).cast("bigint").alias("n_windows"))


CHUNK_BLOCKS = 16  # blocks of the stream in a stored chunk


def token_chunks(df: DataFrame, block: int, last: int, key: str = "idx", tokens: str = "tokens",
                 size: int | None = None, buckets: int | None = None) -> DataFrame:
    """``chunk BIGINT, ids ARRAY<INT>``: the stream in chunks of ``size`` ids, each with the
    ``block`` ids after it, so that a block and its next id lie in the chunk they start in.
    Chunks up to stream position ``last``. A record is cut where chunks begin and end, and
    its pieces meet by chunk: a group holds ``size + block`` ids."""
    size = size or CHUNK_BLOCKS * block
    off = global_offsets(df, key, tokens, buckets)
    a, b = F.col("start"), F.col("start") + F.col("n")
    lo = F.greatest(F.lit(0), F.floor((a - size - block) / size) + 1).cast("bigint")
    hi = F.least(F.lit(last // size), F.floor((b - 1) / size)).cast("bigint")
    touched = (off.filter(F.col("n") > 0).select("start", tokens, lo.alias("lo"), hi.alias("hi")).filter(F.col("lo") <= F.col("hi"))
               .select("start", tokens, F.explode(F.sequence("lo", "hi")).alias("chunk")))
    s = F.greatest(F.col("start"), F.col("chunk") * size)
    e = F.least(F.col("start") + F.size(tokens), F.col("chunk") * size + size + block)
    piece = F.slice(tokens, (s - F.col("start") + 1).cast("int"), (e - s).cast("int"))
    parts = touched.select("chunk", F.struct(s.alias("s"), piece.alias("ids")).alias("part"))
    grouped = parts.groupBy("chunk").agg(F.array_sort(F.collect_list("part")).alias("p"))
    return grouped.select("chunk", F.flatten(F.transform("p", lambda p: p["ids"])).alias("ids"))


def pack_windows(df: DataFrame, block: int, step: int, pad: int = PAD, key: str = "idx",
                 tokens: str = "tokens", buckets: int | None = None) -> DataFrame:
    """``window_idx BIGINT, x ARRAY<INT>, y ARRAY<INT>``.

    Window ``k`` holds stream ids ``[k*step, k*step + block)`` as ``x`` and the
    same span moved on by one as ``y``; both are right-padded with ``pad`` to
    ``block``. ``step < block`` overlaps windows, ``step > block`` leaves gaps.
    An empty corpus gives one all-pad window.

    Windows are not stored: the stream is, once, in chunks (reliable checkpoint), and a
    window is a place in a chunk from which ``x`` and ``y`` are sliced when it is read.
    """
    if block <= 0 or step <= 0:
        raise ValueError("block and step must be positive")
    spark = df.sparkSession
    # read twice (stream length, then offsets and the cut): keep one computed copy
    df = cut_lineage(df.select(key, tokens))
    n_tok = df.agg(F.coalesce(F.sum(F.size(tokens)), F.lit(0))).first()[0]
    nwin = n_windows(int(n_tok), block, step)
    if n_tok == 0:
        empty = F.array_repeat(F.lit(pad), block)
        return spark.range(1).select(F.col("id").alias("window_idx"), empty.alias("x"), empty.alias("y"))
    size = CHUNK_BLOCKS * block
    chunks = cut_lineage(token_chunks(df, block, (nwin - 1) * step, key, tokens, size, buckets))
    begin = F.col("chunk") * size
    first, last = F.ceil(begin / step), F.least(F.lit(nwin), F.ceil((begin + size) / step)) - 1
    held = chunks.filter(first <= last).select("chunk", "ids", F.explode(F.sequence(first.cast("bigint"), last.cast("bigint"))).alias("window_idx"))
    at = (F.col("window_idx") * step - begin + 1).cast("int")
    return held.select("window_idx", pad_right(F.slice("ids", at, F.lit(block)), block, pad).alias("x"),
                       pad_right(F.slice("ids", at + 1, F.lit(block)), block, pad).alias("y"))
