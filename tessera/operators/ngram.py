"""Count-based next-token model over training windows (L1-L4).

The reference trains a network on windows and reports mean validation loss;
here the model is an n-gram count table built with ``groupBy`` and scored with
joins (Jelinek-Mercer interpolation; Chen & Goodman 1998; counting at scale as
in Brants et al. 2007). Contexts are space-joined id strings, order 1 has the
empty context.

* Loss (L3, L4) uses the interpolated model with a uniform floor, so every id
  of the vocabulary has positive probability:
  ``p(w|h) = (l0/V + sum_k lk * c_k(h_k, w) / T_k(h_k)) / (l0 + sum_k lk)``
  where both sums run over the orders whose context ``h_k`` was seen.
* ``score_interpolated`` gives that model's whole next-token distribution, a row per
  id; generation (G9) samples from it without writing it out (``sparse_scores``).
* ``score_next`` (L2) uses longest-match backoff: the longest seen
  context ending at the last id; if the last id was never seen as a context,
  the most recent earlier id that was; if none was, all ids by their counts. The candidates are exactly that
  context's continuations, ``p = c(h, w) / T(h)``, found by an equi-join on
  the context, so no row is paired with the whole vocabulary.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import cut_lineage, ensure_checkpoint_dir, shuffle_partitions

from tessera.operators.vocab import BROADCAST_BYTES, PAD


FOLDER_CONTEXTS = 1 << 14  # contexts in a folder of continuations, on average
FEWEST_FOLDERS, MOST_FOLDERS = 1 << 10, 1 << 13  # with fewer, reading all is as quick

_TAIL = 1 << 30  # contexts that end at the last id rank above all earlier ones


@dataclass
class NgramModel:
    order: int
    counts: DataFrame   # order INT, ctx STRING, token INT, n BIGINT
    totals: DataFrame   # order INT, ctx STRING, total BIGINT, n_types BIGINT
    n_tokens: int
    vocab_size: int
    lambdas: tuple
    _continuations: DataFrame | None = None
    folders: int = 0     # that the continuations lie in, once written

    def continuations(self, contexts: DataFrame | None = None) -> DataFrame:
        """``order, ctx, tokens, adds`` for the orders from 2 on: what each continuation of a
        context adds to its probability's numerator. One row a context, at most the
        vocabulary in a row; written once, bucketed by (order, ctx), so that joins on
        the context move only their other side. The buckets of a large model lie in several
        folders each, by the same hash: with ``contexts`` (few rows of ``order, ctx``) only the
        folders that can hold these are read."""
        if self._continuations is None:
            n = shuffle_partitions(self.counts.sparkSession)
            in_bucket = self.totals.filter("order >= 2").count() // n
            each = min(in_bucket // FOLDER_CONTEXTS, MOST_FOLDERS // n)
            self.folders = n * each if each > 1 and n * each >= FEWEST_FOLDERS else n
            lam = F.element_at(F.array(*map(F.lit, self.lambdas)), F.col("order") + 1)
            rows = self.counts.filter("order >= 2").groupBy("order", "ctx").agg(
                F.collect_list(F.struct("token", "n")).alias("c"), F.sum("n").alias("total"))
            adds = F.transform("c.n", lambda n: lam * n / F.col("total"))
            rows = rows.select("order", "ctx", F.col("c.token").alias("tokens"), adds.alias("adds"), self._folder().alias("folder"))
            several = self.folders > n
            self._continuations = bucketed(rows if several else rows.drop("folder"), "contexts", "order", "ctx", parts=("folder",) if several else ())
        table = self._continuations
        if "folder" not in table.columns:
            return table
        if contexts is not None:
            table = table.filter(F.col("folder").isin(sorted({r[0] for r in contexts.select(self._folder()).collect()})))
        return table.drop("folder")

    def _folder(self) -> Column:
        return F.pmod(F.hash("order", "ctx"), F.lit(self.folders))  # modulo the buckets it is the bucket

    def partitioned(self) -> NgramModel:
        """The same model with its tables bucketed as a fitted one's, for a loaded model
        that is to score more than once."""
        counts = bucketed(self.counts, "counts", "ctx", "token", parts=("order",))
        return NgramModel(self.order, counts, bucketed(self.totals, "totals", "ctx", parts=("order",)), self.n_tokens, self.vocab_size, self.lambdas)

    def level_counts(self, k: int) -> DataFrame:
        """Which side of a join is broadcast is left to Spark's measured sizes."""
        return self.counts.filter(F.col("order") == k).drop("order")

    def level_totals(self, k: int) -> DataFrame:
        return self.totals.filter(F.col("order") == k).drop("order")


def bucketed(df: DataFrame, name: str, *by: str, parts: tuple[str, ...] = ()) -> DataFrame:
    """``df`` as a table in the session's shared folder, bucketed by ``by``: a join or
    aggregation on these columns reads it without an exchange. Folders by ``parts``, one
    file a folder and bucket."""
    spark = df.sparkSession
    n, table = shuffle_partitions(spark), f"tessera_{name}_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera-out/{table}"
    (df.repartition(n, *by).write.format("parquet").option("path", path).partitionBy(*parts)
     .bucketBy(n, *by).sortBy(*by).saveAsTable(table))
    return spark.table(table).select(df.columns)


def tail_contexts(tokens: Column, order: int) -> Column:
    """The contexts of orders 2 to ``order`` at the end of ``tokens``: array of (order,
    ctx), ctx null where the tokens are too few."""
    n = F.size(tokens)
    return F.array(*[F.struct(F.lit(k).alias("order"),
                              F.when(n >= k - 1, F.array_join(F.slice(tokens, -(k - 1), k - 1).cast("array<string>"), " ")).alias("ctx"))
                     for k in range(2, order + 1)])


def _ctx(x: Column, t: Column, k: int) -> Column:
    """Order-k context of target position t (0-based): x[t-k+2 .. t] as text."""
    if k == 1:
        return F.lit("")
    start = t - (k - 2)
    return F.when(start >= 0, F.array_join(F.slice(x, (start + 1).cast("int"), k - 1).cast("array<string>"), " "))


def _targets(windows: DataFrame, pad: int, key: str = "window_idx") -> DataFrame:
    """One row per real target: ``key, t, token, x``."""
    return (windows.select(key, "x", F.posexplode("y").alias("t", "token"))
            .filter(F.col("token") != F.lit(pad)))


def fit_ngram(windows: DataFrame, order: int = 3, vocab_size: int | None = None,
              lambdas: tuple | None = None, pad: int = PAD) -> NgramModel:
    """Count (context, next id) pairs of the training windows (L1).

    Target ``y[t]`` is counted after contexts taken from ``x[..t]`` only, so a
    token never sees a later position (causal). Overlapping windows count a
    token once per window, as the reference's training sees it. One pass, one
    partial aggregate over (order, context, token).
    """
    if order < 1:
        raise ValueError("order must be at least 1")
    lambdas = tuple(lambdas) if lambdas is not None else (0.01,) + tuple(
        (i + 1) / sum(range(1, order + 1)) * 0.99 for i in range(order))
    if len(lambdas) != order + 1:
        raise ValueError("one weight per order plus the uniform floor")
    tg = _targets(windows, pad)
    levels = F.array(*[F.struct(F.lit(k).alias("order"), _ctx(F.col("x"), F.col("t"), k).alias("ctx"))
                       for k in range(1, order + 1)])
    rows = tg.select("token", F.explode(levels).alias("l")).select("l.order", "l.ctx", "token").filter(
        F.col("ctx").isNotNull())
    # bucketed as the scoring joins need them: those move their own rows only
    counts = bucketed(rows.groupBy("order", "ctx", "token").agg(F.count(F.lit(1)).alias("n")), "counts", "ctx", "token", parts=("order",))
    totals = bucketed(counts.groupBy("order", "ctx").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("n_types")),
                      "totals", "ctx", parts=("order",))
    sizes = totals.agg(
        F.coalesce(F.sum(F.when(F.col("order") == 1, F.col("total"))), F.lit(0)).alias("n_tokens"),
        F.coalesce(F.sum(F.when(F.col("order") == 1, F.col("n_types"))), F.lit(0)).alias("n_types")).first()
    if sizes["n_tokens"] == 0:
        raise ValueError("no training windows: the split left no real targets to count")
    v = vocab_size if vocab_size is not None else sizes["n_types"] + 4
    return NgramModel(order, counts, totals, int(sizes["n_tokens"]), int(v), lambdas)


def _contexts(windows: DataFrame, lm: NgramModel, pad: int, *keys: str) -> DataFrame:
    """One row per real target: ``keys, t, token`` and its context per order ``_h2``..."""
    tg = (windows.select(*keys, "x", F.posexplode("y").alias("t", "token")).filter(F.col("token") != F.lit(pad)))
    for k in range(2, lm.order + 1):
        tg = tg.withColumn(f"_h{k}", _ctx(F.col("x"), F.col("t"), k))
    return tg.drop("x")


def _with_prob(rows: DataFrame, lm: NgramModel) -> DataFrame:
    """Add the interpolated ``prob`` to rows of ``token`` and contexts.

    Per order one join on (context, token) for the count and one on the context for
    its total. A fitted model's tables are bucketed by just these columns, so these
    joins have no exchange on the model's side. Order 1 joins on the token alone, with
    the vocabulary's counts broadcast where they fit the bound.
    """
    first = lm.level_counts(1).select("token", F.col("n").alias("_c1"))
    rows = rows.join(F.broadcast(first) if lm.vocab_size * 24 <= BROADCAST_BYTES else first, "token", "left")
    for k in range(2, lm.order + 1):
        ck = lm.level_counts(k).select(F.col("ctx").alias(f"_h{k}"), "token", F.col("n").alias(f"_c{k}"))
        tk = lm.level_totals(k).select(F.col("ctx").alias(f"_h{k}"), F.col("total").alias(f"_t{k}"))
        rows = rows.join(ck, [f"_h{k}", "token"], "left").join(tk, [f"_h{k}"], "left")
    lam = lm.lambdas
    num = F.lit(lam[0] / lm.vocab_size) + F.lit(lam[1]) * F.coalesce(F.col("_c1"), F.lit(0)) / F.lit(float(lm.n_tokens))
    den = F.lit(lam[0] + lam[1])
    for k in range(2, lm.order + 1):
        seen = F.col(f"_t{k}").isNotNull()
        num = num + F.when(seen, F.lit(lam[k]) * F.coalesce(F.col(f"_c{k}"), F.lit(0)) / F.col(f"_t{k}")).otherwise(0.0)
        den = den + F.when(seen, F.lit(lam[k])).otherwise(0.0)
    return rows.withColumn("prob", num / den).withColumn("loss", -F.log("prob"))


def _loss_sums(windows: DataFrame, lm: NgramModel, pad: int, *keys: str) -> DataFrame:
    """``keys, loss_sum, n``: targets are first counted per (keys, contexts, token), a
    partial aggregate and the only shuffle of target rows; the model is joined to the
    distinct combinations."""
    by = [*keys, "token", *(f"_h{k}" for k in range(2, lm.order + 1))]
    distinct = _contexts(windows, lm, pad, *keys).groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    return _with_prob(distinct, lm).groupBy(*keys).agg(F.sum(F.col("n") * F.col("loss")).alias("loss_sum"), F.sum("n").alias("n"))


def token_losses(windows: DataFrame, lm: NgramModel, pad: int = PAD, key: str = "window_idx") -> DataFrame:
    """``key, t, token, prob, loss`` for every real target (L3 rows)."""
    return _with_prob(_contexts(windows, lm, pad, key), lm).select(key, "t", "token", "prob", "loss")


def token_loss(windows: DataFrame, lm: NgramModel, pad: int = PAD) -> DataFrame:
    """One row: mean cross-entropy over real targets (null without any) and their count (L3)."""
    s = _loss_sums(windows, lm, pad)
    return s.select((F.col("loss_sum") / F.col("n")).alias("loss"), F.coalesce("n", F.lit(0)).alias("n_targets"))


def eval_loss(windows: DataFrame, lm: NgramModel, pad: int = PAD, batch_col: str = "batch_id",
              empty: float = float("inf")) -> DataFrame:
    """Validation loss as the reference reports it: the unweighted mean of
    per-batch mean losses (L4). ``windows`` carry ``batch_col`` (D7). With no
    batches the loss is ``empty`` (+inf, as in the improved script; pass 0.0
    for the base script's rule)."""
    batches = _loss_sums(windows, lm, pad, batch_col).select((F.col("loss_sum") / F.col("n")).alias("batch_loss"))
    return batches.agg(F.coalesce(F.avg("batch_loss"), F.lit(float(empty))).alias("val_loss"),
                       F.count(F.lit(1)).alias("n_batches"))


CONTEXT_BYTES = 128  # of a context sent to the tasks


def score_next(contexts: DataFrame, lm: NgramModel, key: str = "row_id", tokens: str = "tokens",
               n_contexts: int | None = None) -> DataFrame:
    """Next-token distribution per row: ``key, token, logit, ctx_order`` (L2).

    Longest-match backoff: among contexts ending at the last id (orders
    ``order`` down to 2) the longest one seen in training; if none, the most
    recent earlier id seen as a bigram context; if none, order 1, the counts of
    all ids. Candidates are that context's continuations, ``logit = ln(c / T)``,
    so every row has a distribution. An order-1 model uses order 1 for every row.

    The model's tables are read where they lie and only the asked contexts move: to every
    task if ``n_contexts``, a bound of the contexts that all rows ask for (counted if not
    given), fits the broadcast bound, else by shuffles of both sides.
    """
    n = F.size(tokens)
    tail = [F.struct(F.lit(k).alias("order"),
                     F.when(n >= k - 1, F.array_join(F.slice(tokens, -(k - 1), k - 1).cast("array<string>"), " ")).alias("ctx"),
                     F.lit(_TAIL + k).alias("rank"))
            for k in range(lm.order, 1, -1)]
    # earlier ids, the later the better, then the empty context that every model has
    earlier = F.transform(F.col(tokens), lambda t, i: F.struct(F.lit(2).alias("order"), t.cast("string").alias("ctx"), i.cast("int").alias("rank")))
    empty = F.struct(F.lit(1).alias("order"), F.lit("").alias("ctx"), F.lit(-1).alias("rank"))
    levels = F.concat(F.array(*tail, empty), earlier) if tail else F.array(empty)
    cand = contexts.select(key, F.explode(levels).alias("l")).select(key, "l.order", "l.ctx", "l.rank").filter(F.col("ctx").isNotNull())
    if n_contexts is None:
        cand = cut_lineage(cand)
        n_contexts = cand.count()
    small = F.broadcast if n_contexts * CONTEXT_BYTES <= BROADCAST_BYTES else lambda df: df
    seen = lm.totals.join(small(cand.select("order", "ctx").distinct()), ["order", "ctx"], "left_semi")
    hit = cand.join(small(seen.select("order", "ctx", "total")), ["order", "ctx"])
    best = hit.groupBy(key).agg(F.max_by(F.struct("order", "ctx", "total"), F.col("rank")).alias("b")).select(key, "b.order", "b.ctx", "b.total")
    rows = lm.counts.join(small(best), ["order", "ctx"])
    return rows.select(key, "token", F.log(F.col("n") / F.col("total")).alias("logit"), F.col("order").alias("ctx_order"))


CHUNK = 1 << 14  # ids scored together


def _chunk_of(token: str) -> Column:
    return F.floor(F.col(token) / F.lit(CHUNK)).cast("int")


def _asked_parts(rows: DataFrame, lm: NgramModel) -> tuple[DataFrame, DataFrame]:
    """(``_r, _chunk, part``: what the contexts of row ``_r`` add to ids of a chunk, a struct
    (order, tokens, adds); ``_r, _seen``: the orders whose context was seen). ``rows`` have
    ``_r`` and ``_tail``. The counts are read once where they lie; only the asked contexts
    move, to every task if they fit the broadcast bound."""
    asked = rows.select("_r", F.explode("_tail").alias("l")).select("_r", "l.order", "l.ctx").filter("ctx is not null")
    asked = cut_lineage(asked)
    small = F.broadcast if asked.count() * CONTEXT_BYTES <= BROADCAST_BYTES else lambda df: df
    found = lm.counts.filter("order >= 2").join(small(asked.select("order", "ctx").distinct()), ["order", "ctx"], "left_semi")
    found = cut_lineage(found.select("order", "ctx", "token", "n"))
    totals = found.groupBy("order", "ctx").agg(F.sum("n").alias("total"))
    # a context's continuations are cut into chunks once, however many rows ask for it
    cut = (found.filter((F.col("token") >= 0) & (F.col("token") < lm.vocab_size)).groupBy("order", "ctx", _chunk_of("token").alias("_chunk"))
           .agg(F.collect_list(F.struct("token", "n")).alias("c")).join(totals, ["order", "ctx"]))
    lam = F.element_at(F.array(*map(F.lit, lm.lambdas)), F.col("order") + 1)
    cut = cut.select("order", "ctx", "_chunk", F.struct("order", F.col("c.token").alias("tokens"), F.transform("c.n", lambda n: lam * n / F.col("total")).alias("adds")).alias("part"))
    parts = cut.join(small(asked), ["order", "ctx"]).select("_r", "_chunk", "part")
    seen = totals.join(small(asked), ["order", "ctx"]).groupBy("_r").agg(F.collect_set("order").alias("_seen"))
    return parts, seen


def score_interpolated(contexts: DataFrame, lm: NgramModel, key: str = "row_id", tokens: str = "tokens") -> DataFrame:
    """``key, token, logit`` of every id of the vocabulary for every row (L2, the whole distribution).

    ``logit`` is the ln of the probability that L3 gives the id as the row's next
    target. An id without any, possible only if the uniform floor's weight is 0, has
    no row. The output is rows times vocabulary, as the reference's scores are.

    A task fills a chunk of ids of a row at a time: the order-1 weights of the chunk, which
    all rows share, plus what the row's contexts add. So the joins are of rows times
    chunks, and rows times vocabulary are written out only as the result.
    """
    lam, v, n_tokens, width = lm.lambdas, lm.vocab_size, lm.n_tokens, CHUNK
    tails = tail_contexts(F.col(tokens), lm.order) if lm.order > 1 else F.lit(None)
    rows = cut_lineage(contexts.select(F.monotonically_increasing_id().alias("_r"), F.col(key).alias("_key"), tails.alias("_tail")))  # keys may repeat
    chunks = -(-v // width)
    first = (lm.level_counts(1).filter((F.col("token") >= 0) & (F.col("token") < v)).groupBy(_chunk_of("token").alias("_chunk"))
             .agg(F.collect_list(F.struct("token", "n")).alias("_first")))
    asked = rows.select("_r", "_key")
    part = "struct<order:int,tokens:array<int>,adds:array<double>>"
    if lm.order > 1:
        parts, seen = _asked_parts(rows, lm)
        asked = asked.join(seen, "_r", "left")
    else:
        asked = asked.withColumn("_seen", F.lit(None).cast("array<int>"))
    pairs = asked.select("_r", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("_chunk"),
                         F.struct("_key", "_seen").alias("_row"), F.lit(None).cast(part).alias("part"))
    if lm.order > 1:
        pairs = pairs.unionByName(parts.select("_r", "_chunk", "part"), allowMissingColumns=True)
    # so many tasks whatever the bytes: the pairs are few and narrow, what is made of them is not
    tasks = max(shuffle_partitions(contexts.sparkSession), contexts.sparkSession.sparkContext.defaultParallelism)
    pairs = pairs.repartition(tasks, "_r", "_chunk").groupBy("_r", "_chunk").agg(F.first("_row", ignorenulls=True).alias("_row"), F.collect_list("part").alias("_parts"))
    pairs = pairs.join(F.broadcast(first) if v * 24 <= BROADCAST_BYTES else first, "_chunk", "left").select("_row._key", "_row._seen", "_chunk", "_parts", "_first")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (seen, chunk) in enumerate(zip(batch.column("_seen").to_pylist(), batch.column("_chunk").to_pylist())):
                low = chunk * width
                num, den = np.full(min(width, v - low), lam[0] / v), lam[0] + lam[1]
                counted = batch.column("_first")[i].values
                if counted is not None:
                    at, c = (counted.field(f).to_numpy(zero_copy_only=False) for f in ("token", "n"))
                    num[at - low] += lam[1] * c / float(n_tokens)
                for order in sorted(seen or []):
                    den += lam[order]
                for p in sorted(batch.column("_parts")[i], key=lambda p: p["order"].as_py()):
                    num[p["tokens"].values.to_numpy(zero_copy_only=False) - low] += p["adds"].values.to_numpy(zero_copy_only=False)
                ids, prob = np.arange(low, low + len(num), dtype=np.int32), num / den
                if not (some := prob > 0).all():
                    ids, prob = ids[some], prob[some]
                keys = batch.column("_key").take(pa.array(np.full(len(ids), i)))
                yield pa.RecordBatch.from_arrays([keys, pa.array(ids), pa.array(np.log(prob))], [key, "token", "logit"])

    schema = T.StructType([T.StructField(key, rows.schema["_key"].dataType), T.StructField("token", T.IntegerType()), T.StructField("logit", T.DoubleType())])
    return pairs.mapInArrow(fill, schema)


def unigram(lm: NgramModel) -> DataFrame:
    """The order-1 distribution ``token, logit`` (shared by every context)."""
    return lm.counts.filter(F.col("order") == 1).select(
        "token", F.log(F.col("n") / F.lit(float(lm.n_tokens))).alias("logit"))
