"""Sampling from the whole interpolated distribution without writing it out (L2, G1-G6 for G9).

A context's next-token probabilities are the order-1 distribution, which all contexts
share, plus additions for the few tokens that followed the context in training:

    p(w|h) = (base(w) + sum_k l_k c_k(h_k, w) / T_k(h_k)) / (l_0 + sum_k l_k),
    base(w) = l_0 / V + l_1 c_1(w) / T_1

So the distribution is kept as one table of all tokens sorted by ``base`` with running
masses, sent to the tasks once, and a row brings only its own tokens: those with an
addition and those already seen, which the repetition penalty moves. The nucleus and
the draw are positions in the merge of the two sorted lists. They are found by bisection
over sums of running masses, stopping where the mass asked for is reached; no row is
ever paired with the vocabulary.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.config import Config
from tessera.functions.arrays import truncate_context
from tessera.functions.hashing import hash_unit
from tessera.operators.ngram import NgramModel, tail_contexts
from tessera.operators.vocab import BROADCAST_BYTES

TOKEN_BYTES = 8  # of the shared table: token and place; all else is one row a level


class Shared:
    """All tokens by order-1 weight (ties: the smaller token first), at one temperature.
    Tokens of one weight are a level; there are as many as different counts."""

    def __init__(self, base: np.ndarray, temperature: float):
        order = np.argsort(-base, kind="stable")
        self.token, self.temperature = order.astype(np.int32), temperature
        self.place = np.empty(len(order), np.int32)  # of a token
        self.place[order] = np.arange(len(order), dtype=np.int32)
        change = np.concatenate([[True], base[order[1:]] != base[order[:-1]]])
        self.start = np.flatnonzero(change)  # of each level
        self.weight = base[order[self.start]]
        with np.errstate(divide="ignore"):
            self.log = np.log(self.weight) / temperature
        self.mass = np.exp(self.log - self.log[0])   # over the heaviest token's
        size = np.diff(np.append(self.start, len(order)))
        self.level_before = np.concatenate([[0.0], np.cumsum(self.mass * size)])
        self.ends = np.append(self.start, len(order))

    def level(self, place):
        """The level that a place is in."""
        return np.searchsorted(self.start, place, "right") - 1

    def before(self, j):
        """Mass of the first ``j`` tokens."""
        k = self.level(j)
        return self.level_before[k] + (j - self.start[k]) * self.mass[k]


class Merged:
    """One row's distribution: the shared order without the row's own tokens, which stand
    at their own weights. Heaviest first, ties by token."""

    def __init__(self, shared: Shared, tokens: np.ndarray, added: np.ndarray, seen: np.ndarray, den: float, penalty: float, mode: str):
        """``added[i]`` goes to ``tokens[i]`` (distinct); ``seen`` are distinct tokens."""
        if penalty == 1:
            seen = seen[:0]  # unmoved: they keep their places in the shared order
        own = np.union1d(tokens, seen).astype(np.int64)
        gain = np.zeros(len(own))
        gain[np.searchsorted(own, tokens)] = added
        with np.errstate(divide="ignore"):
            logit = np.log((shared.weight[shared.level(shared.place[own])] + gain) / den) / shared.temperature
        hit = np.isin(own, seen)
        raised = logit / penalty
        logit = np.where(hit, np.where(logit < 0, logit * penalty, raised) if mode == "sign_aware" else raised, logit)
        shift = -math.log(den) / shared.temperature  # of the shared logarithms
        top = max(float(logit.max(initial=-math.inf)), float(shared.log[0]) + shift)
        order = np.lexsort((own, -logit))
        self.shared, self.own, logit = shared, own[order], logit[order]
        self.weight = np.exp(logit - top)
        self.running = np.cumsum(self.weight)
        self.scale = math.exp(float(shared.log[0]) + shift - top)
        places = np.sort(shared.place[own])
        self.places, self.hidden = places, np.concatenate([[0.0], np.cumsum(shared.mass[shared.level(places)])])
        # how many shared tokens stand before each own token
        x = -(logit - shift)
        low, high = (shared.ends[np.searchsorted(-shared.log, x, side)] for side in ("left", "right"))
        for i in np.flatnonzero(high > low):
            low[i] += np.searchsorted(shared.token[low[i]:high[i]], self.own[i])
        self.rank = low
        self.total = self.shared_before(len(shared.token)) + (float(self.running[-1]) if len(own) else 0.0)

    def shared_before(self, j):
        """Mass of the first ``j`` shared tokens without the row's own."""
        left = self.shared.before(j) - self.hidden[np.searchsorted(self.places, j)]
        return self.scale * np.maximum(left, 0.0)

    def reach(self, mass: float) -> tuple[int, float]:
        """The first token at which the running mass exceeds ``mass`` (else the last), and that running mass."""
        i = int(np.argmax(up)) if len(self.own) and (up := self.running + self.shared_before(self.rank) > mass).any() else len(self.own)
        held = float(self.running[i - 1]) if i else 0.0
        end = int(self.rank[i]) if i < len(self.own) else len(self.shared.token)
        a, b = 0, end  # the first shared token past the mass, among those before own token i
        while a < b:
            m = (a + b) // 2
            if held + self.shared_before(m + 1) > mass:
                b = m
            else:
                a = m + 1
        if a < end:
            return int(self.shared.token[a]), held + float(self.shared_before(a + 1))
        if i < len(self.own):
            return int(self.own[i]), float(self.running[i] + self.shared_before(end))
        # rounding left the mass above every sum: the last token of all
        rest = np.setdiff1d(np.arange(len(self.shared.token) - min(len(self.shared.token), len(self.own) + 1), len(self.shared.token)), self.places)
        last = int(self.shared.token[rest[-1]]) if len(rest) else -1
        if len(self.own) and (last < 0 or self.rank[-1] > rest[-1]):
            last = int(self.own[-1])
        return last, self.total

    def draw(self, p: float, u: float) -> int:
        """A token of the nucleus of mass ``p``: the first whose running mass exceeds ``u`` of the nucleus."""
        _, kept = self.reach(p * self.total)
        return self.reach(u * kept)[0]


def shared_base(lm: NgramModel) -> np.ndarray | None:
    """``base`` of every token, or None where the table would not fit the broadcast bound."""
    if lm.vocab_size * TOKEN_BYTES > BROADCAST_BYTES:
        return None
    base = np.full(lm.vocab_size, lm.lambdas[0] / lm.vocab_size)
    rows = lm.level_counts(1).select("token", "n").toArrow()  # at most vocab_size rows
    token, n = (rows.column(c).to_numpy() for c in ("token", "n"))
    base[token] += lm.lambdas[1] * n / lm.n_tokens
    return base


ASKED_BYTES = 256  # of a row and one of its contexts


def additions(active: DataFrame, lm: NgramModel, ctx: Column, key: str, n_active: int | None = None) -> DataFrame:
    """``key, part``: what the contexts at the end of ``ctx`` add, a struct (order, tokens,
    adds) for each of them that was seen in training. The model's side is read by context
    as it was written; only the rows' contexts move: to every task if ``n_active`` rows
    fit the broadcast bound (and where there are few, only their folders of the model are
    read), else by hash to the model's buckets."""
    asked = active.select(key, F.explode(tail_contexts(ctx, lm.order)).alias("l")).select(key, "l.order", "l.ctx").filter("ctx is not null")
    table = lm.continuations()
    if n_active is not None and n_active * (lm.order - 1) * ASKED_BYTES <= BROADCAST_BYTES:
        if n_active * (lm.order - 1) * 2 <= lm.folders:
            table = lm.continuations(asked)
        asked = F.broadcast(asked)
    return table.join(asked, ["order", "ctx"]).select(key, F.struct("order", "tokens", "adds").alias("part"))


def _runs(lists: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(offsets from 0, flat values) of a list array without nulls."""
    return np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64), lists.flatten()


def next_tokens(active: DataFrame, lm: NgramModel, shared, cfg: Config, seen: Column, key: str,
                n_active: int | None = None) -> DataFrame:
    """``key, prompt, gen, next``: one drawn token per row of ``active`` (``key`` unique and not null).

    ``shared`` is a broadcast of ``Shared``. Rows are at step ``size(gen)``: nothing in the
    plan changes from step to step, so its code is compiled once. The distribution is L3's; temperature (G1),
    penalty on the distinct ids of ``seen`` (G2), softmax (G3), nucleus (G4, G5) and the
    seeded draw (G6) are those of ``operators.decoding``.
    """
    carry = ["prompt", "gen"]
    part = "struct<order:int,tokens:array<int>,adds:array<double>>"
    rows = active.select(key, *carry, F.lit(None).cast(part).alias("part"))
    if lm.order > 1:  # a row and its contexts' additions meet in one exchange, on the key
        ctx = truncate_context(F.concat("prompt", "gen"), cfg.block_size)
        rows = rows.unionByName(additions(active, lm, ctx, key, n_active), allowMissingColumns=True)
    rows = rows.groupBy(key).agg(*[F.first(c, ignorenulls=True).alias(c) for c in carry], F.collect_list("part").alias("_parts"))
    rows = rows.select(key, *carry, hash_unit(cfg.seed, key, F.size("gen")).alias("_u"), F.array_distinct(seen).alias("_seen"), "_parts")
    den, lam, top_p, penalty, mode, v = lm.lambdas[0] + lm.lambdas[1], lm.lambdas, cfg.top_p, cfg.repetition_penalty, cfg.penalty_mode, lm.vocab_size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            out = []
            part, flat = _runs(batch.column("_parts"))
            orders = flat.field(0).to_numpy(zero_copy_only=False)
            run_of, tokens = _runs(flat.field(1))
            tokens, adds = (x.to_numpy(zero_copy_only=False) for x in (tokens, flat.field(2).flatten()))
            for i, (u, met) in enumerate(zip(batch.column("_u").to_pylist(), batch.column("_seen").to_pylist())):
                own = slice(run_of[part[i]], run_of[part[i + 1]])
                ids, at = np.unique(tokens[own].astype(np.int64), return_inverse=True)  # several contexts add up
                weight = den + sum(lam[k] for k in orders[part[i]:part[i + 1]])
                met = np.array([t for t in met if 0 <= t < v], np.int64)
                out.append(Merged(table, ids, np.bincount(at, adds[own], len(ids)), met, weight, penalty, mode).draw(top_p, u))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in [key, *carry]), pa.array(out, pa.int32())], [key, *carry, "next"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name in (key, *carry))
    return rows.mapInArrow(run, schema + ", next int")
