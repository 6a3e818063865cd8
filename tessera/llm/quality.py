"""Quality classifier on supervised subword embeddings.

A document's features are its words and its character n-grams, hashed into one
table of learned vectors. A text is the average of its features' vectors; a
softmax over the classes sits on top; table and output layer are trained together
by plain stochastic gradient descent in numpy on a bounded sample of labelled
documents. Scoring needs one number a feature (its vector's contribution to the
log odds), looked up for whole batches of text at once in the tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import boxed, col, field, row_schema, unboxed

GRAMS = (3, 4, 5)
BITS = 18
CHUNK = 1 << 20
SLICE_ROWS = 256  # rows of which a task holds the texts as Python objects at a time
_P = np.uint64(0x9E3779B97F4A7C15)  # odd multiplier of the rolling hash and of the final mix


@dataclass(frozen=True)
class Settings:
    """``max_docs`` labelled documents of at most ``max_bytes`` each are the sample
    that the model is fitted on; scoring has no such bounds."""
    dim: int = 16
    bits: int = BITS
    epochs: int = 4
    least_steps: int = 4000  # a small sample is gone through more often
    rate: float = 1.0
    max_docs: int = 6000
    max_bytes: int = 32768
    seed: int = 5


@dataclass(frozen=True)
class Model:
    vectors: np.ndarray  # (2 ** bits, dim)
    output: np.ndarray   # (2, dim)
    bias: np.ndarray     # (2,)

    def odds(self) -> np.ndarray:
        """Per feature: what it adds to the log odds of class 1 when it is the whole text."""
        return (self.vectors @ (self.output[1] - self.output[0])).astype(np.float64)


def chunks(text: bytes, most: int = CHUNK) -> list[bytes]:
    """``text`` in runs of about ``most`` bytes, cut at white space only (a longer word stays whole)."""
    out = []
    while len(text) > most:
        at = max(text.rfind(c, 0, most) for c in (b" ", b"\n", b"\t"))
        if at < 0:
            at = min((i for c in (b" ", b"\n", b"\t") if (i := text.find(c, most)) >= 0), default=len(text) - 1)
        out.append(text[:at + 1])
        text = text[at + 1:]
    return [*out, text]


def hashed(parts: list[bytes], bits: int = BITS) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
    """Features of all ``parts`` at once: a list of (position, bucket) arrays, positions in
    the joined bytes ``" p0  p1 ..."`` of the returned length. Words are runs of bytes over
    0x20; character n-grams hold no white space but as their first or last byte (word ends);
    word pairs are neighbours in one part."""
    joined = np.frombuffer(b"".join(b" %b " % p for p in parts), np.uint8)
    n, ends = len(joined), _bounds(parts)
    blank = joined <= 32
    byte = np.where(blank, 32, joined).astype(np.uint64) + np.uint64(1)
    shift = np.uint64(64 - bits)
    out = []
    inner = np.concatenate([[0], np.cumsum(blank, dtype=np.int32)])
    for g in GRAMS:
        if n >= g:
            h = np.zeros(n - g + 1, np.uint64)
            for j in range(g):
                h = h * _P + byte[j:n - g + 1 + j]
            whole = np.flatnonzero(inner[g - 1:n] == inner[1:n - g + 2])
            out.append((whole, (h[whole] * _P ^ h[whole] >> np.uint64(29)) * _P >> shift))
    starts = np.flatnonzero(~blank[1:] & blank[:-1]) + 1
    if len(starts):
        first = np.zeros(n, np.int64)
        first[starts] = starts
        place = np.arange(n) - np.maximum.accumulate(first)
        place[blank] = 0
        powers = np.full(int(place.max()) + 2, _P, np.uint64)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        h = np.add.reduceat(np.where(blank, np.uint64(0), byte * powers[place]), starts)
        out.append((starts, ((h + np.uint64(77)) * _P ^ h >> np.uint64(29)) * _P >> shift))
        # word pairs by the difference of their hashes: all pairs of a word with itself share a vector
        pair = (h[1:] - h[:-1] + np.uint64(33)) * _P
        same_part = np.flatnonzero(np.searchsorted(ends, starts[1:], "right") == np.searchsorted(ends, starts[:-1], "right"))
        out.append((starts[:-1][same_part], ((pair ^ pair >> np.uint64(29)) * _P >> shift)[same_part]))
    return out, n


def _bounds(parts: list[bytes]) -> np.ndarray:
    return np.concatenate([[0], np.cumsum([len(p) + 2 for p in parts])])


def bag(text: bytes, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features and their shares of a whole text."""
    found = [b for p in chunks(text) for _, b in hashed([p], bits)[0]]
    ids, n = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
    return ids.astype(np.int32), (n / max(1, n.sum())).astype(np.float32)


def train(texts: Iterable[bytes], labels: list[int], s: Settings = Settings()) -> Model:
    rng = np.random.default_rng(s.seed)
    vectors = rng.uniform(-1 / s.dim, 1 / s.dim, (1 << s.bits, s.dim)).astype(np.float32)
    output, bias = np.zeros((2, s.dim), np.float32), np.zeros(2, np.float32)
    bags = [bag(t, s.bits) for t in texts]
    epochs = max(s.epochs, -(-s.least_steps // max(1, len(bags))))
    total, done = max(1, epochs * len(bags)), 0
    for _ in range(epochs if bags else 0):
        for i in rng.permutation(len(bags)):
            ids, share = bags[i]
            rate = s.rate * (1 - done / total)
            done += 1
            hidden = share @ vectors[ids] if len(ids) else np.zeros(s.dim, np.float32)
            z = output @ hidden + bias
            p = np.exp(z - z.max())
            error = p / p.sum()
            error[labels[i]] -= 1
            back = error @ output
            output -= rate * np.outer(error, hidden)
            bias -= rate * 0.1 * error
            # a feature's share is small; scaled by the square root of their number its step is not
            vectors[ids] -= (rate * np.sqrt(len(ids)) * share)[:, None] * back[None, :]
    return Model(vectors, output, bias)


def log_odds(texts: list[bytes], odds: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the features' odds and their number, per text; any number and length of texts."""
    total, count = np.zeros(len(texts)), np.zeros(len(texts))

    def flush(owner: list[int], parts: list[bytes]) -> None:
        found, _ = hashed(parts, bits)
        bounds, who = _bounds(parts), np.array(owner)
        for at, bucket in found:
            cut = np.searchsorted(at, bounds)
            full = np.flatnonzero(cut[1:] > cut[:-1])
            if len(full):
                np.add.at(total, who[full], np.add.reduceat(odds[bucket], cut[full]))
                np.add.at(count, who[full], (cut[1:] - cut[:-1])[full])

    owner, parts, size = [], [], 0
    for i, t in enumerate(texts):
        for p in chunks(t) if t else []:
            if parts and size + len(p) > CHUNK:
                flush(owner, parts)
                owner, parts, size = [], [], 0
            owner.append(i)
            parts.append(p)
            size += len(p)
    if parts:
        flush(owner, parts)
    return total, count


def held_out(id_col: Column) -> Column:
    """True where crc32 of the id as text is divisible by 5; a null id is not held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality") -> Model:
    """Model from a seeded sample of the labelled documents that are not held out.

    Ids with null or contradicting labels, and ids that ``docs`` lacks, teach
    nothing. With no labelled document the model gives 1/2 throughout.
    """
    known = (labels.select(col(id_col).alias("id"), col(label_col).cast("int").alias("y"))
             .filter(F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("id")))
             .groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("y2")).filter("y = y2"))
    chosen = known.orderBy(F.xxhash64(F.lit(s.seed), F.col("id")), "id").limit(s.max_docs).select("id", "y")
    rows = (docs.select(col(id_col).alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
            .filter(F.octet_length("text") <= s.max_bytes)
            .join(F.broadcast(chosen), "id")  # at most max_docs rows
            .groupBy("id").agg(F.min("y").alias("y"), F.min("text").alias("text")).orderBy("id").collect())
    labels_of = [r["y"] for r in rows]
    return train((rows.pop(0)["text"].encode() for _ in range(len(rows))), labels_of, s)  # texts go as their features come


def score(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """Add ``score`` (probability of class 1) and ``predicted`` (1 at ``threshold`` or more).

    Only the text is read, whole; a null or empty one has no feature and gets the
    model's base rate. Labels, ids and other columns never enter. Repeated rows get
    the same score; no rows give none; input columns called ``score`` or
    ``predicted`` are replaced.
    """
    odds, base = model.odds(), float(model.bias[1] - model.bias[0])
    bits = int(len(odds)).bit_length() - 1
    table = docs.sparkSession.sparkContext.broadcast(odds)  # fixed size: 2 ** bits numbers
    rows = boxed(docs).select("row", F.coalesce(field(text_col), F.lit("")).alias("text"))

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, SLICE_ROWS) for b in batches for i in range(0, b.num_rows, SLICE_ROWS)):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            total, count = log_odds(texts, table.value, bits)
            z = total / np.maximum(count, 1) + base
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(1 / (1 + np.exp(-z)))], ["row", "score"])
        pa.default_memory_pool().release_unused()  # the worker stays, and the next stage shares its executor

    out = rows.mapInArrow(go, row_schema(rows, "score double"))
    return unboxed(out, score=F.col("score"), predicted=(F.col("score") >= threshold).cast("int"))
