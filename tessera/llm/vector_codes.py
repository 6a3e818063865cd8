"""Compressing vectors to codebook indexes, nearest entries found by Orchard's search.

Every vector is scaled to integers and cut into equal consecutive parts; each part
position has a codebook, trained by a few rounds of k-means in whole numbers, and a
vector is stored as one index per part.

The nearest entry of a part is found without comparing it with all entries: for
every entry the codebook keeps a list of all entries by distance from it. A search
stands at its best entry so far and walks that entry's list. An entry nearer to the
query is jumped to and its list is walked from the start; entries already compared
are marked and passed over. By the triangle inequality no entry farther from the
current one than twice the query's distance can be nearer, so the walk stops there.

A round is one pass over the rows: tasks assign their vectors and sum them per
(part, entry, position), so a pass shuffles at most parts x entries x width numbers a
partition and the driver holds nothing but codebooks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import boxed, col, field, row_hash, row_schema, unboxed

MOST = 1 << 60  # bound of squared distances: four times it fits into 64 bits


@dataclass(frozen=True)
class Settings:
    """``parts`` codebooks of at most ``words`` entries; components are floor(``scale`` * x)."""
    parts: int = 16
    words: int = 64
    rounds: int = 2
    scale: int = 256


class Codebook:
    """The entries (integers, k x width) of one part with their neighbour lists."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        gaps = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(2)
        self.lists = np.argsort(gaps, 1, kind="stable")
        self.gaps = np.take_along_axis(gaps, self.lists, 1)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry (ties: the lowest index) and its squared distance for
        each row of ``x``. All rows walk at once, each on its own list."""
        n, k = len(x), len(self.entries)
        at, place = np.zeros(n, np.int64), np.zeros(n, np.int64)
        best = ((x - self.entries[at]) ** 2).sum(1)
        seen = np.zeros((n, k), bool)
        seen[:, 0] = True
        live = np.arange(n)
        while True:
            live = live[place[live] < k]
            # an entry exactly twice as far can still tie, so only farther ones end the walk
            live = live[self.gaps[at[live], place[live]] <= 4 * best[live]]
            if not len(live):
                return at, best
            entry = self.lists[at[live], place[live]]
            place[live] += 1
            fresh = ~seen[live, entry]
            who, entry = live[fresh], entry[fresh]
            seen[who, entry] = True
            d = ((x[who] - self.entries[entry]) ** 2).sum(1)
            better = (d < best[who]) | ((d == best[who]) & (entry < at[who]))
            who = who[better]
            at[who], best[who], place[who] = entry[better], d[better], 0


def codebooks_sha256(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components in decimal, by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.ravel()).encode()).hexdigest()


def sound(vec: Column) -> Column:
    """Neither null nor with a null or non-finite component."""
    return F.coalesce(F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def _vector(column: Column) -> Column:
    return F.transform(column, lambda x: x.cast("double"))


def _integers(vectors: pa.Array, width: int, s: Settings) -> np.ndarray:
    """(rows, parts, width) whole numbers of an Arrow list array, short vectors padded with zeros."""
    size = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(vectors), s.parts * width), np.int64)
    flat = np.floor(s.scale * vectors.flatten().to_numpy(zero_copy_only=False)).astype(np.int64)
    out[np.arange(out.shape[1])[None, :] < size[:, None]] = flat
    return out.reshape(len(vectors), s.parts, width)


def fit(docs: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", s: Settings = Settings()) -> list[np.ndarray]:
    """One codebook (integers, entries x width) per part, fitted on all sound vectors.

    A codebook starts as that part of the ``words`` sound vectors with the smallest ids
    (null ids last, equal ids by their components); fewer vectors give fewer entries,
    none gives empty codebooks. Each round assigns every part to its nearest entry
    (squared Euclidean distance, ties to the lowest index), then replaces each entry by
    the floor of its parts' mean, component by component; an entry without parts stays.
    Vectors that are null or hold a null or non-finite component are left out. The
    longest vector, rounded up to a multiple of ``parts``, gives the width; shorter ones
    are read as if padded with zeros. Components so large that squared distances leave
    64 bits raise ValueError. ``docs`` is read once a round and twice before.
    """
    rows = docs.select(col(id_col).alias("id"), _vector(col(vec_col)).alias("v")).filter(sound(F.col("v")))
    longest, largest = rows.agg(F.max(F.size("v")), F.max(F.array_max(F.transform("v", F.abs)))).first()
    width = -(-(longest or 0) // s.parts)
    if (2 * (s.scale * (largest or 0.0) + 1)) ** 2 * s.parts * max(width, 1) >= MOST:
        raise ValueError("components are too large for squared distances in 64 bits")
    first = rows.orderBy(F.asc_nulls_last("id"), "v").limit(s.words).select("v").collect()  # at most s.words rows
    start = _integers(pa.array([r["v"] for r in first], pa.list_(pa.float64())), width, s)
    books = [start[:, p].copy() for p in range(s.parts)]
    for _ in range(s.rounds if len(first) and width else 0):
        sent = docs.sparkSession.sparkContext.broadcast(books)  # parts x words entries, whatever the rows

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            searched = [Codebook(b) for b in sent.value]
            n = np.zeros((s.parts, len(searched[0].entries)), np.int64)
            total = np.zeros((*n.shape, width), np.int64)
            for batch in batches:
                x = _integers(batch.column("v"), width, s)
                for p, book in enumerate(searched):
                    own, _ = book.nearest(x[:, p])
                    n[p] += np.bincount(own, minlength=n.shape[1])
                    np.add.at(total[p], own, x[:, p])
            part, entry = np.nonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(part, width), pa.int32()), pa.array(np.repeat(entry, width), pa.int32()),
                 pa.array(np.tile(np.arange(width), len(part)), pa.int32()), pa.array(np.repeat(n[part, entry], width)),
                 pa.array(total[part, entry].ravel())], ["part", "entry", "place", "n", "total"])

        sums = rows.select("v").mapInArrow(assign, "part int, entry int, place int, n bigint, total bigint")
        wide = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
        books = [b.copy() for b in books]
        for r in sums.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), wide).collect():  # parts x words x width rows at most
            books[r["part"]][r["entry"], r["place"]] = int(r["total"]) // r["n"]
        sent.unpersist()
    return books


def encode(docs: DataFrame, books: list[np.ndarray], vec_col: str = "embedding", s: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` with a sound vector, with ``code`` (binary, one byte a part; two
    for more than 256 entries) and ``error`` (squared distances summed over the parts).

    Rows are independent: repeated ones get the same code; other columns are carried,
    input columns called ``code`` or ``error`` are replaced. Empty codebooks or tables
    give no rows.
    """
    rows = boxed(docs).withColumn("v", _vector(field(vec_col))).filter(sound(F.col("v")))
    if not len(books[0]):
        rows = rows.filter("false")
    width, kind = books[0].shape[1], np.uint8 if len(books[0]) <= 256 else np.dtype(">u2")
    sent = docs.sparkSession.sparkContext.broadcast(books)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searched = [Codebook(b) for b in sent.value]
        for batch in batches:
            x = _integers(batch.column("v"), width, s)
            code, error = np.zeros((len(x), s.parts), kind), np.zeros(len(x), np.int64)
            for p, book in enumerate(searched):
                own, d = book.nearest(x[:, p])
                code[:, p] = own
                error += d
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(error)],
                                             ["row", "code", "error"])

    out = rows.mapInArrow(go, row_schema(rows, "code binary, error bigint"))
    return unboxed(out, code=F.col("code"), error=F.col("error"))


def decode(code: bytes, books: list[np.ndarray], s: Settings = Settings()) -> np.ndarray:
    """The vector that a code stands for: its entries' components over ``scale``."""
    index = np.frombuffer(code, np.uint8 if len(books[0]) <= 256 else np.dtype(">u2"))
    return np.concatenate([b[i] for b, i in zip(books, index)]) / s.scale


def summed_by(docs: DataFrame, value: str, by: str, name: str) -> DataFrame:
    """``docs`` with ``name``, the sum of ``value`` over the rows of equal ``by`` (nulls together).

    The sums are partial aggregates; the join back keys on ``by`` and one of ``SLICES``
    slices that rows are dealt to, so a value that holds most rows is in no single task.
    """
    rows = boxed(docs).select("row", field(by).alias("k"), field(value).alias("x"))
    rows = rows.withColumn("slice", F.pmod(row_hash(rows, 7), F.lit(SLICES)))
    sums = rows.groupBy("k").agg(F.sum("x").alias("total")).withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1)).cast("array<bigint>")))
    joined = rows.alias("r").join(sums.alias("t"), F.col("r.k").eqNullSafe(F.col("t.k")) & (F.col("r.slice") == F.col("t.slice")))
    return unboxed(joined.select("r.row", "t.total"), **{name: F.col("total")})


SLICES = 64


def compress(docs: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", s: Settings = Settings()) -> tuple[DataFrame, list[np.ndarray]]:
    """Codebooks fitted on ``docs`` and its rows encoded with them."""
    books = fit(docs, id_col, vec_col, s)
    return encode(docs, books, vec_col, s), books
