"""Embedding near-duplicates with inverted lists and product quantisation.

Vectors are scaled to length one, so cosine c is distance sqrt(2 - 2c). A coarse
codebook deals them into inverted lists; the residual to the list's centre is cut
into subspaces and each part is stored as the number of its nearest codeword. A
query's distances to a list's members are sums of table look-ups (asymmetric: the
query is exact, the members are codes). Candidates are reranked by exact cosine.

Nothing is lost on the way, whatever the codebooks are:

* Probes. With ``probes=None``: let x be in list a and y in list b, both nearest to their own centres, at
  distance at most e. How far x lies on its side of the plane between the two
  centres, plus how far y lies on its own side, is at most e; so one of the two is
  within e / 2 of the plane. Every vector probes each list whose plane is within
  e / 2: every linked pair is met from one side at least. In data without clusters
  the number of such planes grows with the number of lists, so by default a vector
  probes only the ``probes`` nearest of them; a pair is then missed if each side has
  that many nearer planes than the other's. README has the recall measured.
* Look-ups. The stored code carries its error |y - code|; by the triangle
  inequality a member can be linked only if the looked-up distance is at most e
  plus that error.

Hot lists are dealt into blocks of bounded size. A block reports per vector how
many links it found, and only those links that join groups, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import col, cut_lineage
from tessera.llm.components import components
from tessera.llm.simhash import forest

SAMPLE_BYTES = 128 << 20  # of the sample on the driver, at 32 bytes a component
SLACK = 1e-6  # above the rounding of float arithmetic on unit vectors


@dataclass(frozen=True)
class Settings:
    """The codebooks are fitted on at most ``sample`` vectors (fewer where they would take
    more than ``SAMPLE_BYTES``); all vectors are indexed. ``probes`` lists beside the own
    one are probed at most (None: every list that can hold a link).
    ``per_list`` vectors a list on average, up to ``most_lists`` lists; ``parts``
    subspaces of ``words`` codewords; blocks of about ``block`` vectors."""
    sample: int = 16384
    per_list: int = 128
    most_lists: int = 1024
    parts: int = 8
    words: int = 64
    rounds: int = 8
    block: int = 2048
    seed: int = 3
    probes: int | None = 12


@dataclass(frozen=True)
class Codebooks:
    centres: np.ndarray   # (lists, dim)
    words: np.ndarray     # (parts, words, dim / parts), dim padded with zeros
    reach: float          # largest distance of a linked pair

    def padded(self, x: np.ndarray) -> np.ndarray:
        parts, _, width = self.words.shape
        return np.pad(x, ((0, 0), (0, parts * width - x.shape[1]))).reshape(len(x), parts, width)


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), np.int64)
    for i in range(0, len(x), 4096):
        out[i:i + 4096] = (np.einsum("ij,ij->i", centres, centres) - 2 * x[i:i + 4096] @ centres.T).argmin(1)
    return out


def _kmeans(x: np.ndarray, k: int, rounds: int, rng) -> np.ndarray:
    centres = x[rng.choice(len(x), k, replace=len(x) < k)].copy()
    for _ in range(rounds):
        own = _nearest(x, centres)
        n = np.bincount(own, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def fit(sample: np.ndarray, total: int, cosine: float, s: Settings) -> Codebooks:
    rng = np.random.default_rng(s.seed)
    lists = int(np.clip(total // s.per_list, 1, min(s.most_lists, len(sample))))
    centres = _kmeans(sample, lists, s.rounds, rng)
    width = -(-sample.shape[1] // s.parts)
    residual = sample - centres[_nearest(sample, centres)]
    residual = np.pad(residual, ((0, 0), (0, s.parts * width - residual.shape[1]))).reshape(len(sample), s.parts, width)
    words = np.stack([_kmeans(residual[:, p], min(s.words, len(sample)), s.rounds, rng) for p in range(s.parts)])
    return Codebooks(centres, words, float(np.sqrt(max(0.0, 2 - 2 * cosine))) + SLACK)


def encode(x: np.ndarray, c: Codebooks, most: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """(list, codes uint8, code error, probed lists without the own one, at most ``most``) of unit vectors."""
    square = np.einsum("ij,ij->i", c.centres, c.centres)
    gaps = np.sqrt(np.maximum(square[:, None] + square - 2 * c.centres @ c.centres.T, 0))
    distance = square - 2 * x @ c.centres.T  # squared, less |x|^2
    own = distance.argmin(1)
    with np.errstate(divide="ignore", invalid="ignore"):
        depth = (distance - distance[np.arange(len(x)), own][:, None]) / (2 * gaps[own])
    probe = ~(depth > c.reach / 2 + SLACK)  # equal centres: always
    probe[np.arange(len(x)), own] = False
    if most is not None and most < len(c.centres):
        far = np.where(probe, np.nan_to_num(depth, nan=-1.0), np.inf)  # equal centres first
        nearest = np.argsort(far, 1, kind="stable")[:, :most]
        kept = np.zeros_like(probe)
        np.put_along_axis(kept, nearest, True, 1)
        probe &= kept
    residual = c.padded(x - c.centres[own])
    codes = np.stack([_nearest(residual[:, p], c.words[p]) for p in range(len(c.words))], 1)
    back = c.words[np.arange(len(c.words)), codes]
    error = np.sqrt(((residual - back) ** 2).sum((1, 2)))
    return own, codes.astype(np.uint8), error, [np.flatnonzero(r) for r in probe]


def block_links(q: pd.DataFrame, t: pd.DataFrame, home: int, cosine: float, c: Codebooks) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (i of ``q``, j of ``t``) of the pairs with cosine >= ``cosine``, each
    once over all blocks; ``t`` are members of list ``home``, ``q`` probe it."""
    x, y = np.stack(q["v"].to_numpy()), np.stack(t["v"].to_numpy())
    codes = np.frombuffer(b"".join(t["codes"]), np.uint8).reshape(len(t), -1).astype(np.int64)
    limit = (c.reach + t["error"].to_numpy() + SLACK) ** 2
    ux = x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
    rx = c.padded(ux - c.centres[home])
    tables = ((rx[:, :, None, :] - c.words[None]) ** 2).sum(3)  # (queries, parts, words)
    found_i, found_j = [], []
    for a in range(0, len(q), 512):
        near = np.zeros((min(512, len(q) - a), len(t)))
        for p in range(codes.shape[1]):
            near += tables[a:a + 512, p][:, codes[:, p]]
        i, j = np.nonzero(near <= limit)
        i += a
        for k in range(0, len(i), 1 << 16):
            m, n = i[k:k + (1 << 16)], j[k:k + (1 << 16)]
            dot = np.einsum("ij,ij->i", x[m], y[n])
            size = np.sqrt(np.einsum("ij,ij->i", x[m], x[m])) * np.sqrt(np.einsum("ij,ij->i", y[n], y[n]))
            ok = (dot / size >= cosine) & (q["dim"].to_numpy()[m] == t["dim"].to_numpy()[n])
            found_i.append(m[ok])
            found_j.append(n[ok])
    i = np.concatenate(found_i) if found_i else np.zeros(0, np.int64)
    j = np.concatenate(found_j) if found_j else np.zeros(0, np.int64)
    # a pair met from both sides counts where the smaller id asks; inside a list both sides always meet
    qi, tj, ql = q["rep"].to_numpy()[i], t["rep"].to_numpy()[j], q["list"].to_numpy()[i]
    probed = np.zeros((len(t), len(c.centres)), bool)  # of each member
    probes = t["probes"].to_numpy()
    probed[np.repeat(np.arange(len(t)), [len(p) for p in probes]), np.concatenate([*probes, []]).astype(np.int64)] = True
    probed[:, home] = True
    once = (qi != tj) & ((qi < tj) | ~probed[j, ql])
    return i[once], j[once]


def links(docs: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cosine: float = 0.95,
          s: Settings = Settings()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members ``id, rep, valid``, counts ``rep, n``, links ``u, v`` of reps).

    Equal vectors are one class, named by its smallest id (``rep``); ``n`` counts a
    class's links to members of other classes, itself included ``copies - 1`` times.
    """
    vec = F.transform(col(vec_col), lambda x: x.cast("double"))
    rows = docs.select(col(id_col).cast("bigint").alias("id"), vec.alias("v"))
    sound = F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    rows = rows.withColumn("valid", sound & F.coalesce((norm > 0) & (norm < float("inf")), F.lit(False)) & F.col("id").isNotNull())
    valid = rows.filter("valid").select("id", "v")
    classes = cut_lineage(valid.groupBy("v").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")))
    total, dim = classes.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    members = rows.join(classes.select("v", "rep"), "v", "left").select("id", F.when(F.col("valid"), F.col("rep")).alias("rep"), "valid")
    if not total:
        spark = docs.sparkSession
        return members, spark.createDataFrame([], "rep bigint, n bigint"), spark.createDataFrame([], "u bigint, v bigint")

    def matrix(vectors) -> np.ndarray:
        out = np.zeros((len(vectors), dim))
        for i, v in enumerate(vectors):
            out[i, :len(v)] = v
        return out

    def unit(x: np.ndarray) -> np.ndarray:
        return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]

    taken = classes.orderBy(F.xxhash64(F.lit(s.seed), "rep")).limit(min(s.sample, max(1, SAMPLE_BYTES // (32 * max(dim, 1))))).select("v").collect()
    books = docs.sparkSession.sparkContext.broadcast(fit(unit(matrix([r["v"] for r in taken])), total, cosine, s))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("v").to_pylist()
            own, codes, error, probes = encode(unit(matrix(vectors)), books.value, s.probes)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("copies"), pa.array([len(v) for v in vectors], pa.int32()), batch.column("v"), pa.array(own, pa.int32()),
                 pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error), pa.array([p.tolist() for p in probes], pa.list_(pa.int32()))],
                ["rep", "copies", "dim", "v", "list", "codes", "error", "probes"])

    indexed = cut_lineage(classes.select("rep", "copies", "v").mapInArrow(
        index, "rep bigint, copies bigint, dim int, v array<double>, list int, codes binary, error double, probes array<int>"))
    # blocks: bounded by the number of lists, not of vectors
    members_of = {r["list"]: r["n"] for r in indexed.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()}
    asked = indexed.select("rep", F.explode(F.concat(F.array("list"), "probes")).alias("home"))
    askers = {r["home"]: r["n"] for r in asked.groupBy("home").agg(F.count(F.lit(1)).alias("n")).collect()}
    cuts = docs.sparkSession.createDataFrame(
        [(int(k), max(1, -(-n // s.block)), max(1, -(-askers.get(k, 0) // s.block))) for k, n in members_of.items()], "home int, tn int, qn int")
    cuts = F.broadcast(cuts)  # at most most_lists rows
    salt = F.xxhash64(F.lit(s.seed), "rep")
    held = (indexed.join(cuts, F.col("list") == F.col("home")).withColumn("tb", F.pmod(salt, F.col("tn")))
            .select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("qn") - 1)).alias("qb"), F.lit(False).alias("asks")))
    asks = (indexed.withColumn("home", F.explode(F.concat(F.array("list"), "probes"))).join(cuts, "home").withColumn("qb", F.pmod(salt, F.col("qn")))
            .select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tn") - 1)).alias("tb"), F.lit(True).alias("asks")))
    names = ["home", "tb", "qb", "asks", "rep", "copies", "dim", "v", "list", "codes", "error", "probes"]

    def meet(key, pdf: pd.DataFrame) -> pd.DataFrame:
        q, t = pdf[pdf["asks"]].reset_index(drop=True), pdf[~pdf["asks"]].reset_index(drop=True)
        if not len(q) or not len(t):
            return pd.DataFrame({"u": pd.array([], "int64"), "v": pd.array([], "Int64"), "n": pd.array([], "int64")})
        for side in (q, t):
            side["v"] = list(matrix(side["v"]))
        i, j = block_links(q, t, int(key[0]), cosine, books.value)
        a, b = q["rep"].to_numpy()[i], t["rep"].to_numpy()[j]
        ids = np.concatenate([a, b])
        n = np.concatenate([t["copies"].to_numpy()[j], q["copies"].to_numpy()[i]])
        who, at = np.unique(ids, return_inverse=True)
        u, v = forest(a, b)
        return pd.DataFrame({"u": np.concatenate([who, np.array(u, np.int64)]).astype("int64"),
                             "v": pd.array([None] * len(who) + v, "Int64"),
                             "n": np.concatenate([np.bincount(at, n, len(who)), np.zeros(len(u))]).astype("int64")})

    found = cut_lineage(asks.select(names).unionAll(held.select(names)).groupBy("home", "tb", "qb").applyInPandas(meet, "u bigint, v bigint, n bigint"))
    counts = (found.filter("v is null").select(F.col("u").alias("rep"), "n")
              .unionAll(classes.select("rep", (F.col("copies") - 1).alias("n"))).groupBy("rep").agg(F.sum("n").alias("n")))
    return members, counts, found.filter("v is not null").select("u", "v")


def near_duplicates(docs: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cosine: float = 0.95, s: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs``: ``vec_id`` (long), ``n_links`` (other vectors at cosine
    ``cosine`` or more), ``component_id`` (smallest id reachable by links), ``kept``.

    A null, empty or zero vector, or one with null or non-finite components, links
    with nothing and is its own component, as does a row with a null id (component
    null, kept false). Vectors of different length never link. Rows that repeat an id
    and vector count as further copies. No rows give none. Cosine is computed in
    double precision.
    """
    members, counts, edges = links(docs, id_col, vec_col, cosine, s)
    groups = components(edges).withColumnRenamed("node", "rep")
    per_class = cut_lineage(counts.join(groups, "rep", "left").select("rep", "n", F.coalesce("component", "rep").alias("component")))
    out = members.join(per_class, "rep", "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias("vec_id"), F.coalesce("n", F.lit(0).cast("bigint")).alias("n_links"), component.alias("component_id"),
                      F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"))
