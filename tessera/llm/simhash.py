"""SimHash near-duplicates through a self-join of the binary trie of fingerprints.

Distinct fingerprints form a binary trie. Pairs of trie nodes are walked down
together, the differing bits of their prefixes are added up, and a pair is dropped
as soon as they exceed the error budget. The walk starts in Spark: a frontier of
node pairs is expanded by some bits at a time, each fingerprint going with the
pairs its node is in, and node pairs that still hold many fingerprints (a large
group of near copies) are expanded further. Pairs that are small enough end in one
task each, where the walk goes on over sorted arrays.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import boxed, col, cut_lineage, field, unboxed
from tessera.llm.components import components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
LEAF = 2048       # fingerprints a node of the first frontier holds on average
MOST = 8 * LEAF   # a node pair with more rows is expanded further
STEP = 4          # bits of a further expansion


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit i is set if it is set in more than half of the shingles' hashes."""
    import xxhash
    words = (text or "").encode().lower().split()  # bytes: ASCII white space and A-Z only
    if not words:
        return 0
    grams = [b" ".join(words)] if len(words) < shingle else map(b" ".join, zip(*[words[i:] for i in range(shingle)]))
    n = max(1, len(words) - shingle + 1)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        ones += np.unpackbits(hashes[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, a, b, fp)``: ``fp`` the 64-bit fingerprint as a signed long,
    ``a``/``b`` a content key of the text. Null text: fingerprint zero."""
    text = F.coalesce(col(text_col), F.lit(""))
    src = docs.select(col(id_col).alias("doc_id"), F.xxhash64(text).alias("a"), F.xxhash64(F.lit("second"), text).alias("b"), text.alias("text"))

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in batch.column("text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("a"), batch.column("b"), pa.array(fp)], ["doc_id", "a", "b", "fp"])

    return src.mapInArrow(go, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, a bigint, b bigint, fp bigint")


def trie_pairs(a: np.ndarray, b: np.ndarray | None, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of sorted distinct uint64 arrays that differ in at most ``budget`` bits
    (``b`` None: pairs i < j within ``a``), by a level-wise walk of node pairs."""
    same = b is None
    b = a if same else b
    one = np.uint64(1)
    A = np.array([[0, len(a)]], np.int64)
    B = np.array([[0, len(b)]], np.int64)
    diff = np.zeros(1, np.int64)
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def finish(A, B):
        sizes = (A[:, 1] - A[:, 0]) * (B[:, 1] - B[:, 0])
        k = np.repeat(np.arange(len(A)), sizes)
        j = np.arange(len(k)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        width = (B[:, 1] - B[:, 0])[k]
        x, y = A[k, 0] + j // width, B[k, 0] + j % width
        near = np.bitwise_count(a[x] ^ b[y]) <= budget
        if same:
            near &= x < y
        found.append((x[near], y[near]))

    for bit in range(63, -1, -1):
        little = (A[:, 1] - A[:, 0]) * (B[:, 1] - B[:, 0]) <= 32
        if little.any():
            finish(A[little], B[little])
            A, B, diff = A[~little], B[~little], diff[~little]
        if not len(A):
            break
        bitmask, keep = one << np.uint64(bit), ~((one << np.uint64(bit)) - one)

        def halves(arr, R):
            mid = np.searchsorted(arr, (arr[R[:, 0]] & keep) | bitmask)
            mid = np.clip(mid, R[:, 0], R[:, 1])
            return np.stack([R[:, 0], mid], 1), np.stack([mid, R[:, 1]], 1)

        (a0, a1), (b0, b1) = halves(a, A), halves(b, B)
        own = same & (A[:, 0] == B[:, 0]) & (A[:, 1] == B[:, 1])  # a node with itself: one cross pair is enough
        A = np.concatenate([a0, a1, a0, a1[~own]])
        B = np.concatenate([b0, b1, b1, b0[~own]])
        diff = np.concatenate([diff, diff, diff + 1, diff[~own] + 1])
        live = (A[:, 1] > A[:, 0]) & (B[:, 1] > B[:, 0]) & (diff <= budget)
        A, B, diff = A[live], B[live], diff[live]
    if len(A):
        finish(A, B)
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def forest(x: np.ndarray, y: np.ndarray) -> tuple[list, list]:
    """Of the links (x, y), those that join two so far separate groups: same components, at most one link a node."""
    parent: dict = {}

    def root(i):
        while (p := parent.get(i, i)) != i:
            parent[i] = i = parent.get(p, p)
        return i

    u, v = [], []
    for i, j in zip(x.tolist(), y.tolist()):
        p, q = root(i), root(j)
        if p != q:
            parent[max(p, q)] = min(p, q)
            u.append(i)
            v.append(j)
    return u, v


def links(fps: DataFrame, max_bits: int = MAX_BITS, leaf: int = LEAF, most: int = MOST, step: int = STEP) -> DataFrame:
    """Links ``(u, v)`` between the distinct values ``fp`` that differ in at most
    ``max_bits`` bits: every connected group is joined up, without all of its pairs."""
    n = fps.count()
    depth = min(64, max(0, math.ceil(math.log2(max(n, 1) / leaf)))) if n > leaf else 0

    def prefix(d: int):
        return F.shiftrightunsigned("fp", 64 - d) if d else F.lit(0).cast("bigint")

    def masks(d: int):
        return F.array(*[F.lit(sum(1 << i for i in c)).cast("bigint") for k in range(max_bits + 1) for c in combinations(range(d), k)])

    own, other = prefix(depth), F.explode(masks(depth)).alias("mask")
    frontier = fps.select("fp", other).select("fp", F.least(own, own.bitwiseXOR(F.col("mask"))).alias("lo"),
                                              F.greatest(own, own.bitwiseXOR(F.col("mask"))).alias("hi"), F.lit(depth).alias("depth"))
    frontier = cut_lineage(frontier)
    out = None
    while True:
        sizes = frontier.groupBy("lo", "hi").agg(F.count(F.lit(1)).alias("n"))
        large = cut_lineage(sizes.filter(F.col("n") > most).select("lo", "hi")) if depth < 64 else None
        more = large is not None and not large.isEmpty()
        rest = frontier.join(large, ["lo", "hi"], "left_anti") if more else frontier
        part = rest.groupBy("lo", "hi", "depth").applyInPandas(_walk(max_bits), "u bigint, v bigint")
        out = part if out is None else out.unionAll(part)
        if not more:
            return out
        new = min(step, 64 - depth)
        held = frontier.join(large, ["lo", "hi"], "left_semi")
        mine, child = prefix(depth), prefix(depth + new)
        partner = F.when(mine == F.col("lo"), F.col("hi")).otherwise(F.col("lo"))
        tails = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit((1 << new) - 1).cast("bigint"))).alias("tail")
        grown = held.select("fp", child.alias("child"), partner.alias("partner"), tails)
        theirs = F.shiftleft("partner", new).bitwiseOR(F.col("tail"))
        grown = grown.select("fp", "child", theirs.alias("theirs")).filter(F.bit_count(F.col("child").bitwiseXOR(F.col("theirs"))) <= max_bits)
        nodes = grown.select(F.col("child").alias("theirs")).distinct()  # a pair with an empty side has no links
        depth += new
        frontier = cut_lineage(grown.join(nodes, "theirs", "left_semi").select(
            "fp", F.least("child", "theirs").alias("lo"), F.greatest("child", "theirs").alias("hi"), F.lit(depth).alias("depth")))


def _walk(max_bits: int):
    def walk(key, pdf: pd.DataFrame) -> pd.DataFrame:
        lo, hi, depth = (int(k) for k in key)
        fp = np.sort(pdf["fp"].to_numpy().view(np.uint64))
        if lo == hi:
            x, y = trie_pairs(fp, None, max_bits)
            u, v = fp[x], fp[y]
        else:
            left = (fp >> np.uint64(64 - depth)) == np.uint64(lo % (1 << 64))
            a, b = fp[left], fp[~left]
            x, y = trie_pairs(a, b, max_bits) if len(a) and len(b) else (np.zeros(0, int), np.zeros(0, int))
            u, v = a[x], b[y]
        u, v = forest(u.view(np.int64), v.view(np.int64))
        return pd.DataFrame({"u": pd.array(u, "int64"), "v": pd.array(v, "int64")})
    return walk


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``(doc_id, a, b, fp, component_id)`` for every row of ``docs``.

    Rows with one fingerprint are one class; classes link at ``max_bits`` or fewer
    differing bits and ``component_id`` is the smallest id in the linked group
    (null only if all ids there are null). Null and wordless texts have fingerprint
    zero, linked like any other. Repeated rows give repeated results; no rows give
    none. Other columns are not read.
    """
    fp = cut_lineage(fingerprints(docs, id_col, text_col, shingle))
    classes = cut_lineage(fp.groupBy("fp").agg(F.min("doc_id").alias("least")))
    groups = components(links(classes.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    named = classes.join(groups, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    named = cut_lineage(named)
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return fp.join(named.join(ids, "component").select("fp", "component", "component_id"), "fp")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents with one row of each linked group: that with the smallest id
    (then by content hash). Rows without an id stay only where no row of the group has one."""
    near = near_duplicates(docs, id_col, text_col, shingle, max_bits)
    first = near.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "a", "b")).alias("k"))
    first = first.select(F.xxhash64(F.lit("id"), F.col("k.doc_id")).alias("h"), "k.a", "k.b")
    text = F.coalesce(field(text_col), F.lit(""))
    rows = boxed(docs).select("row", F.xxhash64(F.lit("id"), field(id_col)).alias("h"), F.xxhash64(text).alias("a"),
                              F.xxhash64(F.lit("second"), text).alias("b"))
    return unboxed(rows.join(first, ["h", "a", "b"], "left_semi").dropDuplicates(["h", "a", "b"]))
