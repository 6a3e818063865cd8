"""Line de-duplication by distinct-site spread.

A line is boilerplate if it stands in documents of at least ``min_sites``
different sites; with ``few_sites`` a line of at least ``FEW_WORDS`` words needs
only that many. Per line hash a HyperLogLog sketch of the sites is built where
the lines are and merged by the aggregation, so a line of any frequency moves one
sketch a task. Lines whose estimate is near the threshold (within the sketch's
error, widely taken) get an exact count of distinct sites; the rest are decided by
the estimate. Boilerplate lines are then removed from every document.

DataFrame functions only. Lines are compared without surrounding blanks, tabs and
carriage returns, under two independent 64-bit hashes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import BROADCAST_BYTES, boxed, col, cut_lineage, field, small, unboxed

MIN_SITES = 10
FEW_SITES = 5  # for lines of FEW_WORDS words and more: above the two to four sites that copied documents reach
FEW_WORDS = 3
LG_K = 12
ERRORS = 5  # half width of the near-threshold band in standard errors, plus two sites


def _hashes(line: Column) -> tuple[Column, Column]:
    bare = F.btrim(line, F.lit(" \t\r"))
    return F.xxhash64(bare), F.xxhash64(F.lit("second"), bare)


def _bounds(sites: int, lg_k: int) -> tuple[int, int]:
    """Estimates below the first are under ``sites``, above the second over it; between them only a count decides."""
    band = ERRORS * 1.04 / math.sqrt(1 << lg_k)
    return math.floor(sites * (1 - band)) - 2, math.ceil(sites * (1 + band)) + 2


def _lines(docs: DataFrame, text_col: str, *keep: Column, worded: bool = False) -> DataFrame:
    each = docs.select(*keep, F.explode(F.split(col(text_col), "\n")).alias("line"))
    each = each.filter(F.btrim("line", F.lit(" \t\r")) != "")
    if worded:
        each = each.withColumn("long", F.btrim("line", F.lit(" \t\r")).rlike(rf"^(?:\S+\s+){{{FEW_WORDS - 1}}}\S"))
    h, g = _hashes(F.col("line"))
    return each.select(*[c for c in each.columns if c != "line"], h.alias("h"), g.alias("g"))


def boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, site_col: str = "source", text_col: str = "text",
                lg_k: int = LG_K, few_sites: int | None = None) -> DataFrame:
    """Hashes ``(h, g)`` of the lines seen on at least ``min_sites`` sites (a null site is none),
    or on ``few_sites`` if they have ``FEW_WORDS`` words or more."""
    worded = few_sites is not None
    lines = _lines(docs, text_col, col(site_col).cast("string").alias("site"), worded=worded).filter(F.col("site").isNotNull())
    keys = ["h", "g", "long"] if worded else ["h", "g"]
    spread = lines.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(lg_k))).alias("sites"))

    def by_length(few, many):
        return F.when(F.col("long"), few).otherwise(many) if worded else F.lit(many)

    (low, high), (few_low, few_high) = _bounds(min_sites, lg_k), _bounds(few_sites if worded else min_sites, lg_k)
    spread = cut_lineage(spread.filter(F.col("sites") >= by_length(few_low, low)))
    near = small(cut_lineage(spread.filter(F.col("sites") <= by_length(few_high, high)).select("h", "g")), 16)
    exact = (lines.join(near, ["h", "g"], "left_semi").distinct()
             .groupBy(*keys).agg(F.count(F.lit(1)).alias("sites")).filter(F.col("sites") >= by_length(few_sites, min_sites)))
    return spread.filter(F.col("sites") > by_length(few_high, high)).select("h", "g").unionAll(exact.select("h", "g"))


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, site_col: str = "source", text_col: str = "text",
                       lg_k: int = LG_K, few_sites: int | None = None) -> DataFrame:
    """The documents with every boilerplate line taken out of ``text_col``; adds
    ``n_lines`` (of the input text) and ``n_removed``.

    No document goes: one made of boilerplate alone keeps an empty text. Blank
    lines are never boilerplate and stay. A null text stays null with no lines; a
    row with a null site loses boilerplate lines but does not make any. Ids are not
    read, so they may be null or repeated. No rows give no rows; input columns
    called ``n_lines`` or ``n_removed`` are replaced.
    """
    common = small(cut_lineage(boilerplate(docs, min_sites, site_col, text_col, lg_k, few_sites)), 16)
    text = F.coalesce(col(text_col), F.lit(""))
    keys = [F.xxhash64(text).alias("a"), F.xxhash64(F.lit("second"), text).alias("b")]
    hits = (_lines(docs, text_col, *keys).join(common, ["h", "g"], "left_semi").groupBy("a", "b")
            .agg(F.collect_set(F.struct("h", "g")).alias("hits")))  # distinct lines of one text
    hits = cut_lineage(hits)
    hits = F.broadcast(hits) if hits.agg(F.coalesce(F.sum(F.size("hits") * 48 + 64), F.lit(0))).first()[0] <= BROADCAST_BYTES else hits

    own = F.coalesce(field(text_col), F.lit(""))
    rows = boxed(docs).select("row", F.xxhash64(own).alias("a"), F.xxhash64(F.lit("second"), own).alias("b")).join(hits, ["a", "b"], "left")
    lines = F.split(field(text_col), "\n")

    def stays(line: Column) -> Column:
        h, g = _hashes(line)
        return (F.btrim(line, F.lit(" \t\r")) == "") | ~F.array_contains(F.col("hits"), F.struct(h.alias("h"), g.alias("g")))

    kept = F.when(F.col("hits").isNull(), lines).otherwise(F.filter(lines, stays))
    rows = rows.select("row", F.coalesce(F.size(lines), F.lit(0)).alias("n"), kept.alias("kept"))
    rows = rows.withColumn("n", F.when(field(text_col).isNull(), 0).otherwise(F.col("n")))
    removed = F.when(F.col("kept").isNull(), 0).otherwise(F.col("n") - F.size("kept"))
    names = docs.columns
    out = unboxed(rows, **{text_col: F.array_join("kept", "\n"), "n_lines": F.col("n").cast("bigint"), "n_removed": removed.cast("bigint")})
    return out.select(*[col(c) for c in names if c.lower() not in ("n_lines", "n_removed")], "n_lines", "n_removed")
