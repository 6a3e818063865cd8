"""Benchmark decontamination with a distributed positional inverted index.

A benchmark item gives windows of ``n`` consecutive words (an item of fewer
words, but some, is one window). The training corpus gives postings (term, text,
position). For every window the ``LISTS`` rarest of its terms, by corpus counts
over all documents, are looked up; their posting lists are adjusted by the
term's offset in the window and intersected on (window, text, start); what is
left is verified word by word, so the matches are exact phrases. Proximity
matches (window words within a span, any order) use the same postings.

Postings are kept only for the terms that some window looks up: no query reads
any other list. All of it is DataFrame functions, no Python on the rows.

Texts are keyed by content (two 64-bit hashes), so copies share their work and
ids may be null or repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import BROADCAST_BYTES, boxed, col, cut_lineage, field, lower_ascii, small, unboxed

N = 10
LISTS = 2
# fixed value: a word is a run of ASCII letters and digits and of any other non-ASCII character
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The text's words, case kept; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BETWEEN), "")


def keyed(text: Column) -> list[Column]:
    t = F.coalesce(text, F.lit(""))
    return [F.xxhash64(t).alias("a"), F.xxhash64(F.lit("second"), t).alias("b")]


def windows(items: DataFrame, n: int = N, item_col: str = "item_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(distinct windows ``wid, phrase array<string>``, ``wid, item_id`` pairs); a null item_id stays null."""
    w = items.select(col(item_col).alias("item_id"), F.split(lower_ascii(F.array_join(words(col(text_col)), " ")), " ").alias("w"))
    w = w.filter(F.element_at("w", 1) != "")
    at = F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - (n - 1), F.lit(1)))).alias("at")
    each = w.select("item_id", "w", at).select("item_id", F.slice("w", F.col("at"), n).alias("phrase"))
    win = cut_lineage(each.select("phrase").distinct().withColumn("wid", F.monotonically_increasing_id()))  # numbers are fixed by the write
    return win, cut_lineage(each.distinct().join(win, "phrase").select("wid", "item_id"))


def postings(docs: DataFrame, terms: DataFrame, text_col: str = "text") -> DataFrame:
    """``(a, b, pos, term)`` of every occurrence of ``terms`` (column ``term``) in whole texts."""
    each = docs.select(*keyed(col(text_col)), F.posexplode(words(col(text_col))).alias("pos", "word"))
    return each.select("a", "b", "pos", lower_ascii(F.col("word")).alias("term")).join(terms, "term")


def rarest(win: DataFrame, frequency: DataFrame, lists: int) -> DataFrame:
    """``(wid, which, term, off, need)``: the ``lists`` rarest words of each window. A window
    with a word that the corpus lacks has no match and is left out."""
    each = win.select("wid", F.size("phrase").alias("len"), F.posexplode("phrase").alias("off", "term")).join(frequency, "term")
    order = Window.partitionBy("wid").orderBy("df", "off")
    return (each.withColumn("which", F.row_number().over(order)).withColumn("known", F.count(F.lit(1)).over(Window.partitionBy("wid")))
            .filter((F.col("known") == F.col("len")) & (F.col("which") <= lists))
            .select("wid", "which", "term", "off", F.least(F.col("len"), F.lit(lists)).alias("need")))


def _texts(docs: DataFrame, keys: DataFrame, text_col: str) -> DataFrame:
    """``(a, b, w)``: the words of the texts in ``keys``."""
    return (docs.select(*keyed(col(text_col)), F.coalesce(col(text_col), F.lit("")).alias("text")).join(keys, ["a", "b"], "left_semi")
            .dropDuplicates(["a", "b"])
            .select("a", "b", F.split(lower_ascii(F.array_join(words(F.col("text")), " ")), " ").alias("w")))


def phrase_matches(docs: DataFrame, win: DataFrame, text_col: str = "text", lists: int = LISTS) -> DataFrame:
    """Exact matches ``(a, b, wid, start, len)``; ``start`` is a word position from 0."""
    terms = win.select(F.explode("phrase").alias("term")).distinct()
    terms = small(cut_lineage(terms), 64)
    frequency = cut_lineage(postings(docs, terms, text_col).groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    anchors = cut_lineage(rarest(win, frequency, lists))
    index = postings(docs, small(cut_lineage(anchors.select("term").distinct()), 64), text_col)
    # each list adds its bit to the windows it meets at (text, start); all bits: the lists intersect there
    bit = F.expr("shiftleft(1, which - 1)")
    shifted = (index.join(small(anchors, 96), "term").filter("pos >= off")
               .select("a", "b", "wid", (F.col("pos") - F.col("off")).alias("start"), bit.alias("bit"), "need"))
    met = (shifted.groupBy("a", "b", "wid", "start").agg(F.bit_or("bit").alias("bits"), F.max("need").alias("need"))
           .filter("bits = shiftleft(1, need) - 1"))
    met = cut_lineage(met.select("a", "b", "wid", "start"))
    # verification: the candidate texts' own words against the whole phrase
    keys = small(cut_lineage(met.select("a", "b").distinct()), 16)
    texts = _texts(docs, keys, text_col)
    wanted = (met.join(small(win, 256), "wid").groupBy("a", "b")
              .agg(F.collect_list(F.struct("wid", "start", "phrase")).alias("c")))  # of one text: bounded by its length
    true = F.filter("c", lambda c: F.slice(F.col("w"), c["start"] + 1, F.size(c["phrase"])) == c["phrase"])
    return (wanted.join(texts, ["a", "b"]).select("a", "b", F.explode(true).alias("m"))
            .select("a", "b", "m.wid", "m.start", F.size("m.phrase").alias("len")))


def proximity_matches(docs: DataFrame, win: DataFrame, span: int, text_col: str = "text", lists: int = LISTS) -> DataFrame:
    """``(a, b, wid, start)``: stretches of ``span`` words from ``start`` on that begin with a word of the window and
    hold all its distinct words, in any order. The ``lists`` rarest words give the candidates, the texts' own words
    decide. A looser report than the phrase match, for callers; ``mark`` and ``clean`` do not use it."""
    terms = win.select(F.explode("phrase").alias("term")).distinct()
    frequency = postings(docs, terms, text_col).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    anchors = cut_lineage(rarest(win, frequency, lists))
    hits = postings(docs, anchors.select("term").distinct(), text_col).join(anchors, "term")
    # one row per slice of `span` words and its neighbour, so that near hits meet on a key
    cells = hits.select("a", "b", "wid", "which", "need", "pos", F.explode(F.array(F.floor(F.col("pos") / span), F.floor(F.col("pos") / span) + 1)).alias("cell"))
    near = Window.partitionBy("a", "b", "wid", "cell").orderBy("pos").rangeBetween(0, span - 1)
    met = cut_lineage(cells.withColumn("met", F.size(F.collect_set("which").over(near))).filter(F.col("met") == F.col("need"))
                      .select("a", "b", "wid", "pos").distinct())
    # a stretch that holds the rarest words may begin up to span - 1 words before the first of them
    starts = met.select("a", "b", "wid", F.explode(F.sequence(F.greatest(F.col("pos") - (span - 1), F.lit(0)), F.col("pos"))).alias("start")).distinct()
    wanted = starts.join(small(win, 256), "wid").groupBy("a", "b").agg(F.collect_list(F.struct("wid", "start", "phrase")).alias("c"))
    texts = _texts(docs, small(cut_lineage(met.select("a", "b").distinct()), 16), text_col)
    true = F.filter("c", lambda c: F.array_contains(c["phrase"], F.element_at("w", c["start"] + 1))
                    & (F.size(F.array_except(c["phrase"], F.slice(F.col("w"), c["start"] + 1, span))) == 0))
    return wanted.join(texts, ["a", "b"]).select("a", "b", F.explode(true).alias("m")).select("a", "b", "m.wid", "m.start")


def contaminated_texts(docs: DataFrame, items: DataFrame, n: int = N, text_col: str = "text", item_col: str = "item_id",
                       item_text_col: str = "text") -> DataFrame:
    """One row per distinct contaminated text: ``(a, b, n_hit, items)``, ``items`` sorted as strings."""
    win, pairs = windows(items, n, item_col, item_text_col)
    hits = cut_lineage(phrase_matches(docs, win, text_col))
    order = Window.partitionBy("a", "b").orderBy("start", "end")
    span = hits.select("a", "b", "start", (F.col("start") + F.col("len")).alias("end")).distinct()
    reach = F.coalesce(F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    covered = (span.withColumn("new", F.greatest(F.col("end") - F.greatest(F.col("start"), reach), F.lit(0)))
               .groupBy("a", "b").agg(F.sum("new").cast("bigint").alias("n_hit")))
    named = (hits.select("a", "b", "wid").distinct().join(small(pairs, 96), "wid").select("a", "b", F.col("item_id").cast("string").alias("item"))
             .distinct().groupBy("a", "b").agg(F.array_sort(F.collect_set("item")).alias("items")))
    return covered.join(named, ["a", "b"], "left").select("a", "b", "n_hit", F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def mark(docs: DataFrame, items: DataFrame, n: int = N, text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text") -> DataFrame:
    """Add ``n_words``, ``n_hit``, ``items`` and ``contaminated`` to the documents.

    Nulls: a null text has no words, an item with a null text no windows, an item
    with a null id hits but is not named. Repeated rows and copies get the same
    values. Empty tables: no documents give no rows, no items leave all documents
    clean. Input columns with the names of the added ones are replaced.
    """
    found = cut_lineage(contaminated_texts(docs, items, n, text_col, item_col, item_text_col))
    size = found.agg(F.coalesce(F.sum(F.size("items") * 40 + 64), F.lit(0))).first()[0]
    found = F.broadcast(found) if size <= BROADCAST_BYTES else found
    rows = boxed(docs)
    rows = rows.select("row", *keyed(field(text_col)), F.size(words(field(text_col))).cast("bigint").alias("n_words"))
    rows = rows.join(found, ["a", "b"], "left")
    hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return unboxed(rows, n_words=F.col("n_words"), n_hit=hit, items=F.coalesce("items", F.array().cast("array<string>")), contaminated=hit > 0)


def clean(docs: DataFrame, items: DataFrame, n: int = N, text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text") -> DataFrame:
    """The documents with no benchmark window in their text, unchanged."""
    found = small(cut_lineage(contaminated_texts(docs, items, n, text_col, item_col, item_text_col).select("a", "b")), 16)
    rows = boxed(docs)
    return unboxed(rows.select("row", *keyed(field(text_col))).join(found, ["a", "b"], "left_anti"))
