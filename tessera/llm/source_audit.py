"""Divergence of sources by their terms, with texts factored into white-space chunks.

Most of a corpus repeats the same chunks (words with their punctuation), so texts are
never tokenised themselves:

1. Every task counts the chunks of each of its documents and sums them per (language,
   source, chunk): occurrences, and documents. Where fewer documents than the threshold
   hold a chunk, their keys go along.
2. Chunks meet by hash, sorted, and each distinct chunk is cut into its terms once; the
   terms are joined to all count rows of the chunk.
3. Terms meet by (language, term): occurrences are summed per source, documents counted.
   A chunk in enough documents proves its terms frequent. Otherwise the keys of all its
   chunks' documents are counted distinct, so ``word`` and ``word,`` in one document are
   one document. There are never more keys than the threshold a chunk, task and term.

All later work is on the counts of the kept terms. Sums over all kept terms are split
into terms that both sources have, that one has, and that neither has, so only
occurring (source, term) rows are ever made.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import col, cut_lineage, small, written

MIN_DOCS = 10
TOP = 10
SCALE = 1_000_000_000

_TERM = re.compile(rb"[a-z\x80-\xff]+")  # in lower-cased UTF-8: ASCII letters and all beyond ASCII
CHUNKS, POSTINGS = 500_000, 4_000_000    # most that a task holds before it passes its sums on
ROWS = 100_000                           # rows worked on at a time

_COUNTED = "chunk string, place string, n bigint, keys array<bigint>"
_TERMS = "lang string, term string, source string, n bigint, key bigint"


def _place(lang: str, source: str) -> str:
    """Language and source in one text; those of a language are neighbours in text order."""
    return f"{len(lang)}:{lang}{source}"


def _parts(place: str) -> tuple[str, str]:
    size, rest = place.split(":", 1)
    return rest[:int(size)], rest[int(size):]


def _expand(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of each run, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


def _lists(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, shown: np.ndarray) -> pa.Array:
    """A list array of the runs of ``values``; null where not ``shown``."""
    sizes = np.where(shown, sizes, 0)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    flat = pa.array(values[_expand(starts, sizes)], pa.int64())
    return pa.ListArray.from_arrays(pa.array(offsets), flat, mask=pa.array(~shown))


class _Chunks:
    """Chunk counts of the documents seen since the last ``flush``."""

    def __init__(self, min_docs: int):
        self.min_docs, self.number, self.groups = min_docs, {}, {}
        self.ids, self.ns, self.sizes, self.group, self.keys = [], [], [], [], []
        self.held = 0

    def add(self, lang: str, source: str, text: bytes, key: int) -> None:
        found, number = Counter(text.split()), self.number  # bytes.split: the six ASCII blanks
        self.ids.append(np.array([number.setdefault(c, len(number)) for c in found], np.int64))
        self.ns.append(np.array(list(found.values()), np.int64))
        self.sizes.append(len(found))
        self.group.append(self.groups.setdefault(_place(lang, source), len(self.groups)))
        self.keys.append(key)
        self.held += len(found)

    def full(self) -> bool:
        return len(self.number) >= CHUNKS or self.held >= POSTINGS

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            ids, ns = np.concatenate(self.ids), np.concatenate(self.ns)
            group, keys = np.repeat(self.group, self.sizes), np.repeat(self.keys, self.sizes)
            at = ids * len(self.groups) + group
            order = np.argsort(at, kind="stable")  # rows of a chunk stay together, which packs well
            at, ns, keys = at[order], ns[order], keys[order]
            starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            sizes = np.diff(np.concatenate([starts, [len(at)]]))
            n = np.add.reduceat(ns, starts)
            chunks, places = pa.array(list(self.number), pa.binary()).cast(pa.string()), pa.array(list(self.groups), pa.string())
            chunk, group = at[starts] // len(self.groups), at[starts] % len(self.groups)
            for a in range(0, len(starts), ROWS):
                b = slice(a, a + ROWS)
                yield pa.RecordBatch.from_arrays(
                    [chunks.take(pa.array(chunk[b])), places.take(pa.array(group[b])), pa.array(n[b]),
                     _lists(keys, starts[b], sizes[b], sizes[b] < self.min_docs)], ["chunk", "place", "n", "keys"])
        self.__init__(self.min_docs)


def chunk_counts(docs: DataFrame, lang_col: str, source_col: str, text_col: str, min_docs: int) -> DataFrame:
    """``chunk, place, n, keys``: a task's sums, not yet one row a chunk. ``keys`` are the
    documents' keys, or null for ``min_docs`` documents and more."""
    text = lambda c: F.coalesce(col(c).cast("string"), F.lit(""))
    rows = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text"),
                       F.monotonically_increasing_id().alias("key"))

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Chunks(min_docs)
        for batch in batches:
            langs, sources, keys = (batch.column(c).to_pylist() for c in ("lang", "source", "key"))
            for lang, source, text, key in zip(langs, sources, batch.column("text").cast(pa.binary()), keys):
                held.add(lang, source, text.as_py(), key)
                if held.full():
                    yield from held.flush()
        yield from held.flush()

    return rows.mapInArrow(go, _COUNTED)


def _firsts(*columns: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal rows."""
    change = np.zeros(max(0, len(columns[0]) - 1), bool)
    for c in columns:
        change |= c[1:] != c[:-1]
    return np.flatnonzero(np.concatenate([[True], change])) if len(columns[0]) else np.zeros(0, np.int64)


class _Terms:
    """Cuts chunks into terms and sums per term; rows come sorted by chunk and place."""

    def __init__(self, min_docs: int):
        self.min_docs = min_docs
        self.last: tuple[bytes, list] = (b"", [])  # the chunk that the next rows may go on with, already cut
        self.proved: tuple | None = None           # its (chunk, language), if that has enough documents

    def cut(self, chunk: bytes) -> list[tuple[bytes, int]]:
        if chunk != self.last[0]:
            self.last = (chunk, list(Counter(_TERM.findall(chunk.lower())).items()))
        return self.last[1]

    def rows(self, t: pa.Table, ended: bool) -> tuple[pa.RecordBatch, pa.Table]:
        """(term rows, rows held back because their chunk may go on with too few documents so far)."""
        chunks, places = (t.column(c).combine_chunks().dictionary_encode() for c in ("chunk", "place"))
        chunk, place = (c.indices.to_numpy(zero_copy_only=False).astype(np.int64) for c in (chunks, places))
        names, parts = chunks.dictionary.cast(pa.binary()).to_pylist(), [_parts(p) for p in places.dictionary.to_pylist()]
        lang_of, source_of = ({x: j for j, x in enumerate(dict.fromkeys(p[i] for p in parts))} for i in (0, 1))
        lang_names, source_names = list(lang_of), list(source_of)
        lang, source = (np.array([of[p[i]] for p in parts], np.int64)[place] for i, of in enumerate((lang_of, source_of)))
        sizes = pc.list_value_length(t.column("keys").combine_chunks())
        starts = _firsts(chunk, lang)
        enough = np.add.reduceat(pc.fill_null(sizes, self.min_docs).to_numpy(zero_copy_only=False), starts) >= self.min_docs
        if self.proved == (names[chunk[0]], lang_names[lang[0]]):
            enough[0] = True
        rest = t.slice(0, 0)
        if not ended and not enough[-1]:  # fewer rows than min_docs
            rest = t.slice(int(starts[-1]))
            t, starts, enough = t.slice(0, int(starts[-1])), starts[:-1], enough[:-1]
            chunk, lang, source = chunk[:t.num_rows], lang[:t.num_rows], source[:t.num_rows]
            self.proved = None
        else:
            self.proved = (names[chunk[-1]], lang_names[lang[-1]])
        number: dict[bytes, int] = {}
        cut = [[(number.setdefault(w, len(number)), k) for w, k in self.cut(c)] for c in names]
        size = np.array([len(p) for p in cut], np.int64)
        flat = np.array([x for p in cut for x in p], np.int64).reshape(-1, 2)
        first = np.cumsum(size) - size
        terms = pa.array(list(number), pa.binary()).cast(pa.string())
        # occurrences: one row per term, language and source
        row = np.repeat(np.arange(len(chunk)), size[chunk])
        at = _expand(first[chunk], size[chunk])
        n_langs, n_sources = len(lang_names), len(source_names)
        key = (flat[at, 0] * n_langs + lang[row]) * n_sources + source[row]
        order = np.argsort(key, kind="stable")
        key = key[order]
        heads = _firsts(key)
        n = np.add.reduceat((t.column("n").to_numpy()[row] * flat[at, 1])[order], heads) if len(heads) else np.zeros(0, np.int64)
        key = key[heads]
        # documents: a proof (null key), or the keys of the few
        run_chunk, run_lang = chunk[starts], lang[starts]
        run = np.repeat(np.arange(len(starts)), size[run_chunk])
        word = flat[_expand(first[run_chunk], size[run_chunk]), 0] * n_langs + run_lang[run]
        proved = np.unique(word[enough[run]])
        sure = np.zeros(len(terms) * n_langs, bool)
        sure[proved] = True
        lists = t.column("keys").combine_chunks()
        held = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        values, offset = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(held) - held
        few = ~np.repeat(enough, np.diff(np.concatenate([starts, [len(chunk)]])))  # by row
        some = few[row] & ~sure[flat[at, 0] * n_langs + lang[row]]
        word, owner = (flat[at, 0] * n_langs + lang[row])[some], row[some]
        doc = values[_expand(offset[owner], held[owner])]
        word = np.repeat(word, held[owner])
        order = np.lexsort((doc, word))
        word, doc = word[order], doc[order]
        lone = _firsts(word, doc)
        word, doc = word[lone], doc[lone]
        many = np.bincount(word, minlength=len(sure)) >= self.min_docs
        proved = np.concatenate([proved, np.flatnonzero(many)])
        word, doc = word[~many[word]], doc[~many[word]]
        word, doc = np.concatenate([proved, word]), np.concatenate([np.full(len(proved), -1), doc])
        take = lambda values, index: values.take(pa.array(index))
        none, langs, sources = pa.nulls(len(word)), pa.array(lang_names, pa.string()), pa.array(source_names, pa.string())
        out = pa.Table.from_arrays([
            pa.chunked_array([take(langs, key // n_sources % n_langs), take(langs, word % n_langs)]),
            pa.chunked_array([take(terms, key // n_sources // n_langs), take(terms, word // n_langs)]),
            pa.chunked_array([take(sources, key % n_sources), none.cast(pa.string())]),
            pa.chunked_array([pa.array(n), none.cast(pa.int64())]),
            pa.chunked_array([pa.nulls(len(key), pa.int64()), pa.array(doc, pa.int64(), mask=doc < 0)])], names=["lang", "term", "source", "n", "key"])
        return out.combine_chunks(), rest


def term_rows(counted: DataFrame, min_docs: int) -> DataFrame:
    """``lang, term, source, n`` (occurrences) and ``lang, term, key`` with a null source
    (a document, or a proof of enough documents where the key is null too)."""
    met = counted.repartition("chunk").sortWithinPartitions("chunk", "place")

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, held, size = _Terms(min_docs), [], 0
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            size += batch.num_rows
            if size >= ROWS:
                out, rest = state.rows(pa.concat_tables(held).combine_chunks(), False)
                yield from out.to_batches()
                held, size = [rest], rest.num_rows
        if size:
            yield from state.rows(pa.concat_tables(held).combine_chunks(), True)[0].to_batches()

    return met.mapInArrow(go, _TERMS)


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang, term, source, n, lang_n, head``: occurrences of the terms that at least
    ``min_docs`` documents of the language hold, by source and in the language; ``head`` is
    true on one row a (language, term). Written once to the shared folder.

    Terms are runs of ASCII letters and characters beyond ASCII, A-Z in lower case. A null
    language, source or text is empty; every row is a document, repeated ids or not.
    """
    rows = term_rows(chunk_counts(docs, lang_col, source_col, text_col, min_docs), min_docs).repartition("lang", "term")
    summed = rows.groupBy("lang", "term", "source", "key").agg(F.sum("n").alias("n"))  # documents once each
    word = Window.partitionBy("lang", "term")
    frequent = (F.max(F.col("source").isNull() & F.col("key").isNull()).over(word)) | (F.count("key").over(word) >= min_docs)
    kept = (summed.select("lang", "term", "source", "n", frequent.alias("frequent"), F.sum("n").over(word).alias("lang_n"),
                          F.max("source").over(word).alias("top"))
            .filter("frequent and source is not null").select("lang", "term", "source", "n", "lang_n", (F.col("source") == F.col("top")).alias("head")))
    return written(kept, "terms")


def smoothed(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * terms)), exact at any size; null without terms."""
    wide = lambda c: c.cast("decimal(28,0)")
    top, base = wide(n + 2) * F.lit(SCALE).cast("decimal(10,0)"), F.nullif(wide(total + 2 * terms), F.lit(0).cast("decimal(28,0)"))
    return 1 + F.call_function("div", top, base)


def distance(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)) in whole numbers."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
          min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every (language, source) group.

    Part ``pair``: every other source of the language and the sum over all kept terms of
    the distance between the two sources' smoothed shares (0 without kept terms). Part
    ``term``: the ``top`` terms that the group has and uses more than its language, by
    that distance. Ranks go from 1, larger values first, ties by item in UTF-8 order.
    Groups without text or terms take part with zero counts; no rows give none.
    """
    name = lambda c: F.coalesce(col(c).cast("string"), F.lit(""))
    counts = term_counts(docs, lang_col, source_col, text_col, min_docs)
    per_lang = counts.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.sum(F.col("head").cast("bigint")).alias("terms"))
    groups = (docs.select(name(lang_col).alias("lang"), name(source_col).alias("source")).distinct()
              .join(counts.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
              .join(per_lang, "lang", "left").fillna(0, ["total", "terms", "lang_total"]))
    groups = cut_lineage(groups.withColumn("p0", smoothed(F.lit(0).cast("bigint"), F.col("total"), F.col("terms"))))  # one row a group
    side = small(groups, 256)
    known = counts.join(side, ["lang", "source"]).withColumn("p", smoothed(F.col("n"), F.col("total"), F.col("terms")))

    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    q = smoothed(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    best = (known.withColumn("q", q).filter("p > q").select("lang", "source", F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value"))
            .withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= top))

    # the sum over all kept terms, as if neither source had any, plus corrections
    own = known.select("lang", "term", "source", "p", "p0")
    other = [F.col(c).alias(f"{c}2") for c in ("source", "p", "p0")]
    f = lambda a, b: distance(F.col(a), F.col(b))
    both = (own.join(own.select("lang", "term", *other), ["lang", "term"]).filter("source < source2")
            .select("lang", "source", "source2", (f("p", "p2") - f("p", "p02") - f("p0", "p2") + f("p0", "p02")).alias("value")))
    shares = own.groupBy("lang", "source", "p", "p0").agg(F.count(F.lit(1)).alias("n"))
    rest = small(groups.select("lang", F.col("source").alias("source2"), F.col("p0").alias("p02"), "terms"), 128)
    ones = (shares.join(rest, "lang").filter("source <> source2")
            .select("lang", F.least("source", "source2").alias("source"), F.greatest("source", "source2").alias("source2"),
                    (F.col("n") * (f("p", "p02") - f("p0", "p02"))).alias("value")))
    neither = (groups.select("lang", "source", "p0").join(rest, "lang").filter("source < source2")
               .select("lang", "source", "source2", F.coalesce(F.col("terms") * f("p0", "p02"), F.lit(0)).alias("value")))
    sums = both.unionByName(ones).unionByName(neither).groupBy("lang", "source", "source2").agg(F.sum("value").alias("value"))
    ways = F.explode(F.array(F.struct(F.col("source").alias("s"), F.col("source2").alias("i")), F.struct(F.col("source2").alias("s"), F.col("source").alias("i"))))
    pairs = (sums.select("lang", ways.alias("w"), "value").select("lang", F.col("w.s").alias("source"), F.col("w.i").alias("item"), "value")
             .withColumn("rank", F.row_number().over(by_value)))
    parts = [d.select("lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("bigint").alias("value"), F.col("rank").cast("int").alias("rank"))
             for part, d in (("pair", pairs), ("term", best))]
    return parts[0].unionByName(parts[1])
