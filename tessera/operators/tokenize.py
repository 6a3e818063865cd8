"""Encode text to ids and decode ids to text.

A vocabulary within the byte bound is sent to every task once, and each record is
encoded or decoded where it is, in Arrow arrays of a bounded number of words or ids:
nothing of the corpus is shuffled, and a worker's memory is the vocabulary, kept flat, and
one such slice. In BPE mode a worker segments a word once and keeps the result (in a
bounded cache).
A larger vocabulary is joined instead: records become one row per word (or id), the
vocabulary is joined on it, and the pieces meet again per record. Both give the same
rows. Neither adds bos/eos; ``ensure_bos`` does (T9).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.arrays import ensure_bos as _ensure_bos
from tessera.functions.text import split_words
from tessera.operators.vocab import BOS, N_SPECIAL, UNK, WORD_MARK, Tokenizer

UNK_SHOWN = "⁇"
CACHED_WORDS = 200_000  # a worker's cache of segmented words
SLICE_ITEMS = 1 << 18   # words or ids that a task works on at a time
HASHED_WORDS = 1 << 16  # words hashed at a time


class WordTable:
    """First ids of words, kept flat for the tasks: the words in one Arrow array in the
    order of their 64-bit hashes. A few dozen bytes a word, whatever holds it."""

    def __init__(self, words: pa.Array, ids: np.ndarray):
        hashes = _hashes(words)
        order = np.lexsort((ids, hashes))  # of a word listed twice, the first id comes first
        self.hashes, self.ids = hashes[order], ids[order].astype(np.int32)
        self.words = words.take(pa.array(order))

    def find(self, words: pa.Array) -> np.ndarray:
        """The id of each of ``words``, UNK where there is none. Words that share a hash stand
        side by side and are compared one after the other."""
        out = np.full(len(words), UNK, np.int32)
        hashes = _hashes(words)
        at, left = np.searchsorted(self.hashes, hashes), np.arange(len(words))
        while len(left):
            left = left[at[left] < len(self.hashes)]
            left = left[self.hashes[at[left]] == hashes[left]]
            same = np.asarray(pc.equal(self.words.take(pa.array(at[left])), words.take(pa.array(left))), bool)
            out[left[same]] = self.ids[at[left[same]]]
            left = left[~same]
            at[left] += 1
        return out


def _hashes(words: pa.Array) -> np.ndarray:
    parts = [pd.util.hash_array(words.slice(i, HASHED_WORDS).to_numpy(zero_copy_only=False), categorize=False) for i in range(0, len(words), HASHED_WORDS)]
    return np.concatenate([np.empty(0, np.uint64), *parts])


def _vocab_columns(tok: Tokenizer) -> tuple[np.ndarray, pa.Array]:
    """(ids, pieces) of the ordinary pieces by id: at most the byte bound."""
    rows = tok.vocab.filter(F.col("id") >= N_SPECIAL).select("id", "piece").toArrow().sort_by("id")
    return rows.column("id").to_numpy(), rows.column("piece").cast(pa.large_string()).combine_chunks()


def _lookups(tok: Tokenizer):
    """What the tasks look words up in: a ``WordTable``, or (piece -> first id, merge -> rank)
    of a byte-pair tokenizer."""
    numbers, pieces = _vocab_columns(tok)
    if tok.mode == "word":
        return WordTable(pieces, numbers)
    ids: dict[str, int] = {}
    for i, piece in zip(numbers.tolist(), pieces.to_pylist()):
        ids.setdefault(piece, i)
    return ids, {(r["left"], r["right"]): r["merge_rank"] for r in tok.merges.collect()}


def _lists(lengths: np.ndarray, values: pa.Array) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _lengths(lists: pa.Array) -> np.ndarray:
    return lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)


def _sums(flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of ``flat`` over consecutive runs of the given lengths."""
    before = np.concatenate([[0], np.cumsum(flat)])
    ends = np.cumsum(lengths)
    return before[ends] - before[ends - lengths]


def _slices(batches: Iterator[pa.RecordBatch], col: str) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``SLICE_ITEMS`` list items of ``col``, a row at least,
    so that what a task holds does not depend on how many rows a batch has."""
    for batch in batches:
        ends, at = np.cumsum(_lengths(batch.column(col))), 0
        while at < batch.num_rows:
            done = int(ends[at - 1]) if at else 0
            end = max(at + 1, int(np.searchsorted(ends, done + SLICE_ITEMS, "right")))
            yield batch.slice(at, end - at)
            at = end


def _encode_in_place(df: DataFrame, tok: Tokenizer, text_col: str, key: str, out: str) -> DataFrame:
    from tessera.operators.bpe import segment
    # the words by the same expression as the counts, so both sides agree on blanks
    src = df.select(F.col(key).alias("k"), F.coalesce(split_words(text_col), F.array().cast("array<string>")).alias("w"))
    tables = df.sparkSession.sparkContext.broadcast(_lookups(tok))
    bpe = tok.mode == "bpe"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = tables.value
        known: dict[str, np.ndarray] = {}

        def pieces(word: str) -> np.ndarray:
            got = known.get(word)
            if got is None:
                if len(known) >= CACHED_WORDS:
                    known.clear()
                got = known[word] = np.array(segment(word, table[1], table[0]), np.int32)
            return got

        for batch in _slices(batches, "w"):
            words = batch.column("w")
            found = pc.dictionary_encode(words.flatten())  # each word of the slice is looked up once
            place, size = found.indices.to_numpy(zero_copy_only=False), _lengths(words)
            if bpe:
                parts = [pieces(w) for w in found.dictionary.to_pylist()]
                n = np.array([len(p) for p in parts], np.int64)
                flat, start = np.concatenate([np.empty(0, np.int32), *parts]), np.cumsum(n) - n
                per = n[place]
                ids = flat[np.repeat(start[place] - (np.cumsum(per) - per), per) + np.arange(per.sum())]
                size = _sums(per, size)
            else:
                ids = table.find(found.dictionary.cast(pa.large_string()))[place]
            yield pa.RecordBatch.from_arrays([batch.column("k"), _lists(size, pa.array(ids, pa.int32()))], ["k", "t"])

    done = src.mapInArrow(run, f"k {src.schema['k'].dataType.simpleString()}, t array<int>")
    return done.select(F.col("k").alias(key), F.col("t").alias(out))


def encode(df: DataFrame, tok: Tokenizer, text_col: str = "text", key: str = "idx",
           out: str = "tokens") -> DataFrame:
    """``key, out ARRAY<INT>``: the ids of ``text_col`` for each record (T6). A
    record with no words (or a null text) gets an empty array. ``key`` is unique."""
    if tok.fits:
        return _encode_in_place(df, tok, text_col, key, out)
    words = df.select(key, F.posexplode_outer(split_words(text_col)).alias("pos", "word"))
    if tok.mode == "word":
        lk = tok.lookup().withColumnRenamed("piece", "word")
        joined = words.join(lk, "word", "left").withColumn(
            "ids", F.array(F.coalesce(F.col("id"), F.lit(UNK))))
    else:
        from tessera.operators.bpe import segment_words
        distinct = words.filter(F.col("word").isNotNull()).select("word").distinct()
        joined = words.join(segment_words(distinct, tok), "word", "left")
    item = F.when(F.col("pos").isNotNull(), F.struct("pos", "ids"))
    per_rec = joined.groupBy(key).agg(F.array_sort(F.collect_list(item)).alias("_w"))
    return per_rec.select(key, F.flatten(F.transform("_w", lambda s: s["ids"])).alias(out))


def _decode_in_place(df: DataFrame, tok: Tokenizer, tokens_col: str, key: str, out: str) -> DataFrame:
    src = df.select(F.col(key).alias("k"), F.coalesce(F.col(tokens_col).cast("array<int>"), F.array().cast("array<int>")).alias("t"))
    bpe = tok.mode == "bpe"
    numbers, pieces = _vocab_columns(tok)
    # after the pieces, what stands for an id without one and for unk
    shown = pa.concat_arrays([pieces, pa.array([UNK_SHOWN, WORD_MARK + UNK_SHOWN if bpe else UNK_SHOWN], pa.large_string())])
    tables = df.sparkSession.sparkContext.broadcast((numbers, shown))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, shown = tables.value
        for batch in _slices(batches, "t"):
            tokens = batch.column("t")
            flat = tokens.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
            keep = (flat >= N_SPECIAL) | (flat == UNK)
            size, ids = _sums(keep, _lengths(tokens)), flat[keep]
            at = np.searchsorted(numbers, ids)
            known = at < len(numbers)
            known[known] = numbers[at[known]] == ids[known]
            at = np.where(ids == UNK, len(numbers) + 1, np.where(known, at, len(numbers)))
            text = pc.binary_join(_lists(size, shown.take(pa.array(at)).cast(pa.string())), "" if bpe else " ")
            if bpe:
                text = pc.utf8_ltrim(pc.replace_substring(text, WORD_MARK, " "), characters=" ")
            yield pa.RecordBatch.from_arrays([batch.column("k"), text], ["k", "s"])

    done = src.mapInArrow(run, f"k {src.schema['k'].dataType.simpleString()}, s string")
    return done.select(F.col("k").alias(key), F.col("s").alias(out))


def decode(df: DataFrame, tok: Tokenizer, tokens_col: str = "tokens", key: str = "idx",
           out: str = "text") -> DataFrame:
    """``key, out STRING``: text for ``tokens_col`` of each row.

    Control pieces (pad, bos, eos) are dropped, unk shows as U+2047. Word mode
    joins words with single spaces; BPE mode concatenates pieces and turns the
    word marker into a space.
    """
    if tok.fits:
        return _decode_in_place(df, tok, tokens_col, key, out)
    ex = df.select(key, F.posexplode_outer(tokens_col).alias("pos", "id"))
    pieces = tok.pieces()
    j = ex.join(pieces, "id", "left")
    keep = F.col("id").isNotNull() & ((F.col("id") >= N_SPECIAL) | (F.col("id") == UNK))
    shown = F.when(F.col("id") == UNK, F.lit("⁇")).otherwise(F.coalesce("piece", F.lit("⁇")))
    if tok.mode == "bpe":
        shown = F.when(F.col("id") == UNK, F.lit(WORD_MARK + "⁇")).otherwise(shown)
    item = F.when(keep, F.struct("pos", shown.alias("p")))
    per_rec = j.groupBy(key).agg(F.array_sort(F.collect_list(item)).alias("_p"))
    parts = F.transform("_p", lambda s: s["p"])
    if tok.mode == "word":
        text = F.array_join(parts, " ")
    else:
        text = F.regexp_replace(F.regexp_replace(F.array_join(parts, ""), WORD_MARK, " "), "^ +", "")
    return per_rec.select(key, text.alias(out))


def ensure_bos(df: DataFrame, tokens_col: str = "tokens", bos: int = BOS) -> DataFrame:
    """Prepend bos unless the ids already start with it."""
    return df.withColumn(tokens_col, _ensure_bos(tokens_col, bos))
