"""Byte-pair tokenizer training and word segmentation (T4, BPE mode of T6).

Training follows the published algorithm (Sennrich et al. 2016) on the word
counts of T2: every word is ``WORD_MARK + word`` split into characters; the most
frequent pair of adjacent symbols weighted by word count is merged everywhere (ties:
left symbol, then right symbol, by code point), again and again.

One merge a round would be thousands of rounds. A round here finds the longest
stretch of the classical merges that a bounded excerpt of the words decides:

* the working set holds *distinct* words, not the corpus, each as one string with
  every symbol between two reserved marks (``OPEN s CLOSE``);
* the most frequent pairs are fetched; the first ``reach`` of them give a floor: every
  pair counted at the floor or above is among them (the strong pairs);
* every word is cut where two neighbours are no strong pair, and equal stretches are
  summed, map-side first. At most ``window`` stretches are fetched; if there are more,
  fewer pairs count as strong, and if there are far fewer, more pairs do: a round costs
  two passes over the words besides this one;
* the classical algorithm runs on the stretches while the best pair is at the floor or
  above. Its merges are then applied to all words in one pass.

Why these are the classical merges: a pair that arises in a round stands, wherever it
occurs, over one place where two symbols of the round's start met, and it is the same
two symbols everywhere, because a new symbol has one spelling in symbols of the start.
So it occurs at most as often as those two did; if they were not strong, it is below
the floor, and otherwise all its places are inside stretches and its count there is
exact. A merge whose piece equals an earlier piece would break the one spelling, so it
ends its round. When more pairs tie at the top than may be fetched, the round makes the
one merge that needs no excerpt.

Our pieces are not the pieces of any particular native trainer: text is
split on whitespace runs only, without Unicode normalisation.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.vocab import (N_SPECIAL, UNK, VOCAB_SCHEMA, WORD_MARK, Tokenizer, alphabet,
                                     special_tokens)
from tessera.session import cut_lineage

# Reserved private-use characters that delimit symbols while
# training. Input text containing them has them replaced by U+FFFD.
OPEN, CLOSE = "\ue000", "\ue001"
MOST_REACH = 1 << 16  # pairs that the driver fetches at most
AHEAD = 4  # times the pairs of a round that are fetched, so that it can take more


def _marked(word: F.Column, kept: list[str] | None = None) -> F.Column:
    """The word as marked symbols. With ``kept``, any other character becomes an empty
    symbol, which is in no pair: merges never reach across it."""
    clean = F.regexp_replace(word, f"[{OPEN}{CLOSE}]", "\ufffd")
    chars = F.filter(F.split(F.concat(F.lit(WORD_MARK), clean), ""), lambda c: c != F.lit(""))
    if kept is not None:
        chars = F.transform(chars, lambda c: F.when(c.isin(kept), c).otherwise(F.lit("")))
    return F.concat(F.lit(OPEN), F.array_join(chars, CLOSE + OPEN), F.lit(CLOSE))


def _places(words: pa.Array) -> tuple[list[tuple[str, str]], np.ndarray, np.ndarray]:
    """Where symbols meet in a batch of marked words: the different pairs, and of each
    place its pair's and its word's index. Empty symbols are in no pair."""
    lists = pc.split_pattern(words, CLOSE)  # symbols behind their opening marks, and nothing behind the last
    size, found = lists.value_lengths().to_numpy(), pc.dictionary_encode(lists.flatten())
    code, names = found.indices.to_numpy().astype(np.int64), found.dictionary
    void = np.asarray(pc.is_in(names, pa.array([OPEN, ""], names.type)), bool)[code]
    at = np.flatnonzero(~void[:-1] & ~void[1:])  # the nothing behind a word parts it from the next
    keys, which = np.unique(code[at] * len(names) + code[at + 1], return_inverse=True)
    plain = pc.utf8_slice_codeunits(names, 1).to_pylist()
    pairs = [(plain[k // len(names)], plain[k % len(names)]) for k in keys.tolist()]
    return pairs, which, np.repeat(np.arange(len(size)), size)[at]


def pair_counts(words: DataFrame) -> DataFrame:
    """``a, b, cnt``: adjacent symbol pairs weighted by word count (overlapping
    pairs counted, as in the reference algorithm). Summed in each Arrow batch, then
    map-side, then by pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, which, row = _places(batch.column("w"))
            sums = np.zeros(len(pairs), np.int64)
            np.add.at(sums, which, batch.column("n").to_numpy()[row])
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in pairs], pa.string()), pa.array([b for _, b in pairs], pa.string()), pa.array(sums)], ["a", "b", "cnt"])

    counted = words.filter("w is not null and n is not null").select("w", F.col("n").cast("bigint").alias("n"))
    return counted.mapInArrow(run, "a string, b string, cnt bigint").groupBy("a", "b").agg(F.sum("cnt").alias("cnt"))


def _merged(syms: list[str], pairs: set[tuple[str, str]]) -> list[str]:
    """``syms`` with the pairs merged, left to right; the same list if it holds none."""
    if not any(p in pairs for p in zip(syms, syms[1:])):
        return syms
    out, i = [], 0
    while i < len(syms):
        if i + 1 < len(syms) and (syms[i], syms[i + 1]) in pairs:
            out.append(syms[i] + syms[i + 1])
            i += 2
        else:
            out.append(syms[i])
            i += 1
    return out


def merge_symbols(syms: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """``syms`` after merging the pair of lowest rank everywhere, left to right, until no
    ranked pair is left. A heap of ranked neighbours over a linked list: n log n steps."""
    n = len(syms)
    heap = [(r, i) for i, p in enumerate(zip(syms, syms[1:])) if (r := ranks.get(p)) is not None]
    if not heap:
        return syms
    heapq.heapify(heap)
    syms, after, before = list(syms), list(range(1, n + 1)), list(range(-1, n - 1))
    while heap:
        rank, touched = heap[0][0], []
        while heap and heap[0][0] == rank:  # all places of this pair before any pair that it makes
            i = heapq.heappop(heap)[1]
            j = after[i]
            if syms[i] is None or j == n or ranks.get((syms[i], syms[j])) != rank:
                continue  # its place has changed since
            syms[i] += syms[j]
            syms[j] = None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            touched += [i] if before[i] < 0 else [before[i], i]
        for i in touched:
            j = after[i]
            if syms[i] is not None and j < n and (r := ranks.get((syms[i], syms[j]))) is not None:
                heapq.heappush(heap, (r, i))
    return [s for s in syms if s is not None]


def _split(w: str) -> list[str]:
    return w[1:-1].split(CLOSE + OPEN)


def _joined(syms: list[str]) -> str:
    return OPEN + (CLOSE + OPEN).join(syms) + CLOSE


def _apply(words: DataFrame, now: list[tuple[str, str]]) -> DataFrame:
    """The words after the merges ``now``, in that order; words of one symbol go."""
    ranks = {p: i for i, p in enumerate(now)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, out = [], []
            for i, w in enumerate(batch.column("w").to_pylist()):
                syms = merge_symbols(_split(w), ranks)
                if len(syms) > 1:
                    kept.append(i)
                    out.append(_joined(syms))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), batch.column("n").take(pa.array(kept, pa.int64()))], ["w", "n"])

    return words.mapInArrow(run, "w string, n bigint")


def _stretches(words: DataFrame, strong: set[tuple[str, str]]) -> DataFrame:
    """``w, n``: the distinct runs of neighbours that are strong pairs, with their word counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter[str] = Counter()
            for w, n in zip(batch.column("w").to_pylist(), batch.column("n").to_pylist()):
                syms = _split(w)
                weak = [i + 1 for i, p in enumerate(zip(syms, syms[1:])) if p not in strong]
                for a, b in zip([0, *weak], [*weak, len(syms)]):
                    if b - a > 1:
                        found[_joined(syms[a:b])] += n
            yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], ["w", "n"])

    return words.mapInArrow(run, "w string, n bigint").groupBy("w").agg(F.sum("n").alias("n"))


class Window:
    """Classical training on weighted stretches of symbols, with an index from pairs to
    the stretches that hold them."""

    def __init__(self, stretches: list[tuple[list[str], int]]):
        self.syms = [s for s, _ in stretches]
        self.weight = [n for _, n in stretches]
        self.count: Counter[tuple[str, str]] = Counter()
        self.where: dict[tuple[str, str], set[int]] = {}
        for i, syms in enumerate(self.syms):
            for p in zip(syms, syms[1:]):
                self.count[p] += self.weight[i]
                self.where.setdefault(p, set()).add(i)
        self.heap = [(-c, *p) for p, c in self.count.items()]
        heapq.heapify(self.heap)

    def best(self) -> tuple[int, tuple[str, str] | None]:
        while self.heap:
            c, a, b = self.heap[0]
            if self.count[a, b] == -c:
                return -c, (a, b)
            heapq.heappop(self.heap)  # counted anew since; its present count is in the heap too
        return 0, None

    def merge(self, pair: tuple[str, str]) -> None:
        changed = set()
        for i in self.where.pop(pair):
            old = self.syms[i]
            new = self.syms[i] = _merged(old, {pair})
            if new is old:
                continue
            for p in zip(old, old[1:]):
                self.count[p] -= self.weight[i]
                changed.add(p)
            for p in zip(new, new[1:]):
                self.count[p] += self.weight[i]
                self.where.setdefault(p, set()).add(i)
                changed.add(p)
        for p in changed:
            if self.count[p] > 0:
                heapq.heappush(self.heap, (-self.count[p], *p))
            else:
                del self.count[p]


def _floor(top: list, reach: int, least: int) -> int | None:
    """The lowest count that no pair outside the first ``reach`` rows of ``top`` has; None
    if they all tie with the next. ``top`` holds one row more if there are more pairs."""
    if len(top) <= reach:
        return least
    return min((r["cnt"] for r in top[:reach] if r["cnt"] > top[reach]["cnt"]), default=None)


def _round(words: DataFrame, top: list, look: int, reach: int, least: int, window: int, known: set[str], most: int) -> tuple[list[tuple[str, str]], int]:
    """The merges that one excerpt decides, at most ``most`` of them, and the number of
    pairs that the next round may take as strong. ``top`` are the first ``look`` pairs and
    one more: while the excerpt fills a small part of the window, more of them are taken as
    strong in the same round."""
    found, halved = None, False
    while True:
        floor = _floor(top, reach, least)
        if floor is None:
            return [(top[0]["a"], top[0]["b"])], reach
        rows = _stretches(words, {(r["a"], r["b"]) for r in top[:reach] if r["cnt"] >= floor}).limit(window + 1).collect()
        if len(rows) <= window:
            found = floor, rows, reach
            if halved or 4 * len(rows) > window or len(top) <= reach or reach == look:
                break
            reach = min((4 if 16 * len(rows) <= window else 2) * reach, look)
            continue
        if found:
            break
        halved, reach = True, max(1, reach // 2)
        if len(top) <= reach or reach == 1:
            return [(top[0]["a"], top[0]["b"])], reach
    floor, rows, reach = found
    if 4 * len(rows) <= window:
        reach = min(2 * reach, MOST_REACH)
    run, now = Window([(_split(r["w"]), r["n"]) for r in rows]), []
    while len(now) < most:
        count, pair = run.best()
        if pair is None or count < floor:
            break
        now.append(pair)
        if pair[0] + pair[1] in known:
            break
        known.add(pair[0] + pair[1])
        run.merge(pair)
    return now, reach


def train_bpe(counts: DataFrame, vocab_size: int, coverage: float = 1.0, min_count: int = 1, allow_smaller: bool = False,
              window: int = 50_000, reach: int = 256, word_col: str = "word") -> Tokenizer:
    """Train a BPE tokenizer of ``vocab_size`` pieces (specials included) from
    ``word, n`` counts (T4): the classical merges, whatever ``window`` and ``reach`` are.

    Vocabulary: ids 0-3 specials, then the alphabet (count desc, character),
    then merged pieces in merge order (``merge_rank`` 0, 1, ...). Raises when
    the corpus runs out of pairs first, unless ``allow_smaller``. The driver holds at
    most ``window`` stretches and ``MOST_REACH`` pairs at a time. Words are written to the
    checkpoint folder once a round.
    """
    if window < 1 or reach < 1:
        raise ValueError("window and reach are at least 1")
    spark = counts.sparkSession
    counts = cut_lineage(counts.select(F.col(word_col).alias("word"), "n"))  # read for the alphabet and for the words
    alpha = alphabet(counts, coverage)
    alpha_rows = alpha.orderBy("_r").select("ch").collect()  # at most the distinct characters
    n_alpha = len(alpha_rows)
    n_merges = vocab_size - N_SPECIAL - n_alpha
    if n_merges < 0:
        raise ValueError(f"vocab_size {vocab_size} is below specials + alphabet ({N_SPECIAL + n_alpha})")
    kept = [r["ch"] for r in alpha_rows] if coverage < 1.0 else None
    words = cut_lineage(counts.select(_marked(F.col("word"), kept).alias("w"), "n"))
    merges: list[tuple[str, str]] = []
    known = {r["ch"] for r in alpha_rows}
    least = max(min_count, 1)
    while len(merges) < n_merges:
        look = min(AHEAD * reach, MOST_REACH)
        top = (pair_counts(words).filter(F.col("cnt") >= least).orderBy(F.desc("cnt"), "a", "b").limit(look + 1).collect())
        if not top:
            break
        if _floor(top, reach, least) is None and reach < MOST_REACH:
            reach = min(4 * reach, MOST_REACH)  # all tie: look further
            continue
        now, reach = _round(words, top, look, reach, least, window, known, n_merges - len(merges))
        known.update(a + b for a, b in now)
        merges += now
        if len(merges) < n_merges:
            words = cut_lineage(_apply(words, now))
    if len(merges) < n_merges and not allow_smaller:
        raise ValueError(f"corpus supports {N_SPECIAL + n_alpha + len(merges)} pieces, "
                         f"vocab_size {vocab_size} requested")
    merges_df = spark.createDataFrame(
        [(r, a, b, a + b) for r, (a, b) in enumerate(merges)], "merge_rank INT, left STRING, right STRING, piece STRING")
    chars = spark.createDataFrame(
        [(N_SPECIAL + i, r["ch"], "char", None) for i, r in enumerate(alpha_rows)], VOCAB_SCHEMA)
    pieces = spark.createDataFrame(
        [(N_SPECIAL + n_alpha + r, a + b, "merge", r) for r, (a, b) in enumerate(merges)], VOCAB_SCHEMA)
    # a merged piece equal to an earlier piece keeps its first id
    vocab = special_tokens(spark).unionByName(chars).unionByName(pieces)
    return Tokenizer.of(vocab, "bpe", merges_df)


def segment(word: str, ranks: dict, ids: dict) -> list[int]:
    """Ids of one word: ``WORD_MARK + word`` as characters, then repeatedly the
    lowest-rank adjacent pair is merged everywhere (left to right) until no
    known pair is left. Unknown characters map to unk."""
    syms = list(WORD_MARK + word.replace(OPEN, "\ufffd").replace(CLOSE, "\ufffd"))
    return [ids.get(s, UNK) for s in merge_symbols(syms, ranks)]


def segment_words(words: DataFrame, tok: Tokenizer) -> DataFrame:
    """``word, ids ARRAY<INT>`` for distinct words (BPE mode of T6).

    The merge ranks and piece ids travel to the tasks as one broadcast; their
    size is the tokenizer's, at most ``vocab_size`` entries. Each Arrow batch
    of words is segmented by ``segment``.
    """
    if tok.merges is None:
        raise ValueError("a BPE tokenizer needs its merges")
    sc = words.sparkSession.sparkContext
    ranks = {(r["left"], r["right"]): r["merge_rank"] for r in tok.merges.collect()}
    ids = {}
    for r in sorted(tok.vocab.filter(F.col("id") >= N_SPECIAL).collect(), key=lambda r: r["id"]):
        ids.setdefault(r["piece"], r["id"])  # a piece made twice keeps its first id
    bc = sc.broadcast((ranks, ids))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rk, ix = bc.value
        for pdf in batches:
            yield pd.DataFrame({"word": pdf["word"], "ids": [segment(w, rk, ix) for w in pdf["word"]]})

    return words.select("word").mapInPandas(run, "word STRING, ids ARRAY<INT>")
