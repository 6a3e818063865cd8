"""Vocabulary building blocks (T1, T2, T3, T8) and the word-mode vocabulary.

A vocabulary is ``id INT, piece STRING, kind STRING, merge_rank INT`` with ids
0-3 reserved for pad, unk, bos, eos.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import cut_lineage

from tessera.functions.text import split_words
from tessera.operators.ordering import global_rank, prefix_sum

# Special pieces and their ids.
SPECIALS = [(0, "<pad>", "control"), (1, "<unk>", "unknown"), (2, "<s>", "control"), (3, "</s>", "control")]
PAD, UNK, BOS, EOS = 0, 1, 2, 3
N_SPECIAL = 4
# Fixed value: the word-start marker of byte-pair pieces (shown as a space on decode).
WORD_MARK = "▁"
# Bytes a lookup table may have (measured when it is built) and still be sent to
# every task. Above it the join shuffles, and AQE splits hot keys on the large side.
BROADCAST_BYTES = 64 << 20

VOCAB_SCHEMA = "id INT, piece STRING, kind STRING, merge_rank INT"


def special_tokens(spark: SparkSession) -> DataFrame:
    """The four reserved rows."""
    return spark.createDataFrame([(i, p, k, None) for i, p, k in SPECIALS], VOCAB_SCHEMA)


def word_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``word STRING, n BIGINT``: whitespace-run words and their counts.

    Words are counted with a map-side partial aggregate, so a very frequent
    word is summed in every partition before the shuffle.
    """
    return (df.select(F.explode(split_words(text_col)).alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def alphabet(counts: DataFrame, coverage: float = 1.0, marker: str | None = WORD_MARK) -> DataFrame:
    """``ch STRING, n BIGINT, share DOUBLE`` for the characters kept at ``coverage``.

    Characters are weighted by word counts; with the word marker on, every
    word adds one marker. ``coverage`` 1.0 keeps every character; below it,
    the rarest characters whose cumulative share stays past the threshold are
    dropped (they later encode as unk). Order: count desc, character asc.
    """
    word = F.concat(F.lit(marker), F.col("word")) if marker else F.col("word")
    chars = (counts.select(F.explode(F.split(word, "")).alias("ch"), "n")
             .filter(F.col("ch") != "")
             .groupBy("ch").agg(F.sum("n").alias("n")))
    chars = cut_lineage(chars)
    ranked = global_rank(chars, [F.desc("n"), "ch"], "_r")
    total = chars.agg(F.sum("n")).first()[0] or 0
    if coverage >= 1.0 or total == 0:
        return ranked.select("ch", "n", (F.col("n") / F.lit(float(max(total, 1)))).alias("share"), "_r")
    cum = prefix_sum(ranked, ["_r"], F.col("n"), "_before")
    return (cum.filter(F.col("_before") < F.lit(coverage * total))
            .select("ch", "n", (F.col("n") / F.lit(float(total))).alias("share"), "_r"))


def top_words(counts: DataFrame, k: int) -> DataFrame:
    """The first ``k`` rows in the order (n desc, word), without sorting all of them.

    The ``k`` largest different counts, with how many words have each, fix the count at
    which the ``k``-th word stands (they are at most ``k`` rows, from a partial aggregate).
    All words above it stay; of those at it the first by spelling are taken, a top-k in
    each partition.
    """
    if k == 0:
        return counts.limit(0)
    left = k
    for r in counts.groupBy("n").agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("n")).limit(k).collect():
        if r["c"] >= left:
            tied = counts.filter(F.col("n") == r["n"])
            tied = tied if r["c"] == left else tied.orderBy("word").limit(left)
            return counts.filter(F.col("n") > r["n"]).unionByName(tied)
        left -= r["c"]
    return counts  # no more than k words


def word_vocab(counts: DataFrame, max_size: int | None = None) -> DataFrame:
    """Word-mode vocabulary: id = 4 + 0-based rank by (count desc, word asc).

    ``max_size`` is the total vocabulary size including the specials; words
    past it encode as unk. ``None`` keeps every word.
    """
    spark = counts.sparkSession
    # a word that spells a special piece is no ordinary piece: one id a piece
    counts = counts.filter(~F.col("word").isin([p for _, p, _ in SPECIALS]))
    counts = cut_lineage(counts)  # read for the threshold or sampled for range bounds, then ranked
    if max_size is not None:
        counts = top_words(counts, max(0, max_size - N_SPECIAL))
    ranked = global_rank(counts, [F.desc("n"), "word"], "_r")
    words = ranked.select((F.col("_r") + N_SPECIAL - 1).cast("int").alias("id"), F.col("word").alias("piece"),
                          F.lit("word").alias("kind"), F.lit(None).cast("int").alias("merge_rank"))
    return special_tokens(spark).unionByName(words)


@dataclass
class Tokenizer:
    """A vocabulary (and, in BPE mode, merges) held as DataFrames.

    ``size`` is the row count of ``vocab``, ``bytes`` its measured size (merges
    included), which decides whether it may be sent to every task.
    """
    vocab: DataFrame
    mode: str  # "word" or "bpe"
    size: int
    merges: DataFrame | None = None
    bytes: int = 1 << 62

    @property
    def fits(self) -> bool:
        return self.bytes <= BROADCAST_BYTES

    @classmethod
    def of(cls, vocab: DataFrame, mode: str, merges: DataFrame | None = None) -> "Tokenizer":
        vocab = cut_lineage(vocab)
        size, weight = vocab.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("piece") + 32), F.lit(0))).first()
        if merges is not None:
            merges = cut_lineage(merges)
            weight += merges.agg(F.coalesce(F.sum(F.octet_length("left") + F.octet_length("right") + 48), F.lit(0))).first()[0]
        return cls(vocab, mode, size, merges, int(weight))

    def lookup(self) -> DataFrame:
        """``piece -> id`` for non-special pieces, broadcast when its size allows."""
        t = self.vocab.filter(F.col("id") >= N_SPECIAL).select("piece", "id")
        return F.broadcast(t) if self.fits else t

    def pieces(self) -> DataFrame:
        t = self.vocab.select("id", "piece", "kind")
        return F.broadcast(t) if self.fits else t


def vocab_size(tok: Tokenizer) -> int:
    """Number of pieces, specials included."""
    return tok.size


def piece_to_id(df: DataFrame, tok: Tokenizer, piece_col: str = "piece", out: str = "id") -> DataFrame:
    """Look up ids of pieces, special ones included; unknown pieces get unk.
    A piece listed twice has its first id, so a row never comes back twice."""
    lk = tok.vocab.groupBy(F.col("piece").alias("_p")).agg(F.min("id").alias("_id"))
    lk = F.broadcast(lk) if tok.fits else lk
    return (df.join(lk, df[piece_col] == lk["_p"], "left")
            .withColumn(out, F.coalesce(F.col("_id"), F.lit(UNK)))
            .drop("_p", "_id"))
