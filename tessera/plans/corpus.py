"""Whole-corpus plans composed from the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.config import Config
from tessera.functions.text import format_qa
from tessera.operators.split import split_exact
from tessera.operators.tokenize import encode
from tessera.operators.vocab import PAD, Tokenizer, word_counts, word_vocab
from tessera.operators.windows import pack_windows


def training_text(pairs: DataFrame, cfg: Config = Config(), strip: bool = False) -> DataFrame:
    """``idx, text``: records formatted with the training template.
    The training path formats the fields as they are; ``strip`` gives the
    tokenizer-input form."""
    return pairs.select("idx", format_qa("question", "answer", cfg.prompt_format, strip=strip).alias("text"))


def word_tokenizer(texts: DataFrame, text_col: str = "text", max_size: int | None = None) -> Tokenizer:
    """Word-mode tokenizer fitted on ``texts`` (T2 + word vocabulary)."""
    return Tokenizer.of(word_vocab(word_counts(texts, text_col), max_size), "word")


def split_windows(pairs: DataFrame, cfg: Config = Config(), tok: Tokenizer | None = None) -> DataFrame:
    """Pairs -> training text -> ids -> windows -> exact train/val split."""
    text = training_text(pairs, cfg)
    tok = tok or word_tokenizer(text)
    ids = encode(text, tok)
    wins = pack_windows(ids, cfg.block_size, cfg.step_size, cfg.pad_id)
    return split_exact(wins, cfg.train_ratio, cfg.seed)


def window_stats(pairs: DataFrame, cfg: Config = Config(), tok: Tokenizer | None = None) -> DataFrame:
    """How many training and validation windows, and how many real tokens in
    each, does this corpus give? (the end-to-end slice)."""
    sw = split_windows(pairs, cfg, tok)
    real = F.size(F.filter("x", lambda t: t != F.lit(PAD)))
    return sw.groupBy("split").agg(F.count(F.lit(1)).alias("n_windows"),
                                   F.sum(real).cast("bigint").alias("real_tokens"))
