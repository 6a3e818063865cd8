import pytest

from tessera.session import ensure_checkpoint_dir


class _Context:
    master = "local[4]"

    def getCheckpointDir(self):
        return None


class _Session:
    sparkContext = _Context()

    class conf:
        @staticmethod
        def get(key, default=None):
            return default


def test_no_folder_raises_even_in_local_mode():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session())


def test_folder_of_the_session(spark):
    assert ensure_checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()


def test_one_id_a_piece(spark):
    from tessera.operators.vocab import Tokenizer, piece_to_id, word_vocab
    counts = spark.createDataFrame([("<pad>", 9), ("a", 5), ("</s>", 4), ("b", 1)], "word string, n bigint")
    tok = Tokenizer.of(word_vocab(counts), "word")
    asked = spark.createDataFrame([("<pad>",), ("a",), ("b",), ("zz",), ("a",)], "piece string")
    got = sorted((r["piece"], r["id"]) for r in piece_to_id(asked, tok).collect())
    assert got == [("<pad>", 0), ("a", 4), ("a", 4), ("b", 5), ("zz", 1)]


def test_uncovered_characters_break_words(spark):
    from tessera.operators.bpe import train_bpe
    counts = spark.createDataFrame([("abab", 50), ("abqab", 3), ("aq", 1)], "word string, n bigint")
    tok = train_bpe(counts, 30, coverage=0.98, allow_smaller=True)
    pieces = {r["piece"] for r in tok.vocab.collect()}
    assert "q" not in pieces and not any("q" in p for p in pieces) and "ab" in pieces


def test_small_and_large_vocabularies_encode_alike(spark):
    """The in-place form shuffles nothing; the join form gives the same rows."""
    import dataclasses

    from tessera.operators.bpe import train_bpe
    from tessera.operators.tokenize import decode, encode
    from tessera.operators.vocab import Tokenizer, word_counts, word_vocab
    rows = [(i, t) for i, t in enumerate(["low lower  newest", "", None, "widest low \u3000 low q", "\u2581x y", "aaa aaaa"])]
    text = spark.createDataFrame(rows, "idx bigint, text string")
    counts = word_counts(text.filter("idx < 4"))
    for tok in (Tokenizer.of(word_vocab(counts, 7), "word"), train_bpe(counts, 22, allow_smaller=True)):
        assert tok.fits
        large = dataclasses.replace(tok, bytes=1 << 40)
        ids = encode(text, tok)
        assert "Exchange" not in ids._jdf.queryExecution().executedPlan().toString()
        a, b = ({r["idx"]: list(r["tokens"]) for r in encode(text, t).collect()} for t in (tok, large))
        assert a == b
        a, b = ({r["idx"]: r["text"] for r in decode(ids, t).collect()} for t in (tok, large))
        assert a == b
