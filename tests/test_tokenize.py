"""Encoding and decoding in place: flat lookups and bounded slices."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.operators import tokenize as T
from tessera.operators.vocab import UNK, VOCAB_SCHEMA, Tokenizer, special_tokens


def test_words_that_share_a_hash_keep_their_own_ids(monkeypatch):
    words = [f"w{i}" for i in range(50)] + ["w3", "é"]
    asked = pa.array(["w3", "w49", "none", "é", "w0", "w"], pa.large_string())
    want = [7, 53, UNK, 55, 4, UNK]
    for hashes in (T._hashes, lambda w: np.zeros(len(w), np.uint64), lambda w: np.array([len(x) for x in w.to_pylist()], np.uint64)):
        monkeypatch.setattr(T, "_hashes", hashes)
        assert T.WordTable(pa.array(words, pa.large_string()), np.arange(4, 56)).find(asked).tolist() == want
    assert T.WordTable(pa.array([], pa.large_string()), np.empty(0, np.int32)).find(asked).tolist() == [UNK] * 6


def test_a_task_works_on_bounded_slices(monkeypatch):
    monkeypatch.setattr(T, "SLICE_ITEMS", 10)
    rows = [[1] * n for n in (4, 6, 0, 11, 30, 0, 0, 3, 7, 1)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(10)), pa.array(rows, pa.list_(pa.int32()))], ["k", "t"])
    cut = [b.column("t").to_pylist() for b in T._slices(iter([batch, batch.slice(10)]), "t")]
    assert [r for part in cut for r in part] == rows
    assert all(len(part) == 1 or sum(map(len, part)) <= 10 for part in cut)


@pytest.mark.parametrize("mode", ["word", "bpe"])
def test_rows_of_all_lengths_go_there_and_back(spark, mode):
    pieces = ["a", "b", "▁", "▁a", "ab"] if mode == "bpe" else ["a", "b", "ab", "a"]
    own = spark.createDataFrame([(4 + i, p, "word", None) for i, p in enumerate(pieces)], VOCAB_SCHEMA)
    merges = spark.createDataFrame([(0, "▁", "a", "▁a"), (1, "a", "b", "ab")], "merge_rank INT, left STRING, right STRING, piece STRING")
    tok = Tokenizer.of(special_tokens(spark).unionByName(own), mode, merges if mode == "bpe" else None)
    texts = ["a b", None, "", "  ", "ab zz a", "b" * 9] + ["ab a"] * 40
    ids = T.encode(spark.createDataFrame(list(enumerate(texts)), "idx BIGINT, text STRING").repartition(3), tok)
    got = [r["tokens"] for r in ids.orderBy("idx").collect()]
    if mode == "word":
        assert got == [[4, 5], [], [], [], [6, UNK, 4], [UNK], *[[6, 4]] * 40]
    else:
        assert got == [[7, 6, 5], [], [], [], [7, 5, 6, UNK, UNK, 7], [6] + [5] * 9, *[[7, 5, 7]] * 40]
    more = ids.withColumn("tokens", F.concat(F.array(F.lit(2), F.lit(None).cast("int"), F.lit(99)), "tokens", F.array(F.lit(3), F.lit(0))))
    text = [r["text"] for r in T.decode(more, tok).orderBy("idx").collect()]
    want = [["a b", "", "", "", "ab ⁇ a", "⁇", *["ab a"] * 40], ["a b", "", "", "", "ab  ⁇ ⁇ a", " " + "b" * 9, *["ab a"] * 40]][mode == "bpe"]
    assert text == [("⁇" + (" " if w and mode == "word" else "") + w) if mode == "word" else "⁇" + (w if w[:1] == " " else " " * bool(w) + w) for w in want]
