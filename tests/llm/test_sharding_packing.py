import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm.packing import WordIds, lay_out, pack, pack_histogram, token_pieces
from tessera.llm.sharding import interleave_shards
from tests.conftest import SF_SMALL

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_shards_are_even_gapless_and_mixed(spark):
    n = 2000
    rows = spark.range(n).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None)
                                 .otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"))
    out = interleave_shards(rows, 24, bucket_bits=4).toPandas()
    assert sorted(out.doc_id) == list(range(n))
    sizes = out.groupby("shard").size()
    assert len(sizes) == 24 and sizes.max() - sizes.min() <= 1
    for _, g in out.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    for source, g in out.groupby(out.source.fillna("none")):
        per = g.groupby("shard").size().reindex(range(24), fill_value=0)
        assert (per - len(g) / 24).abs().max() < 2, source
    again = interleave_shards(rows.repartition(5), 24, bucket_bits=7).toPandas()  # neither partitions nor slices matter
    a, b = (x.sort_values("doc_id")[["shard", "slot"]].to_numpy() for x in (out, again))
    assert (a == b).all()


def test_shard_edge_cases(spark, docs, empty):
    out = interleave_shards(docs, 24).collect()
    assert len(out) == docs.count() and sorted(r["shard"] for r in out) == sorted(i * 24 // 10 for i in range(10))
    assert interleave_shards(docs, 24).schema["shard"].dataType.simpleString() == "int"  # the input's string column is replaced
    assert interleave_shards(empty, 24).count() == 0


def test_word_cache_equals_the_tokenizer():
    tok, words = Tokenizer.from_file(PATH), WordIds(PATH, cap=50)
    rng = random.Random(5)
    alphabet = ["a", "B", "é", "É", "'s", "'LL", "1", ".", "!!", " ", "\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", "ﬁ", "İ", "Σ", "日", "é", "́", "µ", "ª",
                "<|endoftext|>", "<|", "|>", "🎉", "_", "½", "ß", "×", " ", "​", "x" * 250]
    for _ in range(1500):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25)))
        assert np.frombuffer(words.encode(text), "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("counts", [{}, {4096: 7}, {100: 10007}, {1: 5}, {4000: 3, 96: 2, 97: 4}, {3000: 50, 1000: 20, 90: 7}])
def test_histogram_is_packed_whole(counts):
    patterns = pack_histogram(counts, 4096)
    used = Counter()
    for pattern, packs in patterns:
        assert packs > 0 and sum(n * t for n, t in pattern) <= 4096
        for n, t in pattern:
            used[n] += t * packs
    assert used == Counter(counts)
    assert all(len(rows) for rows in lay_out(patterns, 4096).values())


def test_random_histogram_wastes_little():
    rng = random.Random(2)
    counts = Counter(min(4096, int(rng.lognormvariate(6.5, 1)) + 1) for _ in range(50000))
    packs = sum(n for _, n in pack_histogram(dict(counts), 4096))
    assert sum(n * c for n, c in counts.items()) / (packs * 4096) > 0.99


def check_packed(rows, texts):
    tok = Tokenizer.from_file(PATH)
    want = Counter()
    for doc_id, text in texts:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [2]
        for s in range(0, len(ids), 4096):
            part = np.array(ids[s:s + 4096], "<u4")
            want[(doc_id, s, len(part), zlib.crc32(part.tobytes()), len(ids))] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows) == want
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 4096
    return by


def test_pack_edge_cases(docs, empty):
    rows = pack(token_pieces(docs, PATH), buckets=3).collect()
    check_packed(rows, [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert pack(token_pieces(empty, PATH)).count() == 0


def test_pack_documents(spark):
    documents = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = pack(token_pieces(documents, PATH)).collect()
    by = check_packed(rows, [(r["doc_id"], r["text"]) for r in documents.collect()])
    assert sum(r["length"] for r in rows) / (len(by) * 4096) > 0.97


def test_shards_against_a_plain_ranking(spark):
    """Every row's shard and slot from its definition: fractional ranks in plain Python."""
    from fractions import Fraction
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "source")
    rows = [(r["doc_id"], "null" if r["source"] is None else "=" + r["source"], r["u"]) for r in docs.withColumn("u", F.xxhash64(F.lit(17), "doc_id")).collect()]
    order = []
    for s in {r[1] for r in rows}:
        own = sorted((u, i) for i, t, u in rows if t == s)
        order += [(Fraction(2 * k + 1, 2 * len(own)), s.encode(), u, i) for k, (u, i) in enumerate(own)]
    want, taken = {}, Counter()
    for pos, (_, _, _, i) in enumerate(sorted(order)):
        shard = pos * 24 // len(rows)
        want[i] = (shard, taken[shard])
        taken[shard] += 1
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in interleave_shards(docs, 24).collect()} == want


def test_packing_carries_columns_of_any_name(spark):
    rows = [(i, 5 + i % 3, 222, "b", i * 2, {"k": i}, 7) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, length bigint, _u int, `_b` string, offset bigint, m map<string,int>, sequence_id int")
    out = pack(df.withColumn("ro.w", F.lit(1)), 20)
    assert out.columns == ["doc_id", "length", "_u", "_b", "m", "ro.w", "sequence_id", "offset"]
    got = out.collect()
    assert {(r["doc_id"], r["_u"], r["_b"], r["m"]["k"]) for r in got} == {(i, 222, "b", i) for i in range(40)}
    used = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == used.get(r["sequence_id"], 0)
        used[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(used.values()) <= 20
