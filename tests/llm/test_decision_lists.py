import re
import zlib
from collections import Counter

import numpy as np

import __spark_entry__ as entry
from tessera.llm import decision_lists as dl
from tests.conftest import SF_SMALL

SF = "/root/testdata/sf0.01"


def plain(text):
    """The base counts, word by word."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        dup += line in seen and re.search(r"[^\x20\x09-\x0D]", line) is not None
        seen.add(line)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    hit = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit)


def test_counts_against_plain_python(spark, docs, empty):
    for df in (docs, spark.read.parquet(f"{SF_SMALL}/documents.parquet")):
        rows = dl.statistics(df).select("text", "stats").collect()
        assert len(rows) == df.count()
        for r in rows:
            assert tuple(r["stats"])[:5] == plain(r["text"])
    assert dl.statistics(docs).columns[-1] == "stats" and dl.statistics(empty).count() == 0
    assert dl.statistics(docs, carry=["doc_id"]).columns == ["doc_id", "stats"]
    s = dict(zip(dl.COUNTS, dl.count("A b! 42 | é\nA b! 42 | é\n".encode())))
    assert (s["n_bare_words"], s["n_top_word"], s["n_distinct_words"], s["n_lines"], s["n_upper"], s["n_digits"], s["n_marks"]) == (4, 2, 5, 3, 2, 4, 4)
    assert dl.count("a b c a b c a".encode())[4] == 7 and dl.count(b"x y z")[4] == 0 and dl.count(b"x x x x")[4] == 4


def test_verdicts_on_held_out_documents(spark):
    out = entry.queries()["op12_quality_rules"](spark, SF).toPandas().set_index("doc_id")
    assert len(out) == 1000
    assert (out.base_failed == ((out.n_words < 50) | (100 * out.n_repeat_words > 50 * out.n_words))).all()
    assert not (out.kept & out.base_failed).any() and (out.kept == ~(out.base_failed | out.rule.notna())).all()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id").quality
    test = out[[zlib.crc32(str(i).encode()) % 5 == 0 for i in out.index] & out.index.isin(labels.index) & ~out.base_failed]
    y = labels[test.index].to_numpy()
    assert (test.kept.to_numpy() == (y == 1)).mean() > 0.95 and test.kept.to_numpy()[y == 1].mean() > 0.98


def test_covering_finds_planted_rules():
    rng = np.random.default_rng(1)
    x = rng.random((4000, len(dl.FEATURES)))
    names = list(dl.FEATURES)
    a, b = names.index("upper_case"), names.index("digits")
    bad = (x[:, a] >= 0.9) | ((x[:, b] < 0.2) & (x[:, a] >= 0.5))
    found = dl.cover(x, bad)
    assert 1 < len(found.rules) <= 8 and {t.feature for r in found.rules for t in r} <= {"upper_case", "digits"}
    assert ((found.first(x) >= 0) == bad).mean() > 0.99
    noise = dl.cover(x, rng.random(4000) < 0.3)
    assert (noise.first(x) >= 0).mean() < 0.05  # nothing precise to learn


def test_expression_equals_the_list(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    rules = dl.learn(df, labels, dl.Settings(least=1, precision=0.8))
    assert rules.rules
    rows = dl.judge(df, rules).select("rule", "base_failed", *[f(dl.F.col("stats")).alias(k) for k, f in dl.FEATURES.items()]).collect()
    first = rules.first(np.array([[r[k] for k in dl.FEATURES] for r in rows]))
    assert [r["rule"] for r in rows] == [" and ".join(map(str, rules.rules[i])) if i >= 0 and not r["base_failed"] else None for i, r in zip(first, rows)]


def test_odd_rows(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1), (4, 0), (4, 1), (6, None), (None, 1), (99, 0), (7, 0)], "doc_id bigint, quality int")
    for df, lab in ((docs, labels), (docs, labels.filter("false")), (empty, labels), (docs.withColumn("stats", dl.F.lit(1)).withColumn("rule", dl.F.lit(2)), labels)):
        out = dl.judge(df, dl.learn(df, lab))
        assert out.count() == df.count() and out.columns[-4:] == ["stats", "base_failed", "rule", "kept"]
    assert dl.judge(docs.withColumn("a b.c", dl.F.lit(1)), dl.DecisionList()).filter("`a b.c` = 1").count() == docs.count()
    assert {r["kept"] for r in dl.judge(docs, dl.DecisionList()).filter("doc_id = 7 or text is null").collect()} == {False}
