import re

import numpy as np
import pytest
import xxhash

from tessera.llm import embedding_dedup, simhash, substring_dedup
from tessera.llm.components import components
from tests.conftest import SF_SMALL


def groups(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_components(spark):
    rng = np.random.default_rng(1)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (170, 2))] + [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 560)]
    want = groups(600, pairs)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame([*pairs, (None, 3)], "u bigint, v bigint")).collect()}
    assert got == {i: want[i] for p in pairs for i in p if p[0] != p[1]} | {a: want[a] for a, b in pairs if a == b and a in got}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


# -- SimHash

def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), seed=42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints(spark, docs):
    for r in simhash.fingerprints(docs).join(docs.select("doc_id", "text").distinct(), "doc_id").collect():
        assert r["fp"] % 2**64 == fingerprint(r["text"])


@pytest.mark.parametrize("leaf,most,step", [(2048, 16384, 4), (8, 20, 3), (1, 2, 5)])
def test_trie_join_against_brute_force(spark, leaf, most, step):
    rng = np.random.default_rng(11)
    base = rng.integers(0, 2**64, 40, dtype=np.uint64)
    near = [b ^ (np.uint64(1) << np.uint64(x)) ^ (np.uint64(1) << np.uint64(y)) for b in base[:20] for x, y in rng.integers(0, 64, (6, 2))]
    ball = [base[0] ^ np.uint64(x) for x in range(64)]  # a crowded subtree
    top = [base[1] ^ (np.uint64(x) << np.uint64(58)) for x in range(64)]
    fp = np.unique(np.concatenate([base, near, ball, top, np.array([0, 2**64 - 1, 1], np.uint64)]))
    pairs = [(i, j) for i in range(len(fp)) for j in np.flatnonzero(np.bitwise_count(fp ^ fp[i]) <= 2) if j > i]
    x, y = simhash.trie_pairs(fp, None, 2)
    assert sorted(zip(x.tolist(), y.tolist())) == sorted((i, int(j)) for i, j in pairs)
    x, y = simhash.trie_pairs(fp[::2], fp[1::2], 2)
    assert sorted(zip(x.tolist(), y.tolist())) == [(i, j) for i in range(len(fp[::2])) for j in range(len(fp[1::2])) if np.bitwise_count(fp[::2][i] ^ fp[1::2][j]) <= 2]
    want = groups(len(fp), pairs)
    df = spark.createDataFrame([(int(v),) for v in fp.view(np.int64)], "fp bigint")
    place = {int(v): i for i, v in enumerate(fp.view(np.int64))}
    got = {}
    for r in components(simhash.links(df, 2, leaf, most, step)).collect():
        got.setdefault(r["component"], set()).add(place[r["node"]])
    sets = {}
    for i, c in enumerate(want):
        sets.setdefault(c, set()).add(i)
    assert sorted(map(sorted, got.values())) == sorted(sorted(s) for s in sets.values() if len(s) > 1)


def test_near_copies(spark, docs, empty):
    out = simhash.near_duplicates(docs).collect()
    assert len(out) == docs.count()
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], set()).add((r["fp"], r["component_id"]))
    assert by[2] == by[3] == by[8] == {(0, 2)}  # null, empty and blank texts
    assert {c for _, c in by[4] | by[5]} == {4}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted(str(r["doc_id"]) for r in kept.collect())
    assert ids == sorted(["1", "2", "4", "6", "7", "None"])
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0


# -- embeddings

def linked(rows, cosine=0.95):
    ok = lambda v: v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    pairs, n = [], [0] * len(rows)
    for i, (a, v) in enumerate(rows):
        for j in range(i):
            w = rows[j][1]
            if ok(v) and ok(w) and a is not None and rows[j][0] is not None and len(v) == len(w):
                x, y = np.array(v, float), np.array(w, float)
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= cosine:
                    pairs.append((j, i))
                    n[i] += 1
                    n[j] += 1
    return n, groups(len(rows), pairs)


def test_embeddings_against_brute_force(spark):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(6, 16))
    x = [list(map(float, centre[rng.integers(0, 6)] * rng.uniform(0.5, 3) + rng.normal(size=16) * rng.choice([0.05, 0.2, 0.6, 1.5]))) for _ in range(500)]
    x += [x[0]] * 5 + [[0.0] * 16, None, [], [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0, 3.0], [1.0, 2.0, 3.1], [2.0] * 16]
    rows = [(i * 3 % 1009, v) for i, v in enumerate(x)] + [(None, x[1])]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0))
    df = spark.createDataFrame([(*r, 1, 0.5) for r in rows], "vec_id bigint, embedding array<double>, n int, rep double")
    n, comp = linked(rows)
    s = embedding_dedup.Settings(per_list=20, block=32, words=16, parts=4)
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(df, s=s).collect()}
    assert len(got) == len(rows)
    for (i, _), links, c in zip(rows, n, comp):
        r = got[i]
        want = (links, rows[c][0], i is not None and rows[c][0] == i)
        assert (r["n_links"], r["component_id"], r["kept"]) == want, i
    assert embedding_dedup.near_duplicates(df.filter("false")).count() == 0
    only = embedding_dedup.near_duplicates(df.filter("embedding is null")).collect()
    assert [(r["n_links"], r["kept"]) for r in only] == [(0, True)]


def test_probes_and_codes_lose_nothing(spark):
    """Recall against brute force on the given vectors with noisy copies of some."""
    e = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").toPandas()
    x = np.array(e.embedding.tolist(), float)
    rng = np.random.default_rng(2)
    x = np.concatenate([x, *[x[:150] + rng.normal(size=(150, x.shape[1])) * s for s in (0.01, 0.03, 0.04, 0.05)]])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    u = x / np.linalg.norm(x, axis=1)[:, None]
    want = ((u @ u.T) >= 0.95).sum(1) - 1
    got = embedding_dedup.near_duplicates(df, s=embedding_dedup.Settings(per_list=8)).collect()
    assert want.sum() > 500 and all(want[r["vec_id"]] == r["n_links"] for r in got)  # recall 1


# -- substrings

def cleaned(rows, w):
    """(kept bytes, spans) per row; rows sorted by (id, nulls last)."""
    seen, out, whole = {}, [], {}
    for i, t in rows:
        b = (t or "").encode()
        if (i, b) in whole:
            out.append(whole[(i, b)])
            continue
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - w + 1):
            if b[p:p + w] in seen:
                gone[p:p + w] = True
            else:
                seen[b[p:p + w]] = 1
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        whole[(i, b)] = (kept, int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()))
        out.append(whole[(i, b)])
    return out


@pytest.mark.parametrize("hot", [50_000, 3])
def test_substrings_against_brute_force(spark, hot):
    rng = np.random.default_rng(9)
    base = ["".join(rng.choice(list("abc dé\n"), n)) for n in rng.integers(50, 400, 8)]
    rows = []
    for i in range(120):
        t = "".join(base[rng.integers(0, 8)][rng.integers(0, 60):] for _ in range(rng.integers(0, 4)))
        t += "He is " * int(rng.integers(0, 60)) * (rng.random() < 0.2) + "z" * int(rng.integers(0, 300)) * (rng.random() < 0.2)
        rows.append((i, t if rng.random() < 0.95 else None))
    rows += [(200, rows[5][1]), (201, rows[5][1]), (None, rows[6][1])]
    df = spark.createDataFrame([(*r, 7) for r in rows], "doc_id bigint, text string, n_bytes int").repartition(7)
    got = {r["doc_id"]: r for r in substring_dedup.remove_repeats(df, hot=hot, bucket=40).collect()}
    for (i, t), (kept, n) in zip(rows, cleaned(rows, 100)):
        r = got[i]
        assert (bytes(r["kept"]), r["n_spans"], r["n_bytes"], r["n_removed"]) == (kept, n, len((t or "").encode()), len((t or "").encode()) - len(kept)), i


def test_substring_plan_is_the_same_past_the_broadcast_bound(spark, monkeypatch):
    """With no side table small enough to be broadcast, the bytes of the stretches meet no
    join, the text moves once in its row, and rows are the same."""
    from tessera.llm import common
    monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    rng = np.random.default_rng(4)
    base = ["".join(rng.choice(list("abc dé"), 300)) for _ in range(6)]
    rows = [(i, "".join(base[rng.integers(0, 6)][rng.integers(0, 90):] for _ in range(rng.integers(0, 4)))) for i in range(60)]
    df = spark.createDataFrame([*rows, (70, rows[3][1])], "doc_id bigint, text string")
    _, runs = substring_dedup.removals(df, hot=3)
    plan = runs._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and not [x for x in plan.splitlines() if "Join" in x and "anchor" in x]
    out = substring_dedup.remove_repeats(df, hot=3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if re.search(r"Exchange|Join", x) and re.search(r"\btext#", x)]
    got = {r["doc_id"]: bytes(r["kept"]) for r in out.collect()}
    assert [got[i] for i, _ in [*rows, (70, "")]] == [kept for kept, _ in cleaned([*rows, (70, rows[3][1])], 100)]


def test_anchor_filter_holds_every_anchor_and_few_others(spark, monkeypatch):
    rng = np.random.default_rng(2)
    anchors = np.unique(rng.integers(0, 1 << 38, 20_000))
    for most, others in ((32 << 20, 0.03), (1 << 14, 0.5)):  # as wanted, and full to its bound
        monkeypatch.setattr(substring_dedup, "FILTER_BYTES", most)
        held = substring_dedup.anchor_filter(spark.createDataFrame([(int(a),) for a in anchors], "anchor bigint"), len(anchors))
        assert held.nbytes <= most and substring_dedup.passes(held, anchors).all()
        rest = np.setdiff1d(rng.integers(0, 1 << 38, 20_000), anchors)
        assert substring_dedup.passes(held, rest).mean() < others
    empty = substring_dedup.anchor_filter(spark.createDataFrame([], "anchor bigint"), 0)
    assert not substring_dedup.passes(empty, anchors).any() and len(substring_dedup.passes(empty, anchors[:0])) == 0


def test_substring_edge_cases(docs, empty):
    rows = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=lambda r: (r[0] is None, r[0] or 0))
    small = [r for r in rows if r[0] != 7]
    expected = {}
    for (i, _), (kept, _) in zip(small, cleaned(small, 100)):
        expected.setdefault(i, kept)
    got = substring_dedup.remove_repeats(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] == 7:  # one period stays with what overlaps no earlier start
            assert r["n_removed"] == 150000 - 5 and r["n_spans"] == 1
        else:
            assert bytes(r["kept"]) == expected[r["doc_id"]], r["doc_id"]
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_matching_statistics_against_substrings():
    """Texts that are not in the index: what it holds of them, mismatches and unknown symbols included."""
    rng = np.random.default_rng(1)
    for w in (8, 10, 13, 40, 100):
        for _ in range(25):
            base = ["".join(rng.choice(list("abc"), rng.integers(3 * w // 2, 4 * w))).encode() for _ in range(4)]

            def text():
                t = b"".join(base[rng.integers(0, 4)][rng.integers(0, w):][:rng.integers(1, 4 * w)] for _ in range(rng.integers(1, 4)))
                return t + b"q" * int(rng.integers(0, w * 2)) * (rng.random() < 0.2)
            held, others = [text() for _ in range(rng.integers(1, 8))], [text() for _ in range(8)] + [b"", b"zz" * w]
            others.append(held[0])
            index, there = substring_dedup.RunIndex(held, w), {t[i:i + w] for t in held for i in range(len(t) - w + 1)}
            assert index.matched(others).tolist() == [t[i:i + w] in there for t in others for i in range(len(t) - w + 1)]
            seen, late = set(), []
            for t in held:
                for i in range(len(t) - w + 1):
                    late.append(t[i:i + w] in seen)
                    seen.add(t[i:i + w])
            assert index.marks().tolist() == late


def test_repetitive_texts_have_few_runs_and_are_indexed_once(monkeypatch):
    """4,000 copies of a passage with one changed byte each: runs far fewer than symbols, and of the
    stretches with one anchor only the first few go into an index, the rest are streamed."""
    rng = np.random.default_rng(2)
    passage = bytes(rng.integers(97, 123, 160, np.uint8))
    texts = []
    for _ in range(4000):
        t = bytearray(passage)
        t[rng.integers(0, 8)] = 65 + rng.integers(0, 3)  # only the first windows differ, in 24 ways
        texts.append(bytes(t))
    index = substring_dedup.RunIndex(texts[:1000], 100)
    assert len(index.start) * 20 < len(index.data)
    held, build = [], substring_dedup.RunIndex.__init__
    monkeypatch.setattr(substring_dedup.RunIndex, "__init__", lambda self, t, w: (held.append(len(t)), build(self, t, w))[1])
    n = len(texts)
    rows, start, end = substring_dedup.bucket_marks(np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, bool), texts, 100)
    assert sum(held) <= 24
    gone = {int(r): [] for r in rows}
    for r, s, e in zip(rows.tolist(), start.tolist(), end.tolist()):
        gone[r] += range(s, e)
    for i, (kept, _) in enumerate(cleaned(list(enumerate(t.decode() for t in texts)), 100)):
        assert bytes(np.delete(np.frombuffer(texts[i], np.uint8), sorted(set(gone.get(i, []))))) == kept


def test_recall_of_the_default_probes(spark):
    """20,000 vectors, 157 lists: the given ones and noisy copies about the threshold."""
    e = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").toPandas()
    x = np.array(e.embedding.tolist(), float)
    rng = np.random.default_rng(6)
    noise = [x + rng.normal(size=x.shape) * s * np.linalg.norm(x, axis=1)[:, None] / 8 for s in np.linspace(0.05, 0.4, 9)]
    x = np.concatenate([x, *noise])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    u = x / np.linalg.norm(x, axis=1)[:, None]
    want = np.concatenate([((u[a:a + 2000] @ u.T) >= 0.95).sum(1) - 1 for a in range(0, len(u), 2000)])
    got = np.zeros(len(x), int)
    for r in embedding_dedup.near_duplicates(df).collect():
        got[r["vec_id"]] = r["n_links"]
    assert want.sum() > 20_000 and (got <= want).all() and got.sum() >= 0.99 * want.sum(), got.sum() / want.sum()
