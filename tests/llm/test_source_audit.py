import re
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import source_audit as sa
from tests.conftest import SF_SMALL


def terms_of(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)


def plain_audit(rows, min_docs, top):
    """The result from its definition: dense counts, exact fractions."""
    rows = [(a or "", b or "", terms_of(t)) for a, b, t in rows]
    out = set()
    for lang in {a for a, _, _ in rows}:
        docs, n = Counter(), defaultdict(Counter)
        for a, b, words in rows:
            if a == lang:
                docs.update(set(words))
                n[b].update(words)
        kept = [w for w, k in docs.items() if k >= min_docs]
        v = len(kept)

        def share(count):
            total = sum(count[w] for w in kept)
            return {w: 1 + (Fraction(10**9 * (count[w] + 2), total + 2 * v).__floor__()) for w in kept}
        p = {b: share(n[b]) for b in n}
        q = share(sum(n.values(), Counter()))
        f = lambda x, y: Fraction((x - y) ** 2, x + y).__floor__()
        for b in n:
            pairs = [(sum(f(p[b][w], p[c][w]) for w in kept), c) for c in n if c != b]
            best = [(f(p[b][w], q[w]), w) for w in kept if n[b][w] and p[b][w] > q[w]]
            for part, found, most in (("pair", pairs, len(n)), ("term", best, top)):
                for i, (x, item) in enumerate(sorted(found, key=lambda r: (-r[0], r[1].encode()))[:most]):
                    out.add((lang, b, part, item, x, i + 1))
    return out


@pytest.mark.parametrize("min_docs,top", [(10, 10), (2, 3), (1, 100000)])
def test_against_brute_force(spark, min_docs, top):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("lang", "source", "text").repartition(3)
    rows = [tuple(r) for r in df.collect()]
    got = sa.audit(df, min_docs=min_docs, top=top).collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == plain_audit(rows, min_docs, top)


def test_odd_rows(spark, docs, empty):
    rows = [tuple(r) for r in docs.select("lang", "source", "text").collect()]
    for min_docs in (1, 2, 10):
        got = sa.audit(docs.withColumn("n", sa.F.lit(1)).withColumn("key", sa.F.lit("x")), min_docs=min_docs)
        assert {tuple(r) for r in got.collect()} == plain_audit(rows, min_docs, 10)
    assert sa.audit(empty).count() == 0 and sa.audit(empty).columns == ["lang", "source", "part", "item", "value", "rank"]


@pytest.mark.parametrize("slice_rows", [1, 3, 50, 10**6])
@pytest.mark.parametrize("min_docs", [1, 2, 4, 50])
def test_pieces_change_nothing(slice_rows, min_docs):
    """Documents counted in several flushes, and chunks cut in pieces of any size, give
    every term's exact sums, and its exact documents wherever no chunk proves enough."""
    rng = np.random.default_rng(5)
    words = ["a", "A", "a,", "b-a", "b", "b's", "c.c.c", "42", "é", "É!", "x" * 40]
    docs = [(f"l{i % 2}", f"s{i % 3}", " ".join(rng.choice(words, rng.integers(0, 6), p=[.3, .2, .1, .1, .1, .05, .03, .02, .04, .03, .03])), i) for i in range(60)]
    batches, held = [], sa._Chunks(min_docs)
    for i, (lang, source, text, key) in enumerate(docs):
        held.add(lang, source, text.encode(), key)
        if i % 17 == 16:
            batches += held.flush()
    batches += held.flush()
    t = pa.Table.from_batches(batches).sort_by([("chunk", "ascending"), ("place", "ascending")])
    state, out, rest = sa._Terms(min_docs), [], t.slice(0, 0)
    for a in range(0, t.num_rows, slice_rows):
        piece = pa.concat_tables([rest, t.slice(a, slice_rows)]).combine_chunks()
        rows, rest = state.rows(piece, a + slice_rows >= t.num_rows)
        assert rest.num_rows < min_docs
        out.append(rows)
    n, seen, proved = Counter(), defaultdict(set), set()
    for r in pa.concat_tables(out).to_pylist():
        if r["source"] is not None:
            n[r["lang"], r["term"], r["source"]] += r["n"]
        elif r["key"] is None:
            proved.add((r["lang"], r["term"]))
        else:
            seen[r["lang"], r["term"]].add(r["key"])
    want, holders = Counter(), defaultdict(set)
    for lang, source, text, key in docs:
        for w in terms_of(text):
            want[lang, w, source] += 1
            holders[lang, w].add(key)
    assert n == want
    frequent = {k for k, v in holders.items() if len(v) >= min_docs}
    assert proved | {k for k, v in seen.items() if len(v) >= min_docs} == frequent
    assert all(seen[k] == holders[k] for k in holders if k not in proved)
