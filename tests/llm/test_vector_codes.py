import numpy as np
import pytest

from tessera.llm import vector_codes as vc


def plain_codes(vectors, words=64, parts=16, rounds=2):
    """The whole thing with every entry compared, in Python integers."""
    ints = [[int(np.floor(256 * float(c))) for c in v] for v in vectors]
    w = len(ints[0]) // parts
    cut = [[tuple(v[p * w:(p + 1) * w]) for p in range(parts)] for v in ints]
    books = [[c[p] for c in cut[:words]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            own = [nearest(c[p], books[p])[1] for c in cut]
            for i in range(len(books[p])):
                held = [c[p] for c, o in zip(cut, own) if o == i]
                if held:
                    books[p][i] = tuple(sum(x) // len(held) for x in zip(*held))
    last = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    return books, [bytes(i for _, i in r).hex() for r in last], [sum(d for d, _ in r) for r in last]


@pytest.mark.parametrize("spread,k,width", [(3, 64, 4), (500, 64, 4), (1, 40, 1), (2, 1, 3), (50, 300, 2)])
def test_orchard_finds_the_lowest_nearest_entry(spread, k, width):
    """Many ties and repeated entries: the walk gives what comparing with all entries gives."""
    rng = np.random.default_rng(spread)
    entries, x = rng.integers(-spread, spread + 1, (k, width)), rng.integers(-2 * spread, 2 * spread + 1, (700, width))
    d = ((x[:, None] - entries[None]) ** 2).sum(2)
    at, best = vc.Codebook(entries).nearest(x)
    assert np.array_equal(at, d.argmin(1)) and np.array_equal(best, d.min(1))


def test_codes_against_brute_force(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 1, (9, 32))
    vectors = [centres[i % 9] + rng.normal(0, 0.2, 32) for i in range(150)]
    vectors[40] = vectors[3]
    rows = [(i, [float(x) for x in v], i % 4 if i % 5 else None) for i, v in enumerate(vectors)]
    bad = [(900, None, 1), (901, [float("nan")] * 32, 1), (902, [None] + [1.0] * 31, 1), (903, [float("-inf")] + [1.0] * 31, 2)]
    df = spark.createDataFrame(rows[::-1] + bad, "vec_id bigint, embedding array<double>, label int").repartition(5)
    s = vc.Settings(words=20)
    coded, books = vc.compress(df, s=s)
    want_books, codes, errors = plain_codes(vectors, words=20)
    assert [[tuple(map(int, e)) for e in b] for b in books] == want_books
    got = {r["vec_id"]: (r["code"].hex(), r["error"]) for r in coded.collect()}
    assert got == {i: (codes[i], errors[i]) for i in range(150)}
    summed = {r["vec_id"]: r["total_error"] for r in vc.summed_by(coded, "error", "label", "total_error").collect()}
    for i, _, label in rows:
        assert summed[i] == sum(e for (_, _, x), e in zip(rows, errors) if x == label)
    back = vc.decode(bytes.fromhex(codes[7]), books, s)
    assert ((np.floor(256 * vectors[7]) - 256 * back) ** 2).sum() == pytest.approx(errors[7])


def test_odd_rows(spark):
    kind = "vec_id bigint, embedding array<float>, label int, row int, v string, code string, error int"
    rows = [(1, [0.5] * 16, None, 1, "x", "old", 3), (1, [0.5] * 16, None, 1, "x", "old", 3), (None, [0.25] * 16, 2, None, None, None, None),
            (2, None, 2, 1, None, "y", 1), (3, [0.0] * 16, 2, 1, None, "y", 1), (4, [0.5] * 7, 2, 1, None, "y", 1), (5, [], 2, 1, None, "y", 1)]
    df = spark.createDataFrame(rows, kind)
    coded, books = vc.compress(df)
    assert sorted(coded.columns) == sorted(df.columns) and [len(b) for b in books] == [6] * 16
    got = coded.collect()
    assert len(got) == 6 and {r["v"] for r in got if r["vec_id"] == 1} == {"x"} and all(r["error"] >= 0 for r in got)
    assert sorted(r["error"] for r in vc.summed_by(coded, "error", "label", "error").collect())[:2] == [0, 0]
    assert vc.compress(df.withColumnRenamed("embedding", "e.m b"), vec_col="e.m b")[0].count() == 6
    none, books = vc.compress(df.filter("false"))
    assert none.count() == 0 and vc.codebooks_sha256(books) == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    with pytest.raises(ValueError):
        vc.fit(spark.createDataFrame([(1, [1e30] * 16)], "vec_id bigint, embedding array<double>"))
