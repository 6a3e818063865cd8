"""Driver contract: entry() runs, and a sample of queries match their oracles at sf0.001."""

import duckdb
import pytest

from tests.conftest import SF_SMALL

import __spark_entry__ as E  # noqa: E402

FAST = ["s3_pairs_from_turns", "v1_classify_qa", "p1_strip_ws", "t2_word_counts", "d3_pack_windows",
        "d6_split_exact", "g4_top_p", "r3_early_stop", "t4_bpe_pair_counts", "l5_infer"]


def test_entry_smoke(spark):
    rows = E.entry(spark).collect()
    assert {r["split"] for r in rows} <= {"train", "val"} and rows


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", FAST)
def test_against_duckdb(spark, name):
    from tools.check_oracle import TABLES, rows_of
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    sp = E.queries()[name](spark, SF_SMALL).toPandas()
    dd = con.execute(E.oracle_sql()[name]).df()
    assert rows_of(sp) == rows_of(dd)
