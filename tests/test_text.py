"""P1, P3, P4 and word splitting against Python's own string methods."""

from pyspark.sql import functions as F

from tessera.functions.text import format_prompt, format_qa, format_template, split_words, strip_ws

SPACES = [chr(c) for c in range(0x110000) if chr(c).isspace()]


def test_whitespace_class_is_python_isspace(spark):
    # every character Python treats as whitespace, around "a", plus two that are not
    cases = [s + "a" + s for s in SPACES] + ["​a﻿", "  a b  ", "", "　", "x\ny"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i INT, s STRING")
    got = {r["i"]: r["t"] for r in df.select("i", strip_ws("s").alias("t")).collect()}
    assert got == {i: c.strip() for i, c in enumerate(cases)}


def test_split_words_is_python_split(spark):
    cases = ["a b", "  a　b\tc  ", "", "   ", "a​b c", "x\n\ny"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i INT, s STRING")
    got = {r["i"]: r["w"] for r in df.select("i", split_words("s").alias("w")).collect()}
    assert got == {i: c.split() for i, c in enumerate(cases)}


def test_templates(spark):
    df = spark.createDataFrame([(" What? ", " Yes.\nNo "), ("q", None)], "question STRING, answer STRING")
    rows = df.select(format_qa().alias("s"), format_qa(strip=False).alias("raw"),
                     format_prompt("question").alias("p")).collect()
    assert rows[0]["s"] == "Q: What? A: Yes.\nNo"
    assert rows[0]["raw"] == "Q:  What?  A:  Yes.\nNo "
    assert rows[0]["p"] == "Q:  What?  A:"
    assert rows[1]["s"] is None  # a missing field fails the record, as a missing key would
    one = spark.range(1).select(format_template("<{a}|{b}>", a=F.lit("x"), b=F.lit("y")).alias("t")).first()
    assert one["t"] == "<x|y>"


def test_split_words_is_one_pass_over_the_text(spark):
    words = spark.createDataFrame([("\u3000 a\u2003\u0085b \n", ), (None, )], "s STRING").select(split_words("s").alias("w"))
    assert "regexp_replace" not in words._jdf.queryExecution().optimizedPlan().toString()
    assert [r["w"] for r in words.collect()] == [["a", "b"], None]
