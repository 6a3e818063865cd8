"""S1, S2, V1-V4 on the synthetic records of FIXTURES.md section 3."""

import json

import pytest

from tessera.operators.validate import assert_valid, classify_qa, quarantine, validation_report
from tessera.sources.qa import pairs_from_turns, read_qa

BAD = '[{"question":"a","answer":"b"}, "x", {"question":1,"answer":"b"}, {"question":" ","answer":"b"}, ' \
      '{"answer":"b"}, null, {"question":null,"answer":"b"}, [1]]'


def _write(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text, encoding="utf-8")
    return str(p)


def test_rule_order_and_first_bad_index(spark, tmp_path):
    raw = read_qa(spark, _write(tmp_path, "bad.json", BAD))
    got = {r["idx"]: r["error"] for r in classify_qa(raw).collect()}
    assert got == {0: None, 1: "not_object", 2: "not_string", 3: "empty", 4: "not_string",
                   5: "not_object", 6: "not_string", 7: "not_object"}
    with pytest.raises(ValueError, match=r"record 1 rejected \(not_object\)"):
        assert_valid(classify_qa(raw))
    good, bad = quarantine(classify_qa(raw))
    assert good.count() == 1 and bad.count() == 7
    rep = {r["outcome"]: (r["n_records"], r["first_idx"]) for r in validation_report(classify_qa(raw)).collect()}
    assert rep == {"ok": (1, 0), "not_object": (3, 1), "not_string": (3, 2), "empty": (1, 3)}


def test_empty_array_passes_and_object_fails_at_zero(spark, tmp_path):
    empty = read_qa(spark, _write(tmp_path, "empty.json", "[]"))
    assert_valid(classify_qa(empty))
    obj = read_qa(spark, _write(tmp_path, "obj.json", '{"question":"a","answer":"b"}'))
    with pytest.raises(ValueError, match=r"record 0 rejected \(not_object\)"):
        assert_valid(classify_qa(obj))


def test_malformed_json_fails(spark, tmp_path):
    with pytest.raises(Exception):
        read_qa(spark, _write(tmp_path, "broken.json", "[{")).collect()


def test_missing_path_fails_at_read(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        read_qa(spark, str(tmp_path / "nope.json"))


def test_embedded_newline_and_unicode_survive(spark, tmp_path):
    recs = [{"question": "　q\t", "answer": "a\nb"}, {"question": "x", "answer": "​"}]
    raw = read_qa(spark, _write(tmp_path, "nl.json", json.dumps(recs)))
    rows = sorted(classify_qa(raw).collect(), key=lambda r: r["idx"])
    assert rows[0]["answer"] == "a\nb" and rows[0]["error"] is None
    assert rows[1]["error"] is None  # U+200B is not whitespace


def test_json_lines_positions(spark, tmp_path):
    lines = "\n".join(json.dumps({"question": f"q{i}", "answer": f"a{i}"}) for i in range(50))
    raw = read_qa(spark, _write(tmp_path, "l.jsonl", lines), fmt="json_lines")
    got = {r["idx"]: r["question"] for r in classify_qa(raw).collect()}
    assert got == {i: f"q{i}" for i in range(50)}


def test_pairs_need_adjacent_assistant(spark):
    turns = spark.createDataFrame(
        [(1, 0, "system", "s"), (1, 1, "user", "u1"), (1, 2, "assistant", "a1"), (1, 3, "user", "u2"),
         (2, 0, "user", "v1"), (2, 1, "user", "v2"), (2, 2, "assistant", "b2")],
        "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    got = [(r["idx"], r["question"], r["answer"]) for r in pairs_from_turns(turns).orderBy("idx").collect()]
    assert got == [(0, "u1", "a1"), (1, "v2", "b2")]


def test_json_arrays_across_files_keep_file_then_position_order(spark, tmp_path):
    d = tmp_path / "many"
    d.mkdir()
    (d / "a.json").write_text(json.dumps([{"question": "a0", "answer": "x"}, {"question": "a1", "answer": "x"}]))
    (d / "b.json").write_text(json.dumps([{"question": "b0", "answer": "x"}]))
    got = [r["question"] for r in classify_qa(read_qa(spark, str(d))).orderBy("idx").collect()]
    assert got == ["a0", "a1", "b0"]


def test_array_split_by_lines_equals_a_parser(spark, tmp_path):
    recs = [{"question": f"q {i} [{{,]\" \\ é", "answer": "a, b] \n }" * (i % 4), "more": [1, [2, {"x": [i]}], "]"]} for i in range(40)]
    recs += ["text, with ]", 5, None, [1, [2]], {}, {"question": None, "answer": 3}]
    d = tmp_path / "arrays"
    d.mkdir()
    (d / "a.json").write_text(json.dumps(recs))  # one line
    (d / "b.json").write_text(json.dumps(recs, indent=2, ensure_ascii=False), encoding="utf-8")  # an element over many lines
    (d / "c.json").write_text("\n[\n\n]\n")
    (d / "d.json").write_text("[" + ",\n".join(map(json.dumps, recs)) + "\n]")
    (d / "e.json").write_text('{"k": 1, "l": [2]}')  # no array: its keys are its elements
    got = read_qa(spark, str(d)).selectExpr("idx", "to_json(value) v").collect()
    want = [json.dumps(json.loads(json.dumps(r))) for r in recs] * 3 + ['"k"', '"l"']
    assert [json.loads(r["v"]) for r in sorted(got, key=lambda r: r["idx"])] == [json.loads(w) for w in want]
    assert sorted(r["idx"] for r in got) == list(range(len(want)))


@pytest.mark.parametrize("text", ["[{", '[{"a": "x}]', "[1] 2", "[1]]", '[{"a": }]', "[1,]", "[1}"])
def test_malformed_arrays_fail(spark, tmp_path, text):
    with pytest.raises(Exception):
        read_qa(spark, _write(tmp_path, "broken.json", text)).selectExpr("to_json(value)").collect()


def test_json_lines_malformed_blank_and_repeated_keys(spark, tmp_path):
    text = '{"question":"a","answer":"b"}\n\n{"question":\n  \n{"question":"a","question":"c","answer":"b"}\nnot json\n'
    rows = classify_qa(read_qa(spark, _write(tmp_path, "l.jsonl", text), fmt="json_lines")).orderBy("idx").collect()
    assert [(r["idx"], r["error"], r["question"]) for r in rows] == [
        (0, None, "a"), (1, "malformed", None), (2, None, "c"), (3, "malformed", None)]
    assert spark.conf.get("spark.sql.variant.allowDuplicateKeys") == "false"


def test_no_text_is_written_to_rank_pairs(spark, monkeypatch):
    from tessera.operators import ordering
    seen = []
    monkeypatch.setattr(ordering, "cut_lineage", lambda df: seen.append(df.columns) or df.checkpoint())
    turns = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "a")], "conv_id bigint, turn bigint, role string, text string")
    assert [tuple(r) for r in pairs_from_turns(turns).collect()] == [(0, 1, 0, "q", "a")]
    assert seen and not any(c in ("question", "answer", "text") for cols in seen for c in cols)


def test_one_line_array_is_read_by_several_tasks(spark, tmp_path):
    """No line break at all; braces, quotes and backslashes inside strings; byte ranges of
    a few hundred bytes, so that ranges start in the middle of strings and escapes."""
    odd = ["}", "{", "}}{", '"', "\\", '\\"}', "]},[", "é}", "\n}", "a,b", "\\\\"]
    recs = [{"question": f"q{i} {odd[i % 11]}", "answer": odd[i * 7 % 11] * (i % 5), "more": {"k": [i, {"x": odd[i % 3]}]}} for i in range(400)]
    recs[5:5] = ["text } only", 3, None, [1, "}"], {}]
    path = _write(tmp_path, "one.json", json.dumps(recs))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "777")
    try:
        raw = spark.read.option("lineSep", "}").text(path)
        assert raw.rdd.getNumPartitions() > 20
        rows = read_qa(spark, path).selectExpr("idx", "to_json(value) v").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r["idx"] for r in sorted(rows)] == list(range(len(recs)))
    assert [json.loads(r["v"]) for r in sorted(rows)] == recs


@pytest.mark.parametrize("text", ['[{"a":"b"}', '[{"a":"b"}]}', '[{"a":"b}]', '[{"a":"b"}] x', '[{"a":"b"}][1]', 'x [{"a":"b"}]', '[{"a":"b"]}', '[{"a":1}}]'])
def test_malformed_arrays_of_one_line_fail(spark, tmp_path, text):
    with pytest.raises(Exception, match="(?i)malformed|not a list"):
        read_qa(spark, _write(tmp_path, "broken.json", text)).selectExpr("to_json(value)").collect()
