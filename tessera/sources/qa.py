"""Q&A record sources.

Raw records come out as ``idx BIGINT, value VARIANT`` so that non-objects,
numbers and nulls survive to validation (V1) with their JSON type intact.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.ordering import bucket_scan, bucketed, global_rank
from tessera.session import cut_lineage

# a JSON string, or one structural character; a lone quote opens a string that goes on
_STRUCTURE = re.compile(r'"(?:[^"\\]|\\.)*"|[\[\]{},"]', re.S)
_STRING_END = re.compile(r'(?:[^"\\]|\\.)*"', re.S)
_QUOTE = re.compile(r'\\.|"', re.S)
_BLANK = " \t\r\n\ufeff"


@contextmanager
def _last_key_wins(spark: SparkSession):
    """JSON objects may repeat a key; the last value counts, as in the reference. The
    setting is read when a parsing expression is made, so it is put back at once."""
    key = "spark.sql.variant.allowDuplicateKeys"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _marks(text: str, inside: bool) -> Iterator[re.Match]:
    """Structural characters of ``text``, which starts inside or outside a string."""
    at = 0
    if inside:
        end = _STRING_END.match(text)
        if end is None:
            return
        at = end.end()
    for m in _STRUCTURE.finditer(text, at):
        if m[0] == '"':
            return
        if len(m[0]) == 1:
            yield m


def _outline(text: str, inside: bool) -> tuple[int, list[tuple[int, int]]]:
    """Change of nesting over a piece of text and its commas by nesting relative to its start."""
    depth, commas = 0, {}
    for m in _marks(text, inside):
        if m[0] == ",":
            commas[depth] = commas.get(depth, 0) + 1
        else:
            depth += 1 if m[0] in "[{" else -1
    return depth, list(commas.items())


def _cut(text: str, depth: int, inside: bool) -> tuple[list[str], bool]:
    """Parts of a piece of text that starts at nesting ``depth``, cut at the commas of the
    top array, whose own brackets go; and whether nothing else stands outside the array.
    The brace added to a file's last piece, below the array, closes nothing and ends it."""
    parts, at, sound, part, ended = [], 0, depth >= 0, "", False
    for m in _marks(text, inside):
        c = m[0]
        if c in "[{":
            if depth == 0:
                sound &= c == "[" and not ended and not text[at:m.start()].strip(_BLANK)
                at = m.end()
            depth += 1
        elif c in "]}":
            depth -= 1
            if depth == 0:
                sound, ended = sound and c == "]", True
                part += text[at:m.start()]
                at = m.end()
            elif depth == -1:
                sound &= c == "}" and m.end() == len(text) and not text[at:m.start()].strip(_BLANK)
                at = m.end()
        elif c == "," and depth == 1:
            parts.append(part + text[at:m.start()])
            part, at = "", m.end()
    if depth == 0:
        sound &= not text[at:].strip(_BLANK)
    elif depth > 0:
        part += text[at:]
    return [*parts, part], sound


def _array_elements(spark: SparkSession, pieces: DataFrame) -> DataFrame:
    """``_file, pos, text`` of the elements of files that hold one JSON array each.

    ``pieces`` are the files' texts cut after every closing brace (the reader's record
    separator), so a large file is split over tasks whether it has line breaks or not.
    What a piece does to the nesting depends on whether it starts inside a string, so
    both are worked out where the piece is; the running number of quotes before it tells
    which holds. The nesting is then a running sum, an element's number the running count
    of commas at the array's own level, and the parts of an element that spans pieces
    are put together again. The working set of a task is a piece, and of a group one element.
    """
    pairs = pa.map_(pa.int64(), pa.int64())

    def outline(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("value").to_pylist()
            quotes = pa.array([sum(m[0] == '"' for m in _QUOTE.finditer(t)) % 2 for t in texts], pa.int64())
            out, within = ([_outline(t, inside) for t in texts] for inside in (False, True))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, quotes, *(pa.array([o[0] for o in x], pa.int64()) for x in (out, within)), *(pa.array([o[1] for o in x], pairs) for x in (out, within))],
                [*batch.schema.names, "quotes", "d0", "d1", "c0", "c1"])

    order = ["_file", "_blk", "_row"]
    found = pieces.mapInArrow(outline, "_file string, _blk bigint, _row bigint, size bigint, value string, quotes bigint, "
                                       "d0 bigint, d1 bigint, c0 map<bigint,bigint>, c1 map<bigint,bigint>")
    b = bucketed(found, order)
    # the scans carry no text; it is joined back by place
    marks = bucket_scan(b.withColumn("bytes", F.octet_length("value")).drop("value"), F.col("quotes"), "sum", "before", ["_file"], exclusive=True)
    inside = F.col("before") % 2 == 1
    marks = cut_lineage(marks.withColumns({"inside": inside, "delta": F.when(inside, F.col("d1")).otherwise(F.col("d0")),
                                           "commas": F.when(inside, F.col("c1")).otherwise(F.col("c0"))}).drop("d0", "d1", "c0", "c1"))
    sums = marks.groupBy("_file").agg(F.sum("delta").alias("open"), (F.sum("quotes") % 2).alias("quote"), (F.max("size") == F.sum("bytes")).alias("brace"))
    broken = sums.filter("open <> -1 or quote <> 0 or brace").first()
    if broken is not None:
        raise ValueError(f"malformed JSON in {broken['_file']}: brackets or strings are not closed")
    at = bucket_scan(marks, F.col("delta"), "sum", "depth", ["_file"], exclusive=True)
    at = at.withColumn("own", F.coalesce(F.try_element_at("commas", F.lit(1).cast("bigint") - F.col("depth")), F.lit(0).cast("bigint")))
    at = bucket_scan(at, F.col("own"), "sum", "first", ["_file"], exclusive=True)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, pos, text = [], [], []
            for i, (v, d, s, first) in enumerate(zip(batch.column("value"), *(batch.column(c).to_pylist() for c in ("depth", "inside", "first")))):
                parts, sound = _cut(v.as_py(), d, s)
                if not sound:
                    raise ValueError("malformed JSON: text outside the array of records")
                rows += [i] * len(parts)
                pos += range(first, first + len(parts))
                text += parts
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(take) for c in order), pa.array(pos, pa.int64()), pa.array(text, pa.string())], [*order, "pos", "text"])

    placed = b.select(*order, "value").join(at.select(*order, "depth", "inside", "first"), order)
    parts = placed.mapInArrow(cut, "_file string, _blk bigint, _row bigint, pos bigint, text string")
    whole = (parts.groupBy("_file", "pos").agg(F.array_sort(F.collect_list(F.struct("_blk", "_row", "text"))).alias("p"))
             .select("_file", "pos", F.array_join(F.transform("p", lambda x: x["text"]), "").alias("text")))
    # an empty array has one blank part and no element
    return whole.filter((F.col("pos") > 0) | (F.btrim("text", F.lit(_BLANK)) != ""))


def _bad_kind(kind):
    return ~(kind.startswith("ARRAY") | kind.startswith("OBJECT"))


def _elements(doc: DataFrame) -> DataFrame:
    """Elements of each top-level JSON document with their position.

    An array yields its elements; an object yields its keys as JSON strings
    (iterating a mapping gives its keys), which then fail validation at
    position 0. A scalar document is an error, as it is not a record list.
    """
    doc = doc.withColumn("_kind", F.expr("schema_of_variant(_doc)"))
    doc = doc.withColumn(
        "_doc",
        F.when(_bad_kind(F.col("_kind")), F.expr("raise_error('top-level JSON value is not a list of records')"))
        .otherwise(F.col("_doc")))
    view = f"_tessera_doc_{uuid.uuid4().hex}"
    doc.createOrReplaceTempView(view)
    exploded = doc.sparkSession.sql(
        f"SELECT d._file, d._kind, e.pos, e.key, e.value FROM {view} d, LATERAL variant_explode(d._doc) e")
    return exploded.select(
        "_file", "pos",
        F.when(F.col("_kind").startswith("OBJECT"),
               F.expr("parse_json(substring(to_json(array(key)), 2, length(to_json(array(key))) - 2))"))
        .otherwise(F.col("value")).alias("value"))


def read_qa(spark: SparkSession, path: str, fmt: str = "json_array") -> DataFrame:
    """Read Q&A records as ``idx BIGINT, value VARIANT``.

    * ``json_array``: each file is one JSON array (the reference's format) of any size,
      with or without line breaks; it is read in byte ranges by many tasks and cut
      into its elements. One element must fit in a task. Malformed JSON fails the
      job. A file whose value is no array is read whole and handled as a mapping.
    * ``json_lines``: one JSON value per line, splittable; ``idx`` is the position
      among the lines that are not blank, across files in path order. A malformed
      line gives a NULL value, which V1 rejects as ``malformed``.

    Repeated keys in an object are allowed; the last value counts.
    * ``parquet``: typed ``question``/``answer`` columns (and ``idx`` if
      present); they are wrapped as objects so that the same rules apply.

    A path that does not exist fails at ``read`` (S2), before any work.
    """
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_blk"),
             F.monotonically_increasing_id().alias("_row")]
    if fmt == "json_array":
        # records end at closing braces; the reader drops them, and one is added to a file's last piece
        raw = spark.read.option("lineSep", "}").text(path)
        pieces = raw.select(*place, F.col("_metadata.file_size").alias("size"), F.concat("value", F.lit("}")).alias("value"))
        first = (pieces.filter(F.btrim("value", F.lit(_BLANK)) != "").groupBy("_file")
                 .agg(F.min_by(F.substring(F.btrim("value", F.lit(_BLANK)), 1, 1), F.struct("_blk", "_row")).alias("c")))
        first = cut_lineage(first)
        others = first.filter(F.col("c") != "[").select("_file")
        mixed = not others.isEmpty()
        with _last_key_wins(spark):
            el = _array_elements(spark, pieces.join(others, "_file", "left_anti") if mixed else pieces)
            el = el.select("_file", F.col("pos").cast("int").alias("pos"), F.parse_json("text").alias("value"))
            if mixed:
                doc = (spark.read.text(path, wholetext=True)
                       .select(F.col("_metadata.file_path").alias("_file"), F.parse_json("value").alias("_doc")).join(others, "_file", "left_semi"))
                el = el.unionByName(_elements(doc))
            return global_rank(el, ["_file", "pos"], "idx").select((F.col("idx") - 1).alias("idx"), "value")
    if fmt == "json_lines":
        lines = spark.read.text(path).select(*place, "value").filter(F.btrim("value", F.lit(_BLANK)) != "")
        ranked = global_rank(lines, ["_file", "_blk", "_row"], "idx")
        with _last_key_wins(spark):
            return ranked.select((F.col("idx") - 1).alias("idx"), F.try_parse_json("value").alias("value"))
    if fmt == "parquet":
        df = spark.read.parquet(path)
        if "idx" not in df.columns:
            raise ValueError("parquet Q&A input needs an idx column for record order")
        return df.select(F.col("idx").cast("bigint"),
                         F.to_variant_object(F.struct("question", "answer")).alias("value"))
    raise ValueError(f"unknown Q&A format {fmt!r}")


def pairs_from_turns(turns: DataFrame) -> DataFrame:
    """(question, answer) pairs from a conversation table (S3).

    A ``user`` turn ``t`` followed by an ``assistant`` turn ``t + 1`` of the same
    conversation is one pair. The join key is (conv_id, turn), unique on both
    sides, so a very long conversation spreads over many tasks instead of
    landing in one window partition. ``idx`` is the 0-based position in
    (conv_id, turn) order.
    """
    u = turns.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    a = turns.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    # only the keys are ranked and written; the texts join their number afterwards
    keys = u.select("conv_id", "turn").join(a.select("conv_id", "turn"), ["conv_id", "turn"])
    ranked = global_rank(keys, ["conv_id", "turn"], "idx")
    pairs = ranked.join(u, ["conv_id", "turn"]).join(a, ["conv_id", "turn"])
    return pairs.select((F.col("idx") - 1).alias("idx"), "conv_id", "turn", "question", "answer")
