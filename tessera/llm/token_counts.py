"""Token counts per field, by offset-mapped attribution.

A record is rendered from its fields as a model will see it, and encoded once,
whole: encoding the fields one by one would give other tokens at their borders.
Every token has a character span in the rendered text; the spans are joined with
the fields' spans (sorted on both sides, so the interval join of a document is one
binary search), and a token that crosses a border goes where the rule says.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import col

RULES = ("start", "most", "share")
GLUE = "(template)"


def render(parts: Sequence[tuple[str | None, Column]]) -> tuple[Column, Column]:
    """(rendered text, sections). ``parts`` are (field name, text) in order; a name of
    None is template text, reported as ``(template)``. Sections are structs (name,
    start, end) in characters, end exclusive, and cover the text without gaps. A
    null field is empty."""
    texts = [F.coalesce(t.cast("string"), F.lit("")) for _, t in parts]
    sections, start = [], F.lit(0)
    for (name, _), text in zip(parts, texts):
        end = start + F.length(text)
        sections.append(F.struct(F.lit(GLUE if name is None else name).alias("name"), start.cast("int").alias("start"), end.cast("int").alias("end")))
        start = end
    return F.concat(*texts), F.array(*sections)


def encoder(path: str, pattern: str):
    """(encode, byte length of each id) of a byte-level BPE given as ranks."""
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
    size = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        size[rank] = len(token)
    enc = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return enc.encode_ordinary, size


def token_spans(text: str, ids: list[int], size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character and end (exclusive) of each token; a token that holds part of a
    character's bytes spans that character."""
    ends = np.cumsum(size[ids]) if ids else np.zeros(0, np.int64)
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    if text.isascii():
        return starts, ends
    raw = np.frombuffer(text.encode(), np.uint8)
    char = np.cumsum((raw & 0xC0) != 0x80) - 1  # of each byte
    return char[starts], char[ends - 1] + 1


def allocate(first: np.ndarray, end: np.ndarray, left: np.ndarray, right: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens per section and how many of its tokens cross a border.

    ``start``: a token belongs to the section of its first character. ``most``: to
    the section with most of its characters, the earlier of equals. ``share``: to
    every section it touches, by the share of its characters there.
    """
    k = len(left)
    own = np.searchsorted(right, first, "right")  # empty sections hold no character
    last = np.searchsorted(right, end - 1, "right")
    cross = np.flatnonzero(last > own)
    if rule == "start" or not len(cross):
        return np.bincount(own, minlength=k).astype(float), np.bincount(own[cross], minlength=k)
    count = np.bincount(np.delete(own, cross), minlength=k).astype(float)
    crossing = np.zeros(k, np.int64)
    for t in cross:  # at most one token a border
        at = np.arange(own[t], last[t] + 1)
        held = np.minimum(right[at], end[t]) - np.maximum(left[at], first[t])
        if rule == "most":
            count[at[held.argmax()]] += 1
            crossing[at[held.argmax()]] += 1
        else:
            count[at] += held / held.sum()
            crossing[at[held > 0]] += 1
    return count, crossing


def field_tokens(docs: DataFrame, parts: Sequence[tuple[str | None, Column]], path: str, pattern: str, id_col: str = "doc_id",
                 rule: str = "start") -> DataFrame:
    """``(doc_id, field, n_chars, n_tokens, n_crossing)``: one row per row of ``docs`` and
    distinct field name, in no order; ``n_tokens`` is a double (whole under ``start`` and ``most``).

    The counts of a row's fields add up to its number of tokens. Null and empty
    fields count 0. Ids may be null or repeated: every input row gives its rows. No
    rows give none. Columns that ``parts`` does not use are not read.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    text, sections = render(parts)
    src = docs.select(col(id_col).alias("doc_id"), text.alias("text"), F.transform(sections, lambda s: s["end"]).alias("ends"))
    names = [GLUE if n is None else n for n, _ in parts]
    fields = list(dict.fromkeys(names))
    slot = np.array([fields.index(n) for n in names])

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, size = encoder(path, pattern)
        for batch in batches:
            right = np.asarray(batch.column("ends").flatten()).reshape(-1, len(names)).astype(np.int64)
            left = np.concatenate([np.zeros((len(right), 1), np.int64), right[:, :-1]], 1)
            shape = (len(right), len(fields))
            chars, tokens, crossing = np.zeros(shape, np.int64), np.zeros(shape), np.zeros(shape, np.int64)
            for i, value in enumerate(batch.column("text")):
                t = value.as_py()
                first, end = token_spans(t, encode(t), size)
                n, c = allocate(first, end, left[i], right[i], rule)
                np.add.at(tokens[i], slot, n)
                np.add.at(crossing[i], slot, c)
                np.add.at(chars[i], slot, right[i] - left[i])
            rows = np.repeat(np.arange(shape[0]), shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows)), pa.array(fields * shape[0], pa.string()), pa.array(chars.ravel()),
                 pa.array(tokens.ravel()), pa.array(crossing.ravel())], ["doc_id", "field", "n_chars", "n_tokens", "n_crossing"])

    return src.mapInArrow(go, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, field string, n_chars bigint, n_tokens double, n_crossing bigint")
