"""Packing token pieces into fixed-size sequences, shortest pack first.

1. Every document is tokenised once, whole, and cut into pieces of at most
   ``capacity`` ids.
2. The histogram of piece lengths (at most ``capacity`` entries, whatever the
   corpus) is packed on the driver: lengths longest first, each length going to
   the open packing patterns with the most room left. A pattern is a list of
   lengths with a count, so the work depends on the histogram, not on the rows.
3. Patterns are laid out as numbered sequences. Each (length, rank) slot then has
   a sequence and an offset; pieces of a length are ranked in distributed slices
   and look their slot up by rank.
"""

from __future__ import annotations

import heapq
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import boxed, col, cut_lineage, field, row_hash, row_schema, unboxed

CAPACITY = 4096
EOS = 2
RANK_BUCKETS = 256
PIECES = "doc_id {id}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"

_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(rf"(?!.*<\|)[{_LETTERS}0-9!-/:-@\[-`{{-~]+\Z")
_PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^{_LETTERS}0-9]+")
_LETTERS_ONLY = re.compile(rf"[{_LETTERS}]+\Z")  # one piece
_ODD_SPACE = ("\x1c", "\x1d", "\x1e", "\x1f")  # blank to str.split, not to the tokenizer


class WordIds(dict):
    """White-space-free chunk -> its ids as little-endian 32-bit bytes.

    The tokenizer drops white space and none of its rules crosses it, so a text's
    ids are the ids of its chunks. Chunks of ASCII and Latin-1 letters, digits and
    punctuation are cut by the tokenizer's own pattern and go straight to its BPE
    model; every other chunk goes through the whole tokenizer. Two generations of
    at most ``cap`` entries bound the memory and keep frequent words.
    """

    def __init__(self, path: str, cap: int = 300_000):
        super().__init__()
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.cap, self.old, self.pieces = self.tokenizer.model, cap, {}, {}
        to_bytes = self.tokenizer.pre_tokenizer[1]
        latin = [chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7)]
        self.spelt = str.maketrans({c: "".join(t for t, _ in to_bytes.pre_tokenize_str(c)) for c in latin})

    def _piece(self, p: str) -> bytes:
        ids = self.pieces.get(p)
        if ids is None:
            if len(self.pieces) >= self.cap:
                self.pieces.clear()
            found = [t.id for t in self.model.tokenize(p if p.isascii() else p.translate(self.spelt))]
            ids = struct.pack(f"<{len(found)}I", *found)
            self.pieces[p] = ids
        return ids

    def _chunk(self, w: str) -> bytes:
        if len(w) < 200 and _LETTERS_ONLY.match(w):
            return self._piece(w.lower())
        if len(w) < 200 and _PLAIN.match(w):
            return b"".join(map(self._piece, _PIECE.findall(w.lower())))
        return np.array(self.tokenizer.encode(w, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, w: str) -> bytes:
        ids = self.old.get(w)
        if ids is None:
            ids = self._chunk(w)
        if len(self) >= self.cap:
            self.old = dict(self)
            self.clear()
        if len(w) < 200:
            self[w] = ids
        return ids

    def encode(self, text: str) -> bytes:
        blank_like = any(c in text for c in _ODD_SPACE)
        chunks = re.split("[ \t\n\r]+", text) if blank_like else text.split()
        return b"".join([self[w] for w in chunks if w]) if blank_like else b"".join(map(self.__getitem__, chunks))


def token_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 eos: int = EOS, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece: the document's ids (then ``eos``) cut every ``capacity`` ids.

    Whole texts are encoded; a null text is empty and gives the end id alone, so
    every row gives at least one piece. Columns: doc_id, start, length, ids_crc32
    (of the little-endian 32-bit ids), doc_tokens, and ``ids`` binary if asked for.
    Ids may be null or repeated. Other columns are not read.
    """
    src = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    id_type = src.schema["doc_id"].dataType.simpleString()
    end = np.array([eos], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(tokenizer_path)
        for batch in batches:
            at, start, length, crc, total, ids = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                buf = words.encode(text.as_py() or "") + end
                n = len(buf) // 4
                for s in range(0, n, capacity):
                    part = buf[4 * s:4 * (s + capacity)]
                    at.append(i)
                    start.append(s)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    total.append(n)
                    if with_ids:
                        ids.append(part)
            cols = [batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                cols, names = [*cols, pa.array(ids, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(cols, names)

    return src.mapInArrow(cut, PIECES.format(id=id_type) + (", ids binary" if with_ids else ""))


def pack_histogram(counts: dict[int, int], capacity: int) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Packing patterns with their counts: ``[(((length, times), ...), count), ...]``.

    Lengths are placed longest first into the open patterns with the most room
    (the shortest packs); when none has room, new packs are opened and filled with
    as many pieces of that length as fit. A pattern that takes a length splits off
    only as many of its packs as are needed.
    """
    done: list[tuple[tuple, int]] = []
    room: list[tuple[int, int, tuple, int]] = []  # heap: (-space, order, pattern, packs)
    order = 0

    def put(space: int, pattern: tuple, packs: int) -> None:
        nonlocal order
        if packs and space:
            heapq.heappush(room, (-space, order, pattern, packs))
            order += 1
        elif packs:
            done.append((pattern, packs))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if room and -room[0][0] >= length:
                space, _, pattern, packs = heapq.heappop(room)
                space = -space
            else:
                space, pattern, packs = capacity, (), -(-left // (capacity // length))  # new packs, filled up
            times = min(space // length, max(1, -(-left // packs)))
            full = min(packs, left // times)
            put(space - times * length, (*pattern, (length, times)), full)
            left -= full * times
            rest = packs - full
            if rest and left and left < times:  # one pack takes what is left
                put(space - left * length, (*pattern, (length, left)), 1)
                rest, left = rest - 1, 0
            if pattern:
                put(space, pattern, rest)
    done += [(pattern, packs) for _, _, pattern, packs in room]
    return done


def lay_out(patterns: list, capacity: int) -> dict[int, np.ndarray]:
    """Per length: rows (first rank, first sequence, offset, times in a sequence), by rank."""
    slots: dict[int, list] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for pattern, packs in patterns:
        offset = 0
        for length, times in pattern:
            slots.setdefault(length, []).append((ranks.get(length, 0), sequence, offset, times))
            ranks[length] = ranks.get(length, 0) + times * packs
            offset += length * times
        sequence += packs
    return {k: np.array(v, np.int64) for k, v in slots.items()}


def pack(pieces: DataFrame, capacity: int = CAPACITY, buckets: int = RANK_BUCKETS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` (gapless from 0 in a sequence) to piece rows.

    ``pieces`` has ``length`` (1..capacity); all other columns are carried, whatever
    their names, but input columns called ``sequence_id`` or ``offset`` are replaced.
    Rows alike in all columns are interchangeable. An empty table gives no rows. The
    pieces are written once to the checkpoint folder, since they are read for the
    histogram and for the ranks. Ranks within a length are numbered in ``buckets`` hash
    slices: a length that holds a third of all rows (whole pieces, say) is never in one task.
    """
    rows = boxed(cut_lineage(pieces))
    hashed = rows.select("row", field("length").cast("bigint").alias("n"), row_hash(rows, 42).alias("u"))
    hashed = hashed.withColumn("b", F.pmod("u", F.lit(buckets)))
    sliced = hashed.groupBy("n", "b").agg(F.count(F.lit(1)).alias("c"))
    counts = {int(r["n"]): int(r["c"]) for r in hashed.groupBy("n").agg(F.count(F.lit(1)).alias("c")).collect()}
    slots = lay_out(pack_histogram(counts, capacity), capacity)

    running = Window.partitionBy("n").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    before = sliced.select("n", "b", F.coalesce(F.sum("c").over(running), F.lit(0)).alias("before"))
    ranked = (hashed.withColumn("k", F.row_number().over(Window.partitionBy("n", "b").orderBy("u")))
              .join(before, ["n", "b"]).select("row", "n", (F.col("before") + F.col("k") - 1).alias("rank")))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("n").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            seq, off = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for n in np.unique(length):
                own, rows = length == n, slots[int(n)]
                first, base, start, times = rows[np.searchsorted(rows[:, 0], rank[own], "right") - 1].T
                i = rank[own] - first
                seq[own], off[own] = base + i // times, start + i % times * n
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(seq), pa.array(off)], ["row", "sequence_id", "offset"])

    out = ranked.mapInArrow(place, row_schema(ranked, "sequence_id bigint, offset bigint"))
    return unboxed(out, sequence_id=F.col("sequence_id"), offset=F.col("offset"))
