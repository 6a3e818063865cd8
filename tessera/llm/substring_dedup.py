"""Substring de-duplication with run-length (r-index) Burrows-Wheeler indexes.

Every byte that lies in a ``window``-byte string which also starts earlier in the
corpus is removed. Three steps make one global question many local ones:

1. Anchors. In every window the smallest hash of its ``GRAM``-byte substrings is its
   anchor; equal windows have equal anchors, whatever surrounds them. Consecutive
   windows with one anchor are a stretch: the bytes they cover. Anchors of one
   stretch only, in which no two windows can be equal, go.
2. Index. Stretches are dealt by anchor into buckets of bounded size. In a bucket the
   first stretch of each anchor, in corpus order, goes into a Burrows-Wheeler
   transform that is kept as runs: first row, symbol, LF target, and the text
   positions sampled at both ends of each run.
3. Matching statistics. The other stretches stream through that index from their
   ends to their starts. Where the symbol to be read is not the one before the
   current row, the match goes on at the end of the nearest run of that symbol that
   shares the longer context. Windows matched in full have an earlier start and are
   marked. What a stream still holds unmarked takes part in the next round, whose
   index takes ``GROW`` times as many stretches of each anchor; equal stretches share
   one stream. So repetitive text is streamed and never indexed, a stretch is indexed
   at most once, and the number of rounds is the logarithm of the most unlike
   stretches that one anchor has. Among the texts of
   one index, runs are also cut where the first ``window`` symbols change, and the
   earliest position of such pieces marks all later ones.

The repeated anchors go to the tasks as a Bloom filter of bounded size, so that only
stretches that may count are ever cut out and moved, once, to their buckets. The few
others that it lets through stand alone in a bucket, which marks nothing.

An anchor with more than ``HOT`` stretches (a passage in a great many texts) does not
go into a bucket: its windows are grouped by content hash in a plain aggregation,
which combines before the shuffle and gives the same marks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import boxed, col, cut_lineage, field, row_schema, small, unboxed

WINDOW = 100
GRAM = 32
HOT = 50_000
BUCKET = 5_000        # stretches in a bucket on average
GROW = 4              # how many times more stretches of an anchor the next round's index takes
SPAN = 1 << 20        # window starts looked at together
FILTER_BYTES = 32 << 20  # at most, of the filter of repeated anchors
PARTS = 256           # of that filter, each built by itself
_M = np.uint64(0xD6E8FEB86659FD93)
_LOW = np.uint64(SPAN - 1)
_TIE, _UNTIE = np.uint64(0x9E3B5), np.uint64(pow(0x9E3B5, -1, SPAN))


def stretches(text: bytes, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, number of windows, whether two of them can be equal) of each stretch of one text."""
    parts = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, bool)]
    for at in range(0, max(0, len(text) - window + 1), SPAN - window):
        piece = np.frombuffer(text, np.uint8, min(SPAN - 1, len(text) - at), at).astype(np.uint64)
        h, power, width = piece + np.uint64(1), int(_M), 1
        while width < GRAM:  # hashes of twice the width from hashes of the width
            h = h[:-width] * np.uint64(power) + h[width:]
            power, width = power * power % 2**64, 2 * width
        h = (h ^ h >> np.uint64(31)) * _M
        # high bits: the hash; low bits: a scrambled position, so that equal hashes tie at random
        key = ((h ^ h >> np.uint64(29)) & ~_LOW) | (np.arange(len(h), dtype=np.uint64) * _TIE & _LOW)
        width, need, single = 1, window - GRAM + 1, key
        while 2 * width <= need:
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        if need > width:
            key = np.minimum(key[:width - need], key[need - width:])
        key = key[:SPAN - window]
        first = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
        n = np.diff(np.concatenate([first, [len(key)]]))
        # equal windows d apart in one stretch need the anchor's bytes again d further on
        anchor, place = key[first] >> np.uint64(20), ((key[first] & _LOW) * _UNTIE & _LOW).astype(np.int64)
        apart = np.arange(1, need)
        again = single[np.minimum(place[:, None] + apart, len(single) - 1)] >> np.uint64(20) == anchor[:, None]
        again = (again & (apart < n[:, None])).any(1)
        parts = [np.concatenate([a, b]) for a, b in zip(parts, (anchor.astype(np.int64), first + at, n, again))]
    return tuple(parts)


def _probes(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits, of ``bits`` in a part of the filter, that stand for each key."""
    h = keys.astype(np.uint64) * _M
    h = (h ^ h >> np.uint64(29)) * _M
    return (h >> np.uint64(40)) % np.uint64(bits), (h >> np.uint64(16)) % np.uint64(bits)


def anchor_filter(repeated: DataFrame, n: int) -> np.ndarray:
    """Bloom filter of the ``n`` anchors of ``repeated``: a row of packed bits for each part.
    A part is built from its own anchors in one task; 16 bits an anchor, fewer past ``FILTER_BYTES``."""
    bits = min(FILTER_BYTES * 8, 1 << max(16, (16 * n - 1).bit_length())) // PARTS

    def build(table: pa.Table) -> pa.Table:
        anchors, on = table["anchor"].to_numpy(), np.zeros(bits, bool)
        for at in _probes(anchors, bits):
            on[at.astype(np.int64)] = True
        return pa.table({"part": pa.array([int(anchors[0]) % PARTS], pa.int64()), "bits": pa.array([np.packbits(on).tobytes()], pa.binary())})

    out = np.zeros((PARTS, bits // 8), np.uint8)
    for r in repeated.groupBy(F.pmod("anchor", F.lit(PARTS)).alias("part")).applyInArrow(build, "part bigint, bits binary").collect():
        out[r["part"]] = np.frombuffer(r["bits"], np.uint8)
    return out


def passes(filter_: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Whether each anchor may be one of the filter's; true for all that are."""
    part, held = anchors % PARTS, np.ones(len(anchors), bool)
    for at in _probes(anchors, filter_.shape[1] * 8):
        at = at.astype(np.int64)
        held &= (filter_[part, at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
    return held


def _sorted_ranks(high: np.ndarray, low: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order by (high, low, position) and where the pair changes."""
    n = len(high)
    if 3 * bits <= 63:
        key = np.sort((high << (2 * bits)) | (low << bits) | np.arange(n))
        order, pair = key & ((1 << bits) - 1), key >> bits
        return order, np.concatenate([[True], pair[1:] != pair[:-1]])
    order = np.lexsort((low, high))
    a, b = high[order], low[order]
    return order, np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])


class RunIndex:
    """Run-compressed Burrows-Wheeler transform of texts, in the given order.

    ``marks`` tells which windows of these texts have an earlier equal window among
    them; ``matched`` streams other texts and tells which of their windows it holds.
    """

    def __init__(self, texts: list[bytes], window: int):
        self.window, self.lengths = window, np.array([len(t) for t in texts], np.int64)
        # symbols: 0 ends a text, a byte is its value + 1; UTF-8 never has the byte 255
        data = np.frombuffer(b"\xff".join(texts) + b"\xff", np.uint8) + np.uint8(1)
        n = len(data)
        self.data, self.ends = data, np.flatnonzero(data == 0)
        to_end = self.ends[np.searchsorted(self.ends, np.arange(n))] - np.arange(n)
        self.shared: list[tuple[int, np.ndarray]] = []  # (width, rank of the first `width` symbols), narrow to wide
        order, same = self._suffix_array(data, to_end)
        symbol = data[order - 1]  # the symbol before each suffix; before the first text: an end
        # LF: rows keep their order within a symbol
        counts = np.bincount(symbol, minlength=256)
        start_of = np.cumsum(counts) - counts
        run = np.concatenate([[True], symbol[1:] != symbol[:-1]])
        self.start = np.flatnonzero(run)
        size = np.diff(np.concatenate([self.start, [n]]))
        self.symbol = symbol[self.start].astype(np.int64)
        # the text positions at both ends of each run: all that is kept of the suffix order
        self.first_at, self.last_at = order[self.start], order[self.start + size - 1]
        self.last = self.start + size - 1
        self.by_symbol = np.argsort(self.symbol, kind="stable")
        before = np.empty(len(self.start), np.int64)
        head = self.symbol[self.by_symbol]
        self.symbol_run = head * len(self.start) + self.by_symbol  # ascending: finds the next run of a symbol
        total = np.cumsum(size[self.by_symbol]) - size[self.by_symbol]
        first = np.concatenate([[True], head[1:] != head[:-1]])
        before[self.by_symbol] = total - total[np.flatnonzero(first)][np.cumsum(first) - 1]
        self.target = start_of[self.symbol] + before
        self.into = np.searchsorted(self.start, self.target, "right") - 1  # the run that the target is in
        # pieces: runs cut where the first `window` symbols change; their earliest positions
        self.repeats = bool(same.any())
        if self.repeats:
            self.piece = np.flatnonzero(run | ~same)
            earliest = np.minimum.reduceat(order, self.piece)
            group = (~same)[self.piece].cumsum() - 1
            least = np.full(int(group[-1]) + 1, n, np.int64)
            np.minimum.at(least, group, earliest)
            self.earliest = least[group]
            # the texts with windows that the index holds twice
            self.doubled = np.unique(np.searchsorted(self.ends, order[same | np.append(same[1:], False)]))

    def _suffix_array(self, data: np.ndarray, to_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix order (text ends compare by position) and which neighbours share ``window`` symbols."""
        n, width = len(data), 5
        bits = max(1, int(n).bit_length())
        longest = int(to_end.max()) + 1
        shared = None

        def advanced(x: np.ndarray, by: int) -> np.ndarray:
            out = np.zeros(n, x.dtype)
            if by < n:
                out[:n - by] = x[by:]
            return out

        high = np.zeros(n, np.int64)
        for j in range(width):
            high = (high << 8) | np.where(to_end >= j, advanced(data, j), 0)
        _, high = np.unique(high, return_inverse=True)
        low = np.zeros(n, np.int64)
        while True:
            order, change = _sorted_ranks(high, low, bits)
            change |= to_end[order] < width  # an end within reach: unlike every other suffix
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(change) - 1
            if width < self.window:
                self.shared.append((width, rank))
            if shared is None and 2 * width >= self.window:
                step = self.window - width
                if step <= 0:
                    raise ValueError("window is too short")
                shared = (rank, advanced(rank, step), width)
            if width >= longest or change.all():
                break
            high, low, width = rank, np.where(to_end >= width, advanced(rank, width) + 0, 0), 2 * width
        if shared is None:  # all suffixes differ before half a window
            return order, np.zeros(n, bool)
        a, b, _ = shared
        same = np.zeros(n, bool)
        x, y = order[:-1], order[1:]
        same[1:] = (a[x] == a[y]) & (b[x] == b[y]) & (to_end[x] >= self.window) & (to_end[y] >= self.window)
        return order, same

    def _left(self, k: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """LF step: (run, row) of the suffixes one symbol longer. The run is the target's or a few further on."""
        row, k = self.target[k] + row - self.start[k], self.into[k]
        over = np.flatnonzero(self.last[k] < row)
        for _ in range(8):
            if not len(over):
                return k, row
            k[over] += 1
            over = over[self.last[k[over]] < row[over]]
        k[over] = np.searchsorted(self.start, row[over], "right") - 1
        return k, row

    def _flags(self, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(one flag per window start of all texts, one after another; where each text's flags begin)."""
        n = np.maximum(0, lengths - self.window + 1)
        return np.zeros(int(n.sum()), bool), np.cumsum(n) - n

    def marks(self) -> np.ndarray:
        """For each window start, text by text: whether an equal window starts earlier."""
        flat, base = self._flags(self.lengths)
        live = self.doubled if self.repeats else np.zeros(0, np.int64)
        row = live.copy()  # the row of a text's end: ends sort first, by position
        k = np.searchsorted(self.start, row, "right") - 1
        for step in range(1, int(self.lengths.max(initial=0)) + 1):
            on = self.lengths[live] >= step
            if not on.all():
                live, k, row = live[on], k[on], row[on]
            if not len(live):
                break
            k, row = self._left(k, row)
            if step >= self.window:
                piece = np.searchsorted(self.piece, row, "right") - 1
                place = self.lengths[live] - step
                flat[base[live] + place] = self.earliest[piece] < self.ends[live] - step
        return flat

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many symbols the suffixes at ``x`` and ``y`` share, exact below a window and then at
        least a window less one; a suffix and itself give any number."""
        n, out = len(self.data), np.zeros(len(x), np.int64)
        x, y = x.copy(), y.copy()
        for width, rank in reversed(self.shared):
            step = np.where(rank[x] == rank[y], width, 0)
            x, y, out = np.minimum(x + step, n - 1), np.minimum(y + step, n - 1), out + step
        open_ = np.ones(len(x), bool)
        for j in range(self.shared[0][0] - 1):  # less than the narrowest width is left
            a = self.data[np.minimum(x + j, n - 1)]
            open_ &= (a == self.data[np.minimum(y + j, n - 1)]) & (a != 0)
            out += open_
        return out

    def matched(self, texts: list[bytes]) -> np.ndarray:
        """For each window start, text by text (these need not be in the index): whether the index holds that window.

        One step for all texts at a time prepends a symbol to each one's longest match
        (row, text position, length). A text is left as soon as its match ends before
        the first window does: no window further left can be held then.
        """
        window, runs = self.window, len(self.start)
        lengths = np.array([len(t) for t in texts], np.int64)
        data = np.frombuffer(b"".join(texts), np.uint8) + np.uint8(1)
        begin = np.cumsum(lengths) - lengths
        flat, base = self._flags(lengths)
        live = np.flatnonzero(lengths >= window)
        at, row, k = lengths[live], np.zeros(len(live), np.int64), np.zeros(len(live), np.int64)
        place, length = np.full(len(live), self.first_at[0]), np.zeros(len(live), np.int64)
        while len(live):
            at = at - 1
            symbol = data[begin[live] + at].astype(np.int64)
            off = np.flatnonzero(self.symbol[k] != symbol)
            lost = off[:0]
            if len(off):  # no match goes on from here: over to the nearest runs of the symbol, above and below
                wanted = symbol[off]
                i = np.searchsorted(self.symbol_run, wanted * runs + k[off])
                above, below = self.by_symbol[np.maximum(i - 1, 0)], self.by_symbol[np.minimum(i, runs - 1)]
                there = np.concatenate([place[off], place[off]])
                share = self.common(there, np.concatenate([self.last_at[above], self.first_at[below]]))
                up = np.where((i > 0) & (self.symbol[above] == wanted), share[:len(off)], -1)
                down = np.where((i < runs) & (self.symbol[below] == wanted), share[len(off):], -1)
                high = up >= down
                k[off] = np.where(high, above, below)
                row[off] = np.where(high, self.last[above], self.start[below])
                place[off] = np.where(high, self.last_at[above], self.first_at[below])
                best = np.maximum(up, down)
                length[off] = np.minimum(length[off], best)
                lost = off[best < 0]  # a symbol that the index lacks
            (k, row), place, length = self._left(k, row), place - 1, length + 1
            k[lost], row[lost], place[lost], length[lost] = 0, 0, self.first_at[0], 0
            whole = np.flatnonzero(length >= window)
            flat[base[live[whole]] + at[whole]] = True
            on = (at > 0) & (at + length >= window)
            if not on.all():
                live, at, k, row, place, length = live[on], at[on], k[on], row[on], place[on], length[on]
        return flat


def bucket_marks(ids: np.ndarray, first: np.ndarray, anchor: np.ndarray, again: np.ndarray, texts: list[bytes],
                 window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) byte runs to remove; row numbers the given stretches, which
    start at ``first`` of document ``ids`` and hold their windows' bytes. ``again``:
    whether a stretch may hold two equal windows."""
    order = np.lexsort((first, ids))
    lead: dict[bytes, int] = {}
    origin = np.empty(len(texts), np.int64)  # the first equal stretch; only that one may be indexed
    for i in order.tolist():
        origin[i] = lead.setdefault(texts[i], i)
    own, copied = origin == np.arange(len(texts)), np.bincount(origin, minlength=len(texts)) > 1
    windows = np.array([len(t) - window + 1 for t in texts], np.int64)
    base = np.cumsum(windows + 1) - windows - 1  # a flag that stays empty ends each text
    found, in_copies = np.zeros((2, int((windows + 1).sum())), bool)

    # what takes part in a round: a text between its first and its last window that is still open
    part, low, n_open = list(texts), np.zeros(len(texts), np.int64), windows.copy()

    def places(which: np.ndarray) -> np.ndarray:
        n = n_open[which]
        return np.repeat(base[which] + low[which] - (np.cumsum(n) - n), n) + np.arange(n.sum())

    left, take = order[own[order]], 1
    while True:
        # stretches of one anchor side by side, in corpus order
        left = left[np.argsort(anchor[left], kind="stable")]
        head = np.flatnonzero(np.concatenate([[True], anchor[left][1:] != anchor[left][:-1]])) if len(left) else left
        size = np.diff(np.concatenate([head, [len(left)]]))
        nth, size = np.arange(len(left)) - np.repeat(head, size), np.repeat(size, size)
        useful = (size > 1) | again[left] | copied[left]
        left, nth = left[useful], nth[useful]
        if not len(left):
            break
        held, rest = left[nth < take], left[nth >= take]
        held = held[np.lexsort((first[held], ids[held]))]
        index = RunIndex([part[i] for i in held], window)
        found[places(held)] |= index.marks()
        # equal stretches are streamed once, when the first of them is in the index
        twice = held[copied[held]]
        flags = index.matched([part[i] for i in np.concatenate([rest, twice])])
        at = places(rest)
        found[at] |= flags[:len(at)]
        in_copies[places(twice)] = flags[len(at):]
        shut = found[at]
        if shut.any():
            n = n_open[rest]
            begin, step = np.cumsum(n) - n, np.arange(len(at))
            head = np.minimum.reduceat(np.where(shut, len(at), step), begin) - begin
            tail = np.maximum.reduceat(np.where(shut, -1, step), begin) - begin
            for i in np.flatnonzero((tail >= 0) & ((head > 0) | (tail < n - 1))).tolist():
                r = rest[i]
                part[r] = part[r][head[i]:tail[i] + window]
                low[r], n_open[r] = low[r] + head[i], tail[i] + 1 - head[i]
            rest = rest[tail >= 0]
        left, take = rest, take * GROW

    def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8)])))
        of = np.searchsorted(base, edge[::2], "right") - 1
        return of, edge[::2] - base[of], edge[1::2] - base[of]

    row, s, e = runs(found)
    of, s2, e2 = runs(in_copies | found)
    others = np.flatnonzero(~own)
    others = others[np.argsort(origin[others], kind="stable")]
    low, high = np.searchsorted(origin[others], of), np.searchsorted(origin[others], of, "right")
    n = high - low  # each run of an equal stretch holds for all of them but the first
    pick = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
    row, s, e = np.concatenate([row, others[pick]]), np.concatenate([s, np.repeat(s2, n)]), np.concatenate([e, np.repeat(e2, n)])
    return row, first[row] + s, first[row] + e - 1 + window


def removals(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT,
             bucket: int = BUCKET) -> tuple[DataFrame, DataFrame]:
    """(``a, b, least`` of texts with copies, ``a, b, runs`` of distinct texts with bytes to remove)."""
    text = F.coalesce(col(text_col), F.lit(""))
    big = F.lit(2**63 - 1)
    rows = docs.select(F.coalesce(col(id_col).cast("bigint"), big).alias("id"), F.xxhash64(text).alias("a"),
                       F.xxhash64(F.lit("second"), text).alias("b"), text.cast("binary").alias("text"))
    copies = (rows.select("id", "a", "b").groupBy("a", "b").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"))
              .filter("n > 1").select("a", "b", "least"))
    copies = cut_lineage(copies)
    # whole copies are settled by their ids; the first of each text is looked into
    known = rows.join(small(copies, 24), ["a", "b"], "left")
    once = known.filter("least is null").select("id", "a", "b", "text")
    distinct = once.unionAll(known.filter("id = least").select("id", "a", "b", "text").dropDuplicates(["a", "b"]))

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x for t in batch.column(0) for a, _, _, again in (stretches(t.as_py(), window),) for x in (a, a[again])]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found) if found else np.zeros(0, np.int64))], ["anchor"])

    repeated = cut_lineage(distinct.select("text").mapInArrow(anchors, "anchor bigint").groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    total, n_anchors = repeated.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    hottest = np.array(sorted(r["anchor"] for r in repeated.filter(F.col("n") > hot).select("anchor").collect()), np.int64)  # one in `hot` stretches at most
    kept = docs.sparkSession.sparkContext.broadcast(anchor_filter(repeated, n_anchors))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(0, batch.num_rows, 256):
                part = batch.slice(r, 256)
                at, keys, starts, twice, bodies = [], [], [], [], []
                for i, t in enumerate(part.column("text")):
                    t = t.as_py()
                    anchor, first, n, again = stretches(t, window)
                    held = passes(kept.value, anchor)
                    anchor, first, n, again = anchor[held], first[held], n[held], again[held]
                    at.append(np.full(len(anchor), i))
                    keys.append(anchor)
                    starts.append(first)
                    twice.append(again)
                    bodies += [t[s:s + k + window - 1] for s, k in zip(first.tolist(), n.tolist())]
                at, keys = pa.array(np.concatenate(at)), np.concatenate(keys)
                yield pa.RecordBatch.from_arrays([*(part.column(c).take(at) for c in ("id", "a", "b")), pa.array(keys), pa.array(np.concatenate(starts)),
                                                  pa.array(np.concatenate(twice)), pa.array(bodies, pa.binary()), pa.array(np.isin(keys, hottest))],
                                                 ["id", "a", "b", "anchor", "first", "again", "body", "hot"])

    found = distinct.mapInArrow(cut, "id bigint, a bigint, b bigint, anchor bigint, first bigint, again boolean, body binary, hot boolean")

    def mark(table: pa.Table) -> pa.Table:
        row, s, e = bucket_marks(*(table[c].to_numpy() for c in ("id", "first", "anchor", "again")), table["body"].to_pylist(), window)
        at = pa.array(row)
        return pa.table({"a": table["a"].take(at), "b": table["b"].take(at), "s": pa.array(s), "e": pa.array(e)})

    buckets = max(1, -(-int(total) // bucket))
    runs = (found.filter(~F.col("hot")).withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets)))
            .select("bucket", "id", "a", "b", "anchor", "first", "again", "body").groupBy("bucket").applyInArrow(mark, "a bigint, b bigint, s bigint, e bigint"))
    if len(hottest):
        each = (found.filter("hot").select("id", "a", "b", "first", "body", F.explode(F.sequence(F.lit(1), F.length("body") - (window - 1))).alias("o"))
                .select("a", "b", (F.col("first") + F.col("o") - 1).alias("s"), "id", F.substring(F.col("body"), F.col("o"), F.lit(window)).alias("w"))
                .select("a", "b", "s", (F.col("id").cast("decimal(38,0)") * 2**40 + F.col("s")).alias("place"),
                        F.xxhash64("w").alias("w1"), F.xxhash64(F.lit("second"), "w").alias("w2")))
        # written first, so that a hot window's rows can be split in the join
        earliest = (each.groupBy("w1", "w2").agg(F.min("place").alias("earliest"), F.count(F.lit(1)).alias("n"))
                    .filter("n > 1").select("w1", "w2", "earliest"))
        earliest = small(cut_lineage(earliest), 32)
        late = each.join(earliest, ["w1", "w2"]).filter("place > earliest")
        runs = runs.unionAll(late.select("a", "b", "s", (F.col("s") + window).alias("e")))
    # of one text: bounded by its length
    return copies, runs.groupBy("a", "b").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("runs"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT,
                   bucket: int = BUCKET) -> DataFrame:
    """Add ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs) and ``kept`` (binary: the
    remaining bytes, which need not be whole characters).

    Texts are UTF-8 bytes, whole; a null text is empty. Strings are judged on the
    input, never across documents. Earlier is: a smaller integer id (null after
    all), then an earlier start. Rows that repeat both id and text are all taken as
    the first; a text that another row has under a smaller id goes entirely (if it
    is as long as a window). Shorter texts stay. No rows give none; input columns
    with the added names are replaced.
    """
    copies, runs = removals(docs, window, id_col, text_col, hot, bucket)
    runs = cut_lineage(runs)  # follows the corpus: joined as Spark sees fit, alike at every size
    own = F.coalesce(field(text_col), F.lit(""))
    rows = boxed(docs).select("row", F.coalesce(field(id_col).cast("bigint"), F.lit(2**63 - 1)).alias("id"),
                              F.xxhash64(own).alias("a"), F.xxhash64(F.lit("second"), own).alias("b"))
    rows = rows.join(small(copies, 24), ["a", "b"], "left").join(runs, ["a", "b"], "left")
    # the text as bytes again only here: the joins move it once, in its row
    rows = rows.select("row", own.cast("binary").alias("text"), F.coalesce(F.col("id") > F.col("least"), F.lit(False)).alias("copy"), "runs")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_bytes, n_removed, n_spans, kept = [], [], [], []
            for text, copy, cuts in zip(batch.column("text"), batch.column("copy").to_pylist(), batch.column("runs")):
                t, parts, spans, done = text.as_py(), [], 0, 0
                if copy and len(t) >= window:
                    parts, spans, done = [], 1, len(t)
                else:
                    for r in cuts.as_py() or []:
                        if r["s"] > done or not spans:
                            spans += 1
                            parts.append(t[done:r["s"]])
                        done = max(done, r["e"])
                parts.append(t[done:])
                rest = b"".join(parts)
                n_bytes.append(len(t))
                n_removed.append(len(t) - len(rest))
                n_spans.append(spans)
                kept.append(rest)
            yield pa.RecordBatch.from_arrays([batch.column("row"), *(pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)), pa.array(kept, pa.binary())],
                                             ["row", "n_bytes", "n_removed", "n_spans", "kept"])

    schema = row_schema(rows, "n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
    out = rows.mapInArrow(apply, schema)
    return unboxed(out, **{c: F.col(c) for c in ("n_bytes", "n_removed", "n_spans", "kept")})
