"""Quality rules as learned decision lists.

Every whole text is read once for countable statistics. On the statistics of a bounded
sample of labelled texts an ordered list of rules is learned by sequential covering:
a rule is a conjunction of thresholds such as ``symbols_per_word >= 0.31``. It is grown
one threshold at a time (the one with the largest information gain) on one part of the
sample, pruned from its end on the other part, and kept if the other part finds it
precise enough; the texts that it covers go and the next rule is learned from the rest.

The list is emitted as one Spark conditional expression over the statistics: the first
rule that holds rejects, texts that no rule covers stay.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import boxed, col, field, row_schema, unboxed

# fixed values: bytes that end words, and those that count as symbols
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = b"#*$%&|<>"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_distinct_words", "n_top_word", "n_bare_words", "n_upper", "n_digits", "n_marks")

_CLASS = np.zeros(256, np.uint8)  # 1 letter, 2 upper-case letter, 3 digit, 4 mark, 5 blank, 6 continuation byte
_CLASS[0x21:0x7F] = 4
_CLASS[list(range(ord("a"), ord("z") + 1)) + list(range(0xC0, 0x100))] = 1
_CLASS[ord("A"):ord("Z") + 1] = 2
_CLASS[ord("0"):ord("9") + 1] = 3
_CLASS[list(BLANKS)] = 5
_CLASS[0x80:0xC0] = 6


def repeated(ids: np.ndarray, window: int = 3) -> int:
    """Words that lie in a run of ``window`` words found twice or more in the text."""
    if len(ids) <= window:
        return 0
    key = ids[:len(ids) - window + 1]
    for j in range(1, window):  # numbered anew after each word, so that products stay below n * n
        key = np.unique(key * (int(ids.max()) + 1) + ids[j:len(ids) - window + 1 + j], return_inverse=True)[1]
    at = np.flatnonzero(np.bincount(key)[key] > 1)
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def count(text: bytes) -> tuple[int, ...]:
    """``COUNTS`` of a whole text in UTF-8.

    Words are runs of anything but the six ASCII blanks; a bare word has no letter
    (letters: A-Z, a-z and all beyond ASCII); marks are the other visible ASCII
    characters without digits; a repeated line is one with a word that equals an
    earlier line; an empty text has one line and no word.
    """
    words, lines = text.split(), [x for x in text.split(b"\n") if x.strip()]
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    byte = np.frombuffer(text, np.uint8)
    kind = _CLASS[byte]
    tally = np.bincount(kind, minlength=7)
    bare = 0
    if words:
        blank = kind == 5
        starts = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
        letter = (kind == 1) | (kind == 2)
        bare = int((np.add.reduceat(letter, starts, dtype=np.int64) == 0).sum())
    symbols = sum(map(text.count, (bytes([s]) for s in SYMBOLS)))
    return (len(words), len(text) - int(tally[5] + tally[6]), symbols, len(lines) - len(set(lines)), repeated(ids),
            text.count(b"\n") + 1, len(number), int(np.bincount(ids).max()) if words else 0, bare, int(tally[2]), int(tally[3]), int(tally[4]))


def _share(top: str, base: str):
    return lambda s: F.when(s[base] > 0, s[top] / s[base]).otherwise(0.0)


#: What a rule may ask for, over the struct of counts.
FEATURES = {
    "words": lambda s: s["n_words"].cast("double"),
    "chars_per_word": _share("word_chars", "n_words"),
    "symbols_per_word": _share("n_symbols", "n_words"),
    "repeated_lines": _share("n_dup_lines", "n_lines"),
    "repeated_words": _share("n_repeat_words", "n_words"),
    "distinct_words": _share("n_distinct_words", "n_words"),
    "top_word": _share("n_top_word", "n_words"),
    "bare_words": _share("n_bare_words", "n_words"),
    "upper_case": _share("n_upper", "word_chars"),
    "digits": _share("n_digits", "word_chars"),
    "marks_per_word": _share("n_marks", "n_words"),
}


def statistics(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Add ``stats``, a struct of ``COUNTS`` (long), to the columns ``carry`` (all if None).

    Whole texts, one row at a time: a null text is empty; repeated rows get equal
    counts; no rows give none; a carried column called ``stats`` is replaced.
    """
    kept = docs if carry is None else docs.select(*[col(c) for c in carry])
    rows = boxed(docs).select(F.struct(*[field(c).alias(c) for c in kept.columns]).alias("row"),
                              F.coalesce(field(text_col).cast("string"), F.lit("")).alias("text"))

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([count(t.as_py()) for t in batch.column("text").cast(pa.binary())], np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays([batch.column("row"), *(pa.array(found[:, i]) for i in range(len(COUNTS)))], ["row", *COUNTS])

    out = rows.mapInArrow(go, row_schema(rows, ", ".join(f"{c} bigint" for c in COUNTS)))
    return unboxed(out, stats=F.struct(*COUNTS))


def base_failed(stats: Column) -> Column:
    """Fewer than 50 words, or over half of the words in repeated windows."""
    return (stats["n_words"] < 50) | (100 * stats["n_repeat_words"] > 50 * stats["n_words"])


@dataclass(frozen=True)
class Literal:
    feature: str
    above: bool       # at the threshold or more; else below it
    threshold: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        v = x[:, list(FEATURES).index(self.feature)]
        return v >= self.threshold if self.above else v < self.threshold

    def column(self, stats: Column) -> Column:
        v = FEATURES[self.feature](stats)
        return v >= F.lit(self.threshold) if self.above else v < F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold:.6g}"


Rule = tuple[Literal, ...]


def covers(rule: Rule, x: np.ndarray) -> np.ndarray:
    return functools.reduce(np.logical_and, (t.holds(x) for t in rule), np.ones(len(x), bool))


@dataclass(frozen=True)
class DecisionList:
    """Rules in order; the first that holds rejects."""
    rules: tuple[Rule, ...] = ()

    def first(self, x: np.ndarray) -> np.ndarray:
        """Number of the first rule that covers each row of feature values, -1 for none."""
        out = np.full(len(x), -1)
        for i, rule in reversed(list(enumerate(self.rules))):
            out[covers(rule, x)] = i
        return out

    def column(self, stats: Column) -> Column:
        """The list as one conditional expression: the text of the first rule that holds, else null."""
        out = None
        for rule in self.rules:
            held = functools.reduce(lambda a, b: a & b, (t.column(stats) for t in rule))
            text = F.lit(" and ".join(map(str, rule)))
            out = F.when(held, text) if out is None else out.when(held, text)
        return F.lit(None).cast("string") if out is None else out


@dataclass(frozen=True)
class Settings:
    """Rules are learned from the statistics of at most ``max_docs`` labelled documents;
    ``grow`` of them grow rules, the rest prune and test them. A rule must reject at least
    ``least`` documents of the second part, ``precision`` of them rightly."""
    max_docs: int = 20000
    grow: float = 0.67
    literals: int = 4
    rules: int = 32
    precision: float = 0.95
    least: int = 2
    seed: int = 12


def _best_literal(x: np.ndarray, bad: np.ndarray) -> tuple[float, Literal | None]:
    """The threshold with the largest information gain over the covered rows; ties go to
    the first feature, ``>=`` and the lowest threshold. Thresholds lie between values."""
    p0, n0 = bad.sum(), (~bad).sum()
    before = np.log2(p0 / (p0 + n0))
    best, found = 0.0, None
    for f, name in enumerate(FEATURES):
        order = np.argsort(x[:, f], kind="stable")
        v, b = x[order, f], bad[order]
        cut = np.flatnonzero(v[1:] > v[:-1]) + 1
        if not len(cut):
            continue
        below_p = np.cumsum(b)[cut - 1].astype(float)
        below_n = cut - below_p
        for above, p, n in ((True, p0 - below_p, n0 - below_n), (False, below_p, below_n)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / (p + n)) - before), 0)
            i = int(gain.argmax())
            if gain[i] > best + 1e-9:
                best, found = float(gain[i]), Literal(name, above, float((v[cut[i] - 1] + v[cut[i]]) / 2))
    return best, found


def cover(x: np.ndarray, bad: np.ndarray, s: Settings = Settings()) -> DecisionList:
    """Sequential covering of the bad rows of a feature matrix (columns as ``FEATURES``)."""
    part = np.random.default_rng(s.seed).random(len(x)) < s.grow
    grow, test = np.flatnonzero(part), np.flatnonzero(~part)
    rules: list[Rule] = []
    while len(rules) < s.rules and bad[grow].any():
        held, rule = grow, ()
        while len(rule) < s.literals and not bad[held].all():
            _, literal = _best_literal(x[held], bad[held])
            if literal is None:
                break
            rule += (literal,)
            held = held[literal.holds(x[held])]
        if not rule:
            break
        scored = []
        for k in range(1, len(rule) + 1):
            hit = bad[test[covers(rule[:k], x[test])]]
            p, n = int(hit.sum()), int((~hit).sum())
            scored.append(((p - n) / max(1, p + n), p, -k))
        _, p, k = max(scored)
        rule = rule[:-k]
        hit = covers(rule, x[test]).sum()
        if hit < s.least or p < s.precision * hit:
            break
        rules.append(rule)
        grow, test = grow[~covers(rule, x[grow])], test[~covers(rule, x[test])]
    return DecisionList(tuple(rules))


def held_out(id_col: Column) -> Column:
    """True where crc32 of the id as text is divisible by 5: never learned from. A null id is not."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> DecisionList:
    """Rules that reject documents labelled 0, from a seeded sample of those not held out.

    Documents that fail the base rules come before any learned rule and are left out.
    Ids that are null, have null or contradicting labels or are not in ``docs`` teach
    nothing; rows that repeat an id count once. Without labels of both kinds there are
    no rules and every text that passes the base rules stays.
    """
    known = (labels.select(col(id_col).alias("id"), col(label_col).cast("int").alias("y"))
             .filter(F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("id")))
             .groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("y2")).filter("y = y2"))
    chosen = known.orderBy(F.xxhash64(F.lit(s.seed), F.col("id")), "id").limit(s.max_docs).select("id", "y")
    texts = docs.select(col(id_col).alias("id"), col(text_col).alias("text")).join(F.broadcast(chosen), "id")  # at most max_docs rows
    seen = statistics(texts, carry=["id", "y"]).filter(~base_failed(F.col("stats")))
    one = seen.groupBy("id").agg(F.min("y").alias("y"), F.min("stats").alias("stats"))
    rows = one.select("id", "y", *[f(F.col("stats")).alias(k) for k, f in FEATURES.items()]).orderBy("id").collect()
    x = np.array([[r[k] for k in FEATURES] for r in rows], float).reshape(-1, len(FEATURES))
    bad = np.array([r["y"] == 0 for r in rows], bool)
    return cover(x, bad, s) if bad.any() and not bad.all() else DecisionList()


def judge(docs: DataFrame, rules: DecisionList, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Add ``stats``, ``base_failed``, ``rule`` (the learned rule that rejects, or null) and
    ``kept`` to the columns ``carry`` (all if None); carried columns of these names are replaced."""
    out = boxed(statistics(docs, text_col, carry))
    s = field("stats")
    rule = F.when(~base_failed(s), rules.column(s))
    return unboxed(out, stats=s, base_failed=base_failed(s), rule=rule, kept=~base_failed(s) & rule.isNull())
