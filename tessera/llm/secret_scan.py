"""Secret scanning through a trigram inverted index.

Each rule is a regular expression. A Boolean trigram query is derived from its
parse tree: literal stretches (with the alternatives and optional letters in
them) that every match must hold become "all trigrams of one of these strings".
The trigrams that any rule asks for are the index vocabulary; postings
(trigram, text) are built for the whole corpus, a rule's postings are intersected
and united per its query, and only the candidates are verified with the regular
expression. A rule with no mandatory trigram scans every text.

All of it is DataFrame functions: no Python touches a row.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as K
from re import _parser as regex_tree

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import boxed, col, cut_lineage, field, lower_ascii, small, unboxed

MOST_STRINGS = 64  # alternatives kept apart while literals are put together


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds matches (leftmost, not overlapping); a match counts if
    ``group`` of it has at least ``least`` characters. ``scan`` may give another
    pattern that finds the same counted matches faster."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# fixed values: the kinds of secret, their patterns and lengths
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    # maximal runs of 24 or more: [0-9a-f]+ is greedy and its matches are whole
    # runs, so leaving the short runs out in the pattern gives the same matches
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)


def _literals(tree) -> set[str] | None:
    """The strings that ``tree`` can match if they are few and finite, else None."""
    whole = {""}
    for op, arg in tree:
        if op is K.LITERAL:
            part = {chr(arg).lower()}
        elif op is K.SUBPATTERN:
            part = _literals(arg[-1])
        elif op is K.BRANCH:
            options = [_literals(b) for b in arg[1]]
            part = None if None in options else set().union(*options)
        elif op is K.MAX_REPEAT and arg[1] == 1:
            inner = _literals(arg[2])
            part = None if inner is None else inner | ({""} if arg[0] == 0 else set())
        else:
            part = None
        if part is None or len(whole) * len(part) > MOST_STRINGS:
            return None
        whole = {a + b for a in whole for b in part}
    return whole


def trigram_query(pattern: str) -> list[list[list[str]]]:
    """Conjunction of clauses; a clause is a list of alternatives, each a list of
    trigrams (ASCII lower case) that must all occur. No clause: no mandatory trigram."""
    clauses, run = [], {""}

    def close() -> None:
        nonlocal run
        if min(map(len, run)) >= 3:
            clauses.append(sorted(sorted({s[i:i + 3] for i in range(len(s) - 2)}) for s in run))
        run = {""}

    for node in regex_tree.parse(pattern):
        part = _literals([node])
        if part is None or len(run) * len(part) > MOST_STRINGS:
            close()
            part = part if part is not None and len(part) <= MOST_STRINGS else None
        if part:
            run = {a + b for a in run for b in part}
    close()
    return clauses


def build_index(texts: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Postings ``(a, b, trigram)`` of the rows ``(a, b, text)``, restricted to the
    trigrams of ``vocabulary``: no query can ask for any other."""
    low = texts.select("a", "b", lower_ascii(F.col("text")).alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in vocabulary]))
    return low.select("a", "b", F.explode(held).alias("trigram"))


def candidates(postings: DataFrame, queries: dict[str, list]) -> DataFrame:
    """``(a, b, kinds)``: the texts whose postings satisfy the queries, with the kinds."""
    def holds(q) -> Column:
        every = None
        for clause in q:
            some = None
            for grams in clause:
                one = F.size(F.array_intersect("grams", F.array(*map(F.lit, grams)))) == len(grams)
                some = one if some is None else some | one
            every = some if every is None else every & some
        return every

    per_text = postings.groupBy("a", "b").agg(F.collect_set("trigram").alias("grams"))
    kinds = F.array_compact(F.array(*[F.when(holds(q), F.lit(k)) for k, q in queries.items()]))
    return per_text.select("a", "b", kinds.alias("kinds")).filter(F.size("kinds") > 0)


def running_sums(x: Column) -> Column:
    """Running sums of an integer array in n log n steps: each pass adds what stands 1, 2,
    4, ... places before. (Appending to an array as it grows would be quadratic.)"""
    steps = F.slice(F.array(*[F.lit(1 << k) for k in range(31)]), 1, F.ceil(F.log2(F.greatest(F.size(x), F.lit(1)))).cast("int"))
    return F.aggregate(steps, x, lambda acc, w: F.transform(acc, lambda v, i: v + F.when(i >= w, F.get(acc, i - w)).otherwise(0)))


def _spans(text: Column, rule: Rule, order: int, applies: Column) -> Column:
    """Array of (start, order, kind, end) in code points, end exclusive."""
    pattern = F.lit(rule.pattern)
    found = F.when(applies, F.regexp_extract_all(text, pattern, F.lit(0))).otherwise(F.array().cast("array<string>"))
    value = F.when(applies, F.regexp_extract_all(text, pattern, F.lit(rule.group))).otherwise(F.array().cast("array<string>"))
    # what stands between the matches: with their lengths it gives the offsets
    between = F.split(text, rule.pattern)
    parts = F.arrays_zip(between.alias("gap"), found.alias("m"), value.alias("v"))

    def located(ps: Column) -> Column:
        ends = running_sums(F.transform(ps, lambda p: F.length(p["gap"]) + F.coalesce(F.length(p["m"]), F.lit(0))))

        def span(p, end):
            whole = F.struct((end - F.length(p["m"])).alias("start"), F.lit(order).alias("order"), F.lit(rule.kind).alias("kind"), end.alias("end"))
            return F.when(F.length(p["v"]) >= rule.least, whole)  # null after the last match
        return F.array_compact(F.zip_with(ps, ends, span))

    none = F.array().cast("array<struct<start:int,order:int,kind:string,end:int>>")
    return F.when(F.size(found) > 0, F.element_at(F.transform(F.array(parts), located), 1)).otherwise(none)


def scan(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add ``secrets``: array of structs (start, order, kind, end) sorted by start,
    then by the rule's place in ``rules``.

    Whole texts; a null text is empty and has no secret. The index is keyed by the
    text's content (two 64-bit hashes), so ids may be null or repeated and copies
    share their postings; an empty table gives no rows; an input column called
    ``secrets`` is replaced. A text with very many copies is one key of the join
    back, which is a left outer join that Spark splits when it is skewed.
    """
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if q}
    rows = boxed(docs)
    text = F.coalesce(field(text_col).cast("string"), F.lit(""))
    rows = rows.select("row", F.xxhash64(text).alias("a"), F.xxhash64(F.lit("second"), text).alias("b"))
    if indexed:
        vocabulary = sorted({g for q in indexed.values() for clause in q for grams in clause for g in grams})
        source = docs.select(F.xxhash64(_text(text_col)).alias("a"), F.xxhash64(F.lit("second"), _text(text_col)).alias("b"),
                             _text(text_col).alias("text"))
        # written first: the join then has the aggregation behind it and a hot text can be split
        found = small(cut_lineage(candidates(build_index(source, vocabulary), indexed)), 64)
        rows = rows.join(found, ["a", "b"], "left")
    else:
        rows = rows.withColumn("kinds", F.array().cast("array<string>"))
    spans = [_spans(text, r, i, F.array_contains(F.coalesce("kinds", F.array().cast("array<string>")), r.kind) if r.kind in indexed
                    else F.rlike(text, F.lit(r.pattern))) for i, r in enumerate(rules)]
    return unboxed(rows, secrets=F.array_sort(F.concat(*spans)))


def _text(text_col: str) -> Column:
    return F.coalesce(col(text_col).cast("string"), F.lit(""))


def span_string(secrets: Column) -> Column:
    """``kind:start:end`` joined by commas, in the order of ``secrets``."""
    return F.array_join(F.transform(secrets, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
