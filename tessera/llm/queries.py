"""Registered queries of the training-data operators, one per operator, and
DuckDB SQL for those that SQL can express. The query derives the compact result
columns; the operator modules keep their general interfaces."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def pipeline(spark, sf_dir):
    """The whole training-data pipeline over all documents."""
    return corpus_pipeline.run(spark, sf_dir)


SHARDS = 24


@query
def op3_sharding(spark, sf_dir):
    """All documents into 24 shards of equal row count, each with the corpus's source mixture."""
    from tessera.llm.sharding import interleave_shards
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", (F.octet_length(text) + 8).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return interleave_shards(docs, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source")


@query
def op10_packing(spark, sf_dir):
    """All documents, tokenised whole, as pieces in sequences of at most 4096 tokens."""
    import public_tokenizers
    from tessera.llm.packing import pack, token_pieces
    return pack(token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


@query
def op8_secret_scan(spark, sf_dir):
    """Secrets of the three fixed kinds in every whole document."""
    from tessera.llm.secret_scan import scan, span_string
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "secrets")
    n = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(span_string(F.col("secrets")), 256).alias("base_sha256"),
                        span_string(F.col("secrets")).alias("spans"))


def _span_sql(kind: str, order: int, pattern: str, group: int, least: int) -> str:
    p = pattern.replace("'", "''")
    return f"""
    SELECT rid, '{kind}' AS kind, {order} AS ord, s AS st, s + length(m) AS en FROM (
      SELECT rid, m, v,
             sum(length(g)) OVER (PARTITION BY rid ORDER BY i) + coalesce(sum(length(m)) OVER (
               PARTITION BY rid ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s
      FROM (SELECT rid, i, ms[i] AS m, vs[i] AS v, gs[i] AS g FROM (
        SELECT rid, ms, vs, gs, unnest(range(1, len(ms) + 1)) AS i FROM (
          SELECT rid, regexp_extract_all(t, '{p}') AS ms, regexp_extract_all(t, '{p}', {group}) AS vs,
                 string_split_regex(t, '{p}') AS gs FROM d)))) WHERE length(v) >= {least}"""


ORACLE_SQL["op8_secret_scan"] = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
s AS ({" UNION ALL ".join([
    _span_sql("assign", 0, r'''((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)''', 2, 6),
    _span_sql("access", 1, "AKIA[A-Z0-9]+", 0, 20),
    _span_sql("hex", 2, "[0-9a-f]+", 0, 24)])}),
a AS (SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
             count(*) FILTER (kind = 'hex') AS n_hex,
             string_agg(kind || ':' || st::BIGINT || ':' || en::BIGINT, ',' ORDER BY st, ord) AS spans FROM s GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN a USING (rid)
"""


@query
def op4_decontaminate(spark, sf_dir):
    """Words of every whole document that lie in an occurrence of a benchmark window."""
    from tessera.llm.decontaminate import mark
    # the digest and counts need the text only through its words, so only the key and counts are carried
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    m = mark(docs, table(spark, sf_dir, "benchmark"))
    return m.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


_WORDS_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE_SQL["op4_decontaminate"] = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS_SQL} AS w FROM documents),
i AS (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark),
win AS (SELECT item_id, least(len(w), 10) AS n, array_to_string(w[k:k + 9], ' ') AS p
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
g AS (SELECT rid, s, n, array_to_string(w[s:s + n - 1], ' ') AS p
      FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT DISTINCT rid, s, g.n, item_id FROM g JOIN win ON win.p = g.p AND win.n = g.n),
h AS (SELECT rid, count(DISTINCT pos) AS n_hit FROM (SELECT rid, unnest(range(s, s + n)) AS pos FROM (SELECT DISTINCT rid, s, n FROM m)) GROUP BY rid),
t AS (SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT rid, item_id::VARCHAR AS id FROM m) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (rid) LEFT JOIN t USING (rid)
"""


@query
def op2_line_dedup(spark, sf_dir):
    """All documents without the lines that stand on ten sites, or on five if they have three words or more."""
    from tessera.llm.line_dedup import FEW_SITES, remove_boilerplate
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return remove_boilerplate(docs, few_sites=FEW_SITES).select("doc_id", "n_lines", "n_removed", F.length("text").cast("bigint").alias("kept_chars"),
                                           F.sha2(F.col("text"), 256).alias("kept_sha256"))


ORACLE_SQL["op2_line_dedup"] = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT rid, doc_id, source, ls[i] AS line, trim(ls[i], ' ' || chr(9) || chr(13)) AS bare, i
      FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM d)),
c AS (SELECT bare FROM l WHERE bare <> '' GROUP BY bare
      HAVING count(DISTINCT source) >= CASE WHEN regexp_matches(bare, '^([^\x20\x09-\x0D]+[\x20\x09-\x0D]+){2}[^\x20\x09-\x0D]') THEN 5 ELSE 10 END),
k AS (SELECT rid, string_agg(line, chr(10) ORDER BY i) FILTER (bare NOT IN (SELECT bare FROM c)) AS kept,
             count(*) FILTER (bare IN (SELECT bare FROM c)) AS n_removed FROM l GROUP BY rid)
SELECT doc_id, coalesce(len(ls), 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
       CASE WHEN ls IS NOT NULL THEN length(coalesce(kept, ''))::BIGINT END AS kept_chars,
       CASE WHEN ls IS NOT NULL THEN sha256(coalesce(kept, '')) END AS kept_sha256
FROM d LEFT JOIN k USING (rid)
"""


@query
def op9_simhash(spark, sf_dir):
    """Every document's 3-word SimHash and the smallest id of its group at two bits."""
    from tessera.llm.simhash import near_duplicates
    near = near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return near.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op7_quality(spark, sf_dir):
    """Quality of every whole document, learned from the labelled ones that are not held out."""
    from tessera.llm.quality import fit, held_out, score
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    # only what the result needs goes through the scorer beside the text
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def token_parts() -> list:
    """The record that op5 renders: a header of two fields, then the text's first line and the rest."""
    first = F.substring_index("text", "\n", 1)
    return [(None, F.lit("source: ")), ("source", F.col("source")), (None, F.lit("\nlang: ")), ("lang", F.col("lang")), (None, F.lit("\n\n")),
            ("title", first), ("body", F.substr("text", F.length(first) + 1))]


@query
def op5_token_counts(spark, sf_dir):
    """Tokens of every document's fields, each record encoded once and whole."""
    import public_tokenizers
    from tessera.llm.token_counts import field_tokens
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    return field_tokens(docs, token_parts(), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op1_embedding_dedup(spark, sf_dir):
    """Every vector's links at cosine 0.95 and its component."""
    from tessera.llm.embedding_dedup import near_duplicates
    return near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), cosine=0.95)


ORACLE_SQL["op1_embedding_dedup"] = """
WITH RECURSIVE x AS (SELECT vec_id, list_transform(embedding, lambda e: e::DOUBLE) AS v FROM embeddings),
s AS (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS n FROM x WHERE len(list_filter(v, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND len(v) > 0),
p AS (SELECT a.vec_id AS u, b.vec_id AS w FROM s a JOIN s b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
      WHERE a.n > 0 AND b.n > 0 AND list_dot_product(a.v, b.v) / (a.n * b.n) >= 0.95e0),
r AS (SELECT vec_id AS u, vec_id AS w FROM x UNION SELECT r.u, p.w FROM r JOIN p ON r.w = p.u),
c AS (SELECT u, min(w) AS component_id FROM r GROUP BY u),
k AS (SELECT u, count(*) AS n_links FROM p GROUP BY u)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM x JOIN c ON c.u = vec_id LEFT JOIN k ON k.u = vec_id
"""


@query
def op6_substring_dedup(spark, sf_dir):
    """Bytes of every whole document in 100-byte strings that start earlier too."""
    from tessera.llm.substring_dedup import remove_repeats
    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


ORACLE_SQL["op6_substring_dedup"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT doc_id, s, substr(x, 2 * s + 1, 200) AS k FROM (SELECT doc_id, x, unnest(range(0, length(x) // 2 - 99)) AS s FROM d WHERE length(x) >= 200)),
g AS (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) > 1 AS late FROM w),
c AS (SELECT doc_id, s, max(s + 100) OVER (PARTITION BY doc_id ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM g WHERE late),
i AS (SELECT doc_id, s, sum(CASE WHEN reach IS NULL OR s > reach THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY s) AS n FROM c),
r AS (SELECT doc_id, n, min(s) AS a, max(s) + 100 AS b FROM i GROUP BY ALL),
p AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS prev FROM r),
k AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
             string_agg(substr(x, 2 * prev + 1, 2 * (a - prev)), '' ORDER BY a) AS head
      FROM p JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, (length(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(from_hex(coalesce(head || substr(x, 2 * last + 1), x))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""


@query
def op13_vector_codes(spark, sf_dir):
    """Every sound vector as 16 codebook indexes, with its error and its label's."""
    from tessera.llm.common import cut_lineage
    from tessera.llm.vector_codes import codebooks_sha256, compress, summed_by
    coded, books = compress(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    # narrow rows, written once: they are read for the labels' sums and for the result
    coded = cut_lineage(coded.select("vec_id", "label", F.lower(F.hex("code")).alias("code"), "error"))
    return summed_by(coded, "error", "label", "label_error").select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256"))


def _assign_sql(book: str) -> str:
    return f"""SELECT rid, part, min({{'d': (p.a - b.a) ** 2 + (p.b - b.b) ** 2 + (p.c - b.c) ** 2 + (p.d - b.d) ** 2, 'e': entry}}) AS m
  FROM p JOIN {book} b USING (part) GROUP BY rid, part"""


def _mean_sql(x: str) -> str:
    """Floor of a mean in whole numbers; the old component where there is none."""
    return f"coalesce((sum(p.{x}) - (sum(p.{x}) % count(p.{x}) + count(p.{x})) % count(p.{x})) // count(p.{x}), any_value(o.{x}))::BIGINT AS {x}"


def _update_sql(book: str, assigned: str) -> str:
    return f"""SELECT o.part, o.entry, {", ".join(map(_mean_sql, "abcd"))}
  FROM {book} o LEFT JOIN {assigned} n ON n.part = o.part AND n.m.e = o.entry LEFT JOIN p ON p.rid = n.rid AND p.part = n.part GROUP BY o.part, o.entry"""


# written for the given tables' 64 components: 16 parts of four
ORACLE_SQL["op13_vector_codes"] = f"""
WITH x AS (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS rid, vec_id, label, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)::BIGINT) AS v
           FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
p AS (SELECT rid, part, v[4 * part + 1] AS a, v[4 * part + 2] AS b, v[4 * part + 3] AS c, v[4 * part + 4] AS d FROM x, range(16) t(part)),
b0 AS (SELECT part, rid - 1 AS entry, a, b, c, d FROM p WHERE rid <= 64),
a0 AS ({_assign_sql("b0")}), b1 AS ({_update_sql("b0", "a0")}),
a1 AS ({_assign_sql("b1")}), b2 AS ({_update_sql("b1", "a1")}),
a2 AS ({_assign_sql("b2")}),
h AS (SELECT sha256(string_agg(concat_ws(',', a, b, c, d), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b2),
r AS (SELECT rid, string_agg(lower(lpad(hex(m.e), 2, '0')), '' ORDER BY part) AS code, sum(m.d)::BIGINT AS error FROM a2 GROUP BY rid)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM r JOIN x USING (rid), h
"""


@query
def op12_quality_rules(spark, sf_dir):
    """Statistics of every whole document and the verdict of the learned decision list."""
    from tessera.llm.decision_lists import judge, learn
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = judge(docs, learn(docs, table(spark, sf_dir, "labels")), carry=["doc_id"])
    return out.select("doc_id", *[f"stats.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                      "base_failed", "kept", "rule")


@query
def op11_source_audit(spark, sf_dir):
    """Divergence of every source of a language from the others and its most typical terms."""
    from tessera.llm.source_audit import audit
    return audit(table(spark, sf_dir, "documents").select("lang", "source", "text"))


ORACLE_SQL["op11_source_audit"] = r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT rid, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS lang_n FROM w GROUP BY ALL HAVING count(DISTINCT rid) >= 10),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
lt AS (SELECT lang, count(*) AS v, sum(lang_n) AS total FROM kept GROUP BY lang),
g AS (SELECT lang, source, coalesce(s.total, 0) AS total, coalesce(lt.v, 0) AS v, coalesce(lt.total, 0) AS lang_total
      FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL) s USING (lang, source) LEFT JOIN lt USING (lang)),
m AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, (1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (g.total + 2 * g.v))::HUGEINT AS p,
             (1 + 1000000000::HUGEINT * (k.lang_n + 2) // (g.lang_total + 2 * g.v))::HUGEINT AS q
      FROM g JOIN kept k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
      FROM m a JOIN m b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value FROM m WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INTEGER AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT * FROM r WHERE part = 'pair' OR rank <= 10
"""
