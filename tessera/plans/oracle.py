"""Independent DuckDB SQL for each registered query (the correctness gate).

Written from the operator semantics, not from the Spark plans: list slicing
for windows, window functions over the whole table for ranks and offsets.
Doubles are rounded to 6 places on both sides where noted.
"""

from __future__ import annotations

from tessera.functions.text import WS_CLASS

WS = WS_CLASS


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({strip(x)}, '{WS}+'), lambda w: w <> '')"


PAIRS = """
pairs AS (
  SELECT row_number() OVER (ORDER BY u.conv_id, u.turn) - 1 AS idx, u.conv_id, u.turn,
         u.text AS question, a.text AS answer
  FROM conversations u JOIN conversations a
    ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
  WHERE u.role = 'user')"""

RECS = """
recs0 AS (
  SELECT u.conv_id, u.turn, 'obj' AS kind, u.text AS question, a.text AS answer
  FROM conversations u LEFT JOIN conversations a
    ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
  WHERE u.role = 'user'
  UNION ALL
  SELECT conv_id, turn, 'str', NULL, NULL FROM conversations WHERE role = 'system'),
recs AS (SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS idx, * FROM recs0),
classified AS (
  SELECT idx,
    CASE WHEN kind <> 'obj' THEN 'not_object'
         WHEN question IS NULL OR answer IS NULL THEN 'not_string'
         WHEN """ + strip("question") + """ = '' OR """ + strip("answer") + """ = '' THEN 'empty' END AS error,
    question, answer
  FROM recs)"""

TRAIN_TEXT = PAIRS + """,
train_text AS (SELECT idx, 'Q: ' || question || ' A: ' || answer AS text FROM pairs)"""

# word vocabulary over the training text; optional cap on total size
def word_vocab(cap: int | None = None) -> str:
    where = f"WHERE r <= {cap - 4}" if cap else ""
    return TRAIN_TEXT + f""",
tw AS (SELECT idx, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos
       FROM (SELECT idx, {words('text')} AS ws FROM train_text)),
wc AS (SELECT word, count(*) AS n FROM tw GROUP BY word),
vocab AS (SELECT word, (r + 3)::INTEGER AS id FROM (
  SELECT word, row_number() OVER (ORDER BY n DESC, word) AS r FROM wc) {where}),
tok AS (SELECT tw.idx, tw.pos, coalesce(v.id, 1) AS id, tw.word FROM tw LEFT JOIN vocab v USING (word)),
ids AS (
  SELECT t.idx, coalesce(list(k.id ORDER BY k.pos) FILTER (WHERE k.id IS NOT NULL), []) AS tokens
  FROM train_text t LEFT JOIN tok k USING (idx) GROUP BY t.idx)"""


BLOCK, STEP, BATCH, GEN_BATCH = 256, 128, 32, 4

WINDOWS = word_vocab() + f""",
stream AS (SELECT flatten(list(tokens ORDER BY idx)) AS s FROM ids),
meta AS (SELECT s, CASE WHEN len(s) < {BLOCK} THEN 1 ELSE (len(s) - {BLOCK}) // {STEP} + 1 END AS nw FROM stream),
wins AS (
  SELECT k AS window_idx,
         list_resize(s[k * {STEP} + 1 : k * {STEP} + {BLOCK}], {BLOCK}, 0) AS x,
         list_resize(s[k * {STEP} + 2 : k * {STEP} + {BLOCK} + 1], {BLOCK}, 0) AS y
  FROM meta, range(nw) t(k)),
splits AS (
  SELECT window_idx, x, y,
    CASE WHEN row_number() OVER (ORDER BY md5('42|' || window_idx::VARCHAR), window_idx)
              <= floor((SELECT count(*) FROM wins) * 0.9e0) THEN 'train' ELSE 'val' END AS split
  FROM wins)"""

PROMPT_PART = f"""
prompts AS (SELECT item_id AS row_id, 'Q: ' || text || ' A:' AS text FROM benchmark),
pw AS (SELECT row_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos
       FROM (SELECT row_id, {words('text')} AS ws FROM prompts)),
pids AS (
  SELECT p.row_id, coalesce(list(coalesce(v.id, 1) ORDER BY w.pos) FILTER (WHERE w.pos IS NOT NULL), []) AS tokens
  FROM prompts p LEFT JOIN pw w USING (row_id) LEFT JOIN vocab v ON v.word = w.word GROUP BY p.row_id),
bos AS (SELECT row_id, CASE WHEN len(tokens) > 0 AND tokens[1] = 2 THEN tokens ELSE list_prepend(2, tokens) END AS tokens
        FROM pids)"""
PROMPT_IDS = word_vocab() + ",\n" + PROMPT_PART


SQL: dict[str, str] = {}

SQL["s3_pairs_from_turns"] = f"WITH {PAIRS} SELECT idx, conv_id, turn, question, answer FROM pairs"
SQL["v1_classify_qa"] = f"""WITH {RECS} SELECT idx, error,
  CASE WHEN error IS NULL OR error <> 'not_object' THEN question END AS question,
  CASE WHEN error IS NULL OR error <> 'not_object' THEN answer END AS answer FROM classified"""
SQL["v3_quarantine_rejected"] = f"WITH {RECS} SELECT idx, error FROM classified WHERE error IS NOT NULL"
SQL["v3_quarantine_good"] = f"WITH {RECS} SELECT idx, question, answer FROM classified WHERE error IS NULL"
SQL["v4_validation_report"] = f"""WITH {RECS} SELECT coalesce(error, 'ok') AS outcome, count(*) AS n_records,
  min(idx) AS first_idx FROM classified GROUP BY 1"""
SQL["p1_strip_ws"] = f"""SELECT conv_id, turn,
  {strip("chr(12288) || chr(9) || chr(8203) || text || ' ' || chr(133) || ' '")} AS stripped FROM conversations"""
SQL["p2_has_pair"] = f"WITH {RECS} SELECT idx FROM classified WHERE question IS NOT NULL AND answer IS NOT NULL"
SQL["p3_format_qa"] = f"WITH {PAIRS} SELECT idx, 'Q: ' || {strip('question')} || ' A: ' || {strip('answer')} AS text FROM pairs"
SQL["p3_format_qa_raw"] = f"WITH {TRAIN_TEXT} SELECT idx, text FROM train_text"
SQL["p4_format_prompt"] = "SELECT item_id AS row_id, 'Q: ' || text || ' A:' AS prompt FROM benchmark"
SQL["p5_seeded_shuffle"] = f"""WITH {PAIRS} SELECT idx,
  row_number() OVER (ORDER BY md5('42|' || idx::VARCHAR), idx) AS shuffle_rank FROM pairs"""

SPECIAL_ROWS = """(VALUES (0, '<pad>', 'control'), (1, '<unk>', 'unknown'), (2, '<s>', 'control'), (3, '</s>', 'control'))"""
DOC_WORDS = f"""dw AS (SELECT unnest({words('text')}) AS word FROM documents),
dwc AS (SELECT word, count(*) AS n FROM dw GROUP BY word)"""
SQL["t2_word_counts"] = f"WITH {DOC_WORDS} SELECT word, n FROM dwc"
SQL["t3_alphabet"] = f"""WITH {DOC_WORDS},
chars AS (SELECT unnest(string_split('▁' || word, '')) AS ch, n FROM dwc)
SELECT ch, sum(n)::BIGINT AS n FROM chars WHERE ch <> '' GROUP BY ch"""
SQL["t3_alphabet_coverage"] = f"""WITH {DOC_WORDS},
chars AS (SELECT unnest(string_split('▁' || word, '')) AS ch, n FROM dwc),
cn AS (SELECT ch, sum(n)::BIGINT AS n FROM chars WHERE ch <> '' GROUP BY ch),
cum AS (SELECT ch, n, coalesce(sum(n) OVER (ORDER BY n DESC, ch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(n) OVER () AS total FROM cn)
SELECT ch, n FROM cum WHERE before < 0.995e0 * total"""
SQL["t6_encode_word"] = f"""WITH {word_vocab(10000)} SELECT idx, len(tokens)::BIGINT AS n_tokens,
  array_to_string(tokens, ' ') AS tokens_text FROM ids"""
SQL["t7_decode_word"] = f"""WITH {word_vocab(10000)}
SELECT t.idx, coalesce(string_agg(CASE WHEN k.id = 1 THEN '⁇' ELSE k.word END, ' ' ORDER BY k.pos), '') AS text
FROM train_text t LEFT JOIN tok k USING (idx) GROUP BY t.idx"""
SQL["t1_special_tokens"] = f"""WITH {word_vocab()},
pieces AS (SELECT id, piece, kind, 0 AS n FROM {SPECIAL_ROWS} t(id, piece, kind)
  UNION ALL SELECT id, word, 'word', 1 FROM vocab)
SELECT kind, count(*) AS n_pieces, min(id)::INTEGER AS first_id, max(id)::INTEGER AS last_id, min(piece) AS least_piece FROM pieces GROUP BY kind"""
SQL["t8_piece_to_id"] = f"""WITH {word_vocab()},
asked AS (SELECT DISTINCT unnest({words('text')}) AS piece FROM benchmark UNION SELECT piece FROM {SPECIAL_ROWS} t(id, piece, kind)),
known AS (SELECT id, piece FROM {SPECIAL_ROWS} t(id, piece, kind) UNION ALL SELECT id, word FROM vocab)
SELECT a.piece, coalesce(min(k.id), 1)::INTEGER AS id FROM asked a LEFT JOIN known k USING (piece) GROUP BY a.piece"""
SQL["t8_vocab_size"] = f"WITH {word_vocab()} SELECT (count(*) + 4)::BIGINT AS n_pieces FROM vocab"
SQL["t9_ensure_bos"] = f"WITH {PROMPT_IDS} SELECT row_id, array_to_string(tokens, ' ') AS tokens_text FROM bos"

SQL["d1_global_offsets"] = f"""WITH {word_vocab()} SELECT idx, len(tokens)::BIGINT AS n,
  coalesce(sum(len(tokens)) OVER (ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
FROM ids"""
SQL["d2_window_count"] = f"""WITH {word_vocab()} SELECT n_tokens,
  (CASE WHEN n_tokens < {BLOCK} THEN 1 ELSE (n_tokens - {BLOCK}) // {STEP} + 1 END)::BIGINT AS n_windows
FROM (SELECT coalesce(sum(len(tokens)), 0)::BIGINT AS n_tokens FROM ids)"""
SQL["d3_pack_windows"] = f"""WITH {WINDOWS} SELECT window_idx, array_to_string(x, ' ') AS x_text,
  array_to_string(y, ' ') AS y_text FROM wins"""
SQL["d6_split_exact"] = f"WITH {WINDOWS} SELECT window_idx, split FROM splits"
SQL["d7_assign_batches"] = f"""WITH {WINDOWS},
r AS (
  SELECT window_idx, split, row_number() OVER (PARTITION BY split ORDER BY
    CASE WHEN split = 'train' THEN md5('42|0|' || window_idx::VARCHAR) ELSE '' END, window_idx) - 1 AS r0
  FROM splits)
SELECT window_idx, split, (r0 // {BATCH})::BIGINT AS batch_id, (r0 % {BATCH})::BIGINT AS batch_pos FROM r"""
SQL["d9_pad_batches"] = f"""WITH {PROMPT_IDS},
b AS (SELECT row_id, tokens, (row_number() OVER (ORDER BY row_id) - 1) // {GEN_BATCH} AS batch_id FROM bos)
SELECT row_id, batch_id::BIGINT AS batch_id,
  array_to_string(list_resize(tokens, max(len(tokens)) OVER (PARTITION BY batch_id), 0), ' ') AS padded_text
FROM b"""
SQL["d10_pad_mask"] = f"""WITH {WINDOWS} SELECT window_idx,
  array_to_string(list_transform(x, lambda t: CASE WHEN t <> 0 THEN '1' ELSE '0' END), '') AS mask_bits FROM wins"""
SQL["d11_positions"] = f"""WITH {WINDOWS} SELECT window_idx, (generate_subscripts(x, 1) - 1)::BIGINT AS pos,
  unnest(x)::BIGINT AS token FROM wins"""
SQL["window_stats"] = f"""WITH {WINDOWS} SELECT split, count(*) AS n_windows,
  sum(len(list_filter(x, lambda t: t <> 0)))::BIGINT AS real_tokens FROM splits GROUP BY split"""


# ---- decoding over logits tables -------------------------------------------------

LOGITS = """logits AS (SELECT vec_id AS row_id, (generate_subscripts(embedding, 1) - 1)::INTEGER AS token,
  unnest(embedding)::DOUBLE AS logit FROM embeddings)"""
SQL["g1_temperature"] = f"WITH {LOGITS} SELECT row_id, token, round(logit / 0.7e0, 6) AS logit FROM logits"
SEEN = "seen AS (SELECT DISTINCT row_id, token FROM logits WHERE logit < -0.1e0)"
SQL["g2_repetition_penalty"] = f"""WITH {LOGITS}, {SEEN}
SELECT l.row_id, l.token, round(CASE WHEN s.token IS NOT NULL THEN l.logit / 1.2e0 ELSE l.logit END, 6) AS logit
FROM logits l LEFT JOIN seen s USING (row_id, token)"""
SQL["g2_repetition_penalty_sign_aware"] = f"""WITH {LOGITS}, {SEEN}
SELECT l.row_id, l.token, round(CASE WHEN s.token IS NULL THEN l.logit
  WHEN l.logit < 0 THEN l.logit * 1.2e0 ELSE l.logit / 1.2e0 END, 6) AS logit
FROM logits l LEFT JOIN seen s USING (row_id, token)"""
SOFT = """sm AS (SELECT row_id, token, z / sum(z) OVER (PARTITION BY row_id) AS prob FROM (
  SELECT row_id, token, exp(logit - max(logit) OVER (PARTITION BY row_id)) AS z FROM logits))"""
SQL["g3_softmax"] = f"WITH {LOGITS}, {SOFT} SELECT row_id, token, round(prob, 6) AS prob FROM sm"
NUCLEUS = LOGITS.replace("unnest(embedding)::DOUBLE AS logit", "unnest(embedding)::DOUBLE / 0.7e0 AS logit") + ", " + SOFT + """,
kept AS (SELECT row_id, token, prob FROM (
  SELECT *, coalesce(sum(prob) OVER (PARTITION BY row_id ORDER BY prob DESC, token
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM sm) WHERE before <= 0.9e0),
nuc AS (SELECT row_id, token, prob / sum(prob) OVER (PARTITION BY row_id) AS prob FROM kept)"""
SQL["g4_top_p"] = f"WITH {NUCLEUS} SELECT row_id, token, round(prob, 6) AS prob FROM nuc"
SQL["g6_sample_token"] = f"""WITH {NUCLEUS},
c AS (SELECT row_id, token,
  sum(prob) OVER (PARTITION BY row_id ORDER BY prob DESC, token ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
  sum(prob) OVER (PARTITION BY row_id) AS tot,
  row_number() OVER (PARTITION BY row_id ORDER BY prob DESC, token) AS pos,
  ('0x' || substr(md5('42|' || row_id::VARCHAR || '|0'), 1, 8))::BIGINT / 4294967296.0e0 AS u
  FROM nuc)
SELECT row_id, coalesce(min_by(token, pos) FILTER (WHERE cum > u * tot), max_by(token, pos)) AS next_token
FROM c GROUP BY row_id"""
RANKED = f"""{LOGITS}, seqs AS (SELECT row_id, list(token ORDER BY -logit, token) AS tokens FROM logits GROUP BY row_id)"""
SQL["g7_truncate_context"] = f"""WITH {RANKED} SELECT row_id,
  array_to_string(CASE WHEN len(tokens) > 16 THEN tokens[-16:] ELSE tokens END, ' ') AS tokens_text FROM seqs"""
SQL["g8_trim_at_eos"] = f"""WITH {RANKED} SELECT row_id,
  array_to_string(CASE WHEN list_position(tokens, 3) IS NOT NULL THEN tokens[1:list_position(tokens, 3)]
    ELSE tokens END, ' ') AS tokens_text FROM seqs"""

# ---- run-log analysis --------------------------------------------------------------

LOG = """log AS (SELECT user_id AS run_id,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS iter, value AS val_loss FROM events)"""
SQL["r1_eval_points"] = f"""WITH {LOG} SELECT run_id, iter, val_loss FROM (
  SELECT *, max(iter) OVER (PARTITION BY run_id) AS last_iter FROM log) WHERE iter % 5 = 0 OR iter = last_iter"""
INF = "'infinity'::DOUBLE"


def improved(log: str) -> str:
    """Common tables of R2, R3 and R5 over a table ``log``."""
    return log + f""",
m AS (SELECT *, least({INF}, coalesce(min(val_loss) OVER (PARTITION BY run_id ORDER BY iter
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), {INF})) AS prev_best FROM log),
imp AS (SELECT *, coalesce(val_loss < prev_best, false) AS improved,
  row_number() OVER (PARTITION BY run_id ORDER BY iter) AS pos FROM m),
s AS (SELECT *, pos - coalesce(max(CASE WHEN improved THEN pos END) OVER (PARTITION BY run_id ORDER BY iter
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS since FROM imp),
f AS (SELECT *, max(CASE WHEN since >= 5 THEN 1 ELSE 0 END) OVER (PARTITION BY run_id ORDER BY iter
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS stopped_before FROM s),
kept AS (SELECT * FROM f WHERE coalesce(stopped_before, 0) = 0)"""
IMPROVED = improved(LOG)
SQL["r2_mark_improved"] = f"""WITH {IMPROVED} SELECT run_id, iter, improved::INTEGER AS improved,
  least(val_loss, prev_best) AS best_so_far FROM imp"""
SQL["r3_early_stop"] = f"""WITH {IMPROVED} SELECT run_id, iter, since::BIGINT AS since,
  (since >= 5)::INTEGER AS stopped_here FROM kept"""
# the same log with diverged evaluations: +inf at the start of a run, NaN now and then
DIVERGED = improved("""log AS (SELECT run_id, iter, CASE WHEN iter < run_id % 3 THEN 'infinity'::DOUBLE WHEN (iter + run_id) % 7 = 0 THEN 'nan'::DOUBLE
  ELSE val_loss END AS val_loss FROM (SELECT user_id AS run_id,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS iter, value AS val_loss FROM events))""")
SQL["r2_mark_improved_inf"] = f"""WITH {DIVERGED} SELECT run_id, iter, improved::INTEGER AS improved,
  CASE WHEN isinf(least(val_loss, prev_best)) THEN NULL ELSE least(val_loss, prev_best) END AS best_so_far FROM imp"""
SQL["r3_early_stop_inf"] = f"""WITH {DIVERGED} SELECT run_id, iter, since::BIGINT AS since,
  (since >= 5)::INTEGER AS stopped_here FROM kept"""
SQL["r5_best_checkpoint"] = f"""WITH {IMPROVED} SELECT run_id, min_by(iter, (val_loss, iter)) AS best_iter,
  min(val_loss) AS best_val_loss FROM kept GROUP BY run_id"""


# ---- n-gram language model -----------------------------------------------------------

NGRAM = WINDOWS + """,
tr AS (SELECT window_idx, x, unnest(y) AS token, generate_subscripts(y, 1) - 1 AS t
       FROM splits WHERE split = 'train'),
lv AS (SELECT 1 AS ord, '' AS ctx, token FROM tr WHERE token <> 0
       UNION ALL SELECT 2, x[t + 1]::VARCHAR, token FROM tr WHERE token <> 0
       UNION ALL SELECT 3, array_to_string(x[t:t + 1], ' '), token FROM tr WHERE token <> 0 AND t >= 1),
counts AS (SELECT ord, ctx, token, count(*) AS n FROM lv GROUP BY ord, ctx, token),
tot AS (SELECT ord, ctx, sum(n) AS total FROM counts GROUP BY ord, ctx),
nn AS (SELECT sum(n) AS n FROM counts WHERE ord = 1),
vv AS (SELECT count(*) + 4 AS v FROM vocab),
va AS (SELECT window_idx, x, unnest(y) AS token, generate_subscripts(y, 1) - 1 AS t
       FROM splits WHERE split = 'val'),
vt AS (SELECT window_idx, t, token, x[t + 1]::VARCHAR AS h2,
              CASE WHEN t >= 1 THEN array_to_string(x[t:t + 1], ' ') END AS h3 FROM va WHERE token <> 0),
sc AS (
  SELECT vt.window_idx, vt.t,
    (0.01e0 / vv.v + 0.19e0 * coalesce(c1.n, 0) / nn.n
      + CASE WHEN t2.total IS NOT NULL THEN 0.3e0 * coalesce(c2.n, 0) / t2.total ELSE 0 END
      + CASE WHEN t3.total IS NOT NULL THEN 0.5e0 * coalesce(c3.n, 0) / t3.total ELSE 0 END)
    / (0.2e0 + CASE WHEN t2.total IS NOT NULL THEN 0.3e0 ELSE 0 END
             + CASE WHEN t3.total IS NOT NULL THEN 0.5e0 ELSE 0 END) AS p
  FROM vt CROSS JOIN nn CROSS JOIN vv
  LEFT JOIN counts c1 ON c1.ord = 1 AND c1.token = vt.token
  LEFT JOIN counts c2 ON c2.ord = 2 AND c2.ctx = vt.h2 AND c2.token = vt.token
  LEFT JOIN tot t2 ON t2.ord = 2 AND t2.ctx = vt.h2
  LEFT JOIN counts c3 ON c3.ord = 3 AND c3.ctx = vt.h3 AND c3.token = vt.token
  LEFT JOIN tot t3 ON t3.ord = 3 AND t3.ctx = vt.h3)"""
SQL["l1_fit_ngram"] = f"WITH {NGRAM} SELECT ord AS ctx_order, ctx, token, n FROM counts"
SQL["l3_token_loss"] = f"WITH {NGRAM} SELECT round(avg(-ln(p)), 6) AS loss, count(*) AS n_targets FROM sc"
SQL["l4_eval_loss"] = f"""WITH {NGRAM},
vb AS (SELECT window_idx, (row_number() OVER (ORDER BY window_idx) - 1) // {BATCH} AS batch_id
       FROM splits WHERE split = 'val'),
bl AS (SELECT vb.batch_id, avg(-ln(sc.p)) AS bl FROM sc JOIN vb USING (window_idx) GROUP BY vb.batch_id)
SELECT round(coalesce(avg(bl), 'inf'::DOUBLE), 6) AS val_loss, count(*) AS n_batches FROM bl"""
SQL["l2_score_next"] = f"""WITH {NGRAM},
{PROMPT_PART},
asked AS (SELECT row_id, tokens FROM bos UNION ALL SELECT -1, [2, 1, 1]),
last AS (
  SELECT row_id, 3 AS ord, array_to_string(tokens[-2:], ' ') AS ctx FROM asked WHERE len(tokens) >= 2
  UNION ALL SELECT row_id, 2, tokens[-1]::VARCHAR FROM asked WHERE len(tokens) >= 1),
hit AS (SELECT l.row_id, max_by(l.ord, l.ord) AS ord, max_by(l.ctx, l.ord) AS ctx
        FROM last l JOIN tot USING (ord, ctx) GROUP BY l.row_id),
back AS (
  SELECT b.row_id, 2 AS ord, max_by(b.tok::VARCHAR, b.pos) AS ctx FROM (
    SELECT row_id, unnest(tokens) AS tok, generate_subscripts(tokens, 1) AS pos FROM asked
    WHERE row_id NOT IN (SELECT row_id FROM hit)) b
  JOIN tot ON tot.ord = 2 AND tot.ctx = b.tok::VARCHAR GROUP BY b.row_id),
chosen AS (SELECT * FROM hit UNION ALL SELECT * FROM back
  UNION ALL SELECT row_id, 1, '' FROM asked WHERE row_id NOT IN (SELECT row_id FROM hit) AND row_id NOT IN (SELECT row_id FROM back))
SELECT ch.row_id, c.token, round(ln(c.n / t.total), 6) AS logit, ch.ord AS ctx_order
FROM chosen ch JOIN counts c USING (ord, ctx) JOIN tot t USING (ord, ctx)"""


# ---- byte-pair tokenizer ------------------------------------------------------------------

SQL["t4_bpe_pair_counts"] = f"""WITH {DOC_WORDS},
sy AS (SELECT string_split('▁' || regexp_replace(word, '[\ue000\ue001]', '\ufffd', 'g'), '') AS s, n FROM dwc),
pr AS (SELECT unnest(list_zip(s[1:len(s) - 1], s[2:len(s)])) AS p, n FROM sy WHERE len(s) > 1)
SELECT p[1] AS a, p[2] AS b, sum(n)::BIGINT AS cnt FROM pr GROUP BY ALL"""
SQL["t5_sample_input"] = f"""WITH {PAIRS} SELECT idx FROM pairs ORDER BY md5('42|' || idx::VARCHAR), idx LIMIT 100"""
SQL["t7_decode_bpe"] = f"""WITH {PAIRS}
SELECT idx, array_to_string({words("'Q: ' || " + strip('question') + " || ' A: ' || " + strip('answer'))}, ' ') AS text
FROM pairs"""


# ---- inference and artifacts ---------------------------------------------------------------------

SQL["l5_infer"] = "SELECT vec_id, round(list_avg(list_transform(embedding, lambda v: v::DOUBLE)), 6) AS prediction FROM embeddings"
SQL["l5_infer_skips"] = """SELECT vec_id, CASE WHEN m <= 0 THEN round(m, 6) END AS prediction, CASE WHEN m > 0 THEN 'ValueError: positive mean' END AS error
FROM (SELECT vec_id, list_avg(list_transform(embedding, lambda v: v::DOUBLE)) AS m FROM embeddings)"""
SQL["l4_eval_loss_skips"] = f"""WITH {WINDOWS},
vb AS (SELECT x, y, (row_number() OVER (ORDER BY window_idx) - 1) // 4 AS batch_id FROM splits WHERE split = 'val'),
bs AS (SELECT batch_id, sum(list_sum(x)) AS s FROM vb GROUP BY batch_id),
bl AS (SELECT batch_id, avg(ln(1 + t)) AS l FROM (SELECT batch_id, unnest(y) AS t FROM vb) WHERE t <> 0 GROUP BY batch_id)
SELECT round(coalesce(avg(l) FILTER (s % 3 <> 1), 'inf'::DOUBLE), 6) AS val_loss, count(*) FILTER (s % 3 <> 1) AS n_batches,
       count(*) FILTER (s % 3 = 1) AS n_skipped FROM bs LEFT JOIN bl USING (batch_id)"""
SQL["s4_write_prepared"] = f"""WITH {PAIRS}
SELECT row_number() OVER (ORDER BY md5('42|' || idx::VARCHAR), idx) AS line_no, regexp_replace('Q: ' || {strip('question')} || ' A: ' || {strip('answer')},
  '\\r\\n|[\\n\\r\\x{{85}}\\x{{2028}}\\x{{2029}}]', ' ', 'g') AS line FROM pairs"""
SQL["s5_save_load_tokenizer"] = f"""WITH {word_vocab()}
SELECT * FROM (VALUES (0, '<pad>', 'control'), (1, '<unk>', 'unknown'), (2, '<s>', 'control'), (3, '</s>', 'control')) t(id, piece, kind)
UNION ALL SELECT id, word, 'word' FROM vocab"""
SQL["s7_save_load_model"] = f"""SELECT *, 3000::BIGINT AS saved_iter, 1.25::DOUBLE AS best_val_loss, {BLOCK}::BIGINT AS block_size
FROM ({SQL["l1_fit_ngram"]})"""
SQL["s7_resave_model"] = f"""SELECT *, 1500::BIGINT AS saved_iter, 2.0::DOUBLE AS best_val_loss, 2::BIGINT AS n_versions
FROM ({SQL["l1_fit_ngram"]})"""
SQL["st_encode_prompts_stream"] = f"""WITH {word_vocab()},
up AS (SELECT conv_id, turn, 'Q: ' || {strip('text')} || ' A:' AS prompt FROM conversations WHERE role = 'user'),
uw AS (SELECT conv_id, turn, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos
       FROM (SELECT conv_id, turn, {words('prompt')} AS ws FROM up))
SELECT uw.conv_id, uw.turn, string_agg(coalesce(v.id, 1)::VARCHAR, ' ' ORDER BY uw.pos) AS tokens_text
FROM uw LEFT JOIN vocab v USING (word) GROUP BY uw.conv_id, uw.turn"""


# ---- readers and typed validation ----------------------------------------------------------------

READ = f"""WITH {RECS} SELECT idx,
  CASE WHEN error IS NULL OR error <> 'not_object' THEN question END AS question,
  CASE WHEN error IS NULL OR error <> 'not_object' THEN answer END AS answer, error FROM classified"""
SQL["s1_read_qa_json_lines"] = READ
SQL["s1_read_qa_json_array"] = READ
SQL["s1_read_qa_json_single_line"] = READ
SQL["v3_quarantine_malformed"] = f"""WITH {RECS} SELECT idx, CASE WHEN idx % 5 = 0 THEN 'malformed' ELSE error END AS error
  FROM classified WHERE idx % 5 = 0 OR error IS NOT NULL"""
SQL["v4_report_malformed"] = f"""WITH {RECS} SELECT CASE WHEN idx % 5 = 0 THEN 'malformed' ELSE coalesce(error, 'ok') END AS outcome,
  count(*) AS n_records, min(idx) AS first_idx FROM classified GROUP BY 1"""
SQL["st_quarantine_stream"] = f"""WITH {RECS}, c AS (SELECT idx, question, answer, CASE WHEN idx % 7 = 0 THEN 'malformed' ELSE error END AS error FROM classified)
SELECT idx, CASE WHEN error IS NULL THEN question END AS question, CASE WHEN error IS NULL THEN answer END AS answer, error FROM c"""
SQL["v1_classify_typed"] = f"""SELECT u.conv_id, u.turn,
  CASE WHEN a.text IS NULL THEN 'not_string'
       WHEN {strip('u.text')} = '' OR {strip('a.text')} = '' THEN 'empty' END AS error
FROM conversations u LEFT JOIN conversations a
  ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
WHERE u.role = 'user'"""
SQL["v2_assert_valid"] = f"""WITH {RECS} SELECT idx, error, 'record ' || idx || ' rejected (' || error || ')' AS message
  FROM classified WHERE error IS NOT NULL ORDER BY idx LIMIT 1"""

SQL["g9_generate_step"] = f"""WITH {NGRAM},
{PROMPT_PART},
ctx AS (SELECT row_id, CASE WHEN len(tokens) > {BLOCK} THEN tokens[-{BLOCK}:] ELSE tokens END AS c, tokens FROM bos),
last AS (
  SELECT row_id, 3 AS ord, array_to_string(c[-2:], ' ') AS ctx FROM ctx WHERE len(c) >= 2
  UNION ALL SELECT row_id, 2, c[-1]::VARCHAR FROM ctx WHERE len(c) >= 1),
hit AS (SELECT l.row_id, max_by(l.ord, l.ord) AS ord, max_by(l.ctx, l.ord) AS ctx
        FROM last l JOIN tot USING (ord, ctx) GROUP BY l.row_id),
back AS (
  SELECT b.row_id, 2 AS ord, max_by(b.tok::VARCHAR, b.pos) AS ctx FROM (
    SELECT row_id, unnest(c) AS tok, generate_subscripts(c, 1) AS pos FROM ctx
    WHERE row_id NOT IN (SELECT row_id FROM hit)) b
  JOIN tot ON tot.ord = 2 AND tot.ctx = b.tok::VARCHAR GROUP BY b.row_id),
chosen AS (SELECT * FROM hit UNION ALL SELECT * FROM back
  UNION ALL SELECT row_id, 1, '' FROM ctx WHERE row_id NOT IN (SELECT row_id FROM hit) AND row_id NOT IN (SELECT row_id FROM back)),
cand AS (SELECT ch.row_id, c.token, ln(c.n / t.total) / 1.0e0 AS logit
         FROM chosen ch JOIN counts c USING (ord, ctx) JOIN tot t USING (ord, ctx)),
seen AS (SELECT DISTINCT row_id, unnest(tokens) AS token FROM bos),
pen AS (SELECT c.row_id, c.token,
          CASE WHEN s.token IS NULL THEN c.logit WHEN c.logit < 0 THEN c.logit * 1.2e0 ELSE c.logit / 1.2e0 END AS logit
        FROM cand c LEFT JOIN (SELECT * FROM seen WHERE token <> 0) s USING (row_id, token)),
sm AS (SELECT row_id, token, z / sum(z) OVER (PARTITION BY row_id) AS prob FROM (
  SELECT row_id, token, exp(logit - max(logit) OVER (PARTITION BY row_id)) AS z FROM pen)),
kept AS (SELECT row_id, token, prob FROM (
  SELECT *, coalesce(sum(prob) OVER (PARTITION BY row_id ORDER BY prob DESC, token
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM sm) WHERE before <= 0.9e0),
nuc AS (SELECT row_id, token, prob / sum(prob) OVER (PARTITION BY row_id) AS prob FROM kept),
pick AS (
  SELECT row_id, coalesce(min_by(token, pos) FILTER (WHERE cum > u * tot), max_by(token, pos)) AS next_token FROM (
    SELECT row_id, token,
      sum(prob) OVER (PARTITION BY row_id ORDER BY prob DESC, token ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
      sum(prob) OVER (PARTITION BY row_id) AS tot,
      row_number() OVER (PARTITION BY row_id ORDER BY prob DESC, token) AS pos,
      ('0x' || substr(md5('42|' || row_id::VARCHAR || '|0'), 1, 8))::BIGINT / 4294967296.0e0 AS u
    FROM nuc) GROUP BY row_id)
SELECT b.row_id, coalesce(p.next_token, 3) AS next_token FROM bos b LEFT JOIN pick p USING (row_id)"""


# ---- the whole next-token distribution: every id, interpolated as in sc ----------------------------

def _whole(src: str) -> str:
    return f"""hs AS (SELECT row_id, CASE WHEN len(c) >= 1 THEN c[-1]::VARCHAR END AS h2,
              CASE WHEN len(c) >= 2 THEN array_to_string(c[-2:], ' ') END AS h3 FROM {src}),
every AS (SELECT unnest(range(0, v))::INTEGER AS token FROM vv),
whole AS (
  SELECT hs.row_id, every.token,
    (0.01e0 / vv.v + 0.19e0 * coalesce(c1.n, 0) / nn.n
      + CASE WHEN t2.total IS NOT NULL THEN 0.3e0 * coalesce(c2.n, 0) / t2.total ELSE 0 END
      + CASE WHEN t3.total IS NOT NULL THEN 0.5e0 * coalesce(c3.n, 0) / t3.total ELSE 0 END)
    / (0.2e0 + CASE WHEN t2.total IS NOT NULL THEN 0.3e0 ELSE 0 END
             + CASE WHEN t3.total IS NOT NULL THEN 0.5e0 ELSE 0 END) AS p
  FROM hs CROSS JOIN every CROSS JOIN nn CROSS JOIN vv
  LEFT JOIN counts c1 ON c1.ord = 1 AND c1.token = every.token
  LEFT JOIN counts c2 ON c2.ord = 2 AND c2.ctx = hs.h2 AND c2.token = every.token
  LEFT JOIN tot t2 ON t2.ord = 2 AND t2.ctx = hs.h2
  LEFT JOIN counts c3 ON c3.ord = 3 AND c3.ctx = hs.h3 AND c3.token = every.token
  LEFT JOIN tot t3 ON t3.ord = 3 AND t3.ctx = hs.h3)"""


SQL["l2_score_interpolated"] = f"""WITH {NGRAM},
{PROMPT_PART},
asked AS (SELECT row_id, tokens AS c FROM bos UNION ALL SELECT -1, [2, 1, 1]),
{_whole("asked")}
SELECT row_id, token, round(ln(p), 6) AS logit FROM whole"""
SQL["g9_generate_step_interpolated"] = f"""WITH {NGRAM},
{PROMPT_PART},
ctx AS (SELECT row_id, CASE WHEN len(tokens) > {BLOCK} THEN tokens[-{BLOCK}:] ELSE tokens END AS c FROM bos),
{_whole("ctx")},
cand AS (SELECT row_id, token, ln(p) / 1.0e0 AS logit FROM whole),
seen AS (""" + SQL["g9_generate_step"].split("\nseen AS (", 1)[1]


# ---- byte-pair training and encoding by recursive SQL ----------------------------------------------

BPE_SIZE = 200
_O, _C = "\ue000", "\ue001"  # the trainer's symbol marks
BPE_REC = PAIRS + f""",
tt AS (SELECT idx, 'Q: ' || {strip('question')} || ' A: ' || {strip('answer')} AS text FROM pairs),
tw AS (SELECT idx, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM (SELECT idx, {words('text')} AS ws FROM tt)),
wc AS (SELECT regexp_replace(word, '[{_O}{_C}]', '\ufffd', 'g') AS word, count(*) AS n FROM tw GROUP BY 1),
chars AS (SELECT ch, sum(n) AS n FROM (SELECT unnest(string_split('▁' || word, '')) AS ch, n FROM wc) GROUP BY ch),
alpha AS (SELECT ch, row_number() OVER (ORDER BY n DESC, ch) - 1 AS r FROM chars),
nm AS (SELECT {BPE_SIZE} - 4 - count(*) AS n_merges FROM alpha),
w0 AS (SELECT word, '{_O}' || array_to_string(string_split('▁' || word, ''), '{_C}{_O}') || '{_C}' AS w, n FROM wc),
bpe(step, word, w, n, a, b) AS (
  SELECT 0, word, w, n, NULL::VARCHAR, NULL::VARCHAR FROM w0
  UNION ALL
  SELECT step + 1, word, replace(w, '{_O}' || t.a || '{_C}{_O}' || t.b || '{_C}', '{_O}' || t.a || t.b || '{_C}'), n, t.a, t.b
  FROM bpe, (
    SELECT p[1] AS a, p[2] AS b FROM (
      SELECT unnest(list_zip(s[1:len(s) - 1], s[2:len(s)])) AS p, n FROM (
        SELECT regexp_extract_all(w, '{_O}([^{_C}]*){_C}', 1) AS s, n FROM bpe))
    GROUP BY ALL ORDER BY sum(n) DESC, a, b LIMIT 1) t
  WHERE step < (SELECT n_merges FROM nm)),
merges AS (SELECT DISTINCT (step - 1)::INTEGER AS merge_rank, a AS "left", b AS "right", a || b AS piece
           FROM bpe WHERE step > 0),
vocab AS (SELECT ch AS piece, (4 + r)::INTEGER AS id FROM alpha
          UNION ALL SELECT piece, (4 + (SELECT count(*) FROM alpha) + merge_rank)::INTEGER FROM merges),
pid AS (SELECT piece, min(id) AS id FROM vocab GROUP BY piece),
final AS (SELECT word, regexp_extract_all(w, '{_O}([^{_C}]*){_C}', 1) AS syms FROM bpe
          WHERE step = (SELECT max(step) FROM bpe)),
wordids AS (
  SELECT f.word, list(coalesce(p.id, 1) ORDER BY s.k) AS ids FROM final f,
    LATERAL (SELECT unnest(f.syms) AS sym, generate_subscripts(f.syms, 1) AS k) s
    LEFT JOIN pid p ON p.piece = s.sym GROUP BY f.word)"""
SQL["t4_train_bpe_classic"] = f"WITH RECURSIVE {BPE_REC} SELECT merge_rank, \"left\", \"right\", piece FROM merges"
SQL["t6_encode_bpe_classic"] = f"""WITH RECURSIVE {BPE_REC},
rec AS (
  SELECT t.idx, coalesce(flatten(list(wi.ids ORDER BY tw.pos) FILTER (WHERE tw.pos IS NOT NULL)), []) AS tokens
  FROM tt t LEFT JOIN tw ON tw.idx = t.idx
  LEFT JOIN wordids wi ON wi.word = regexp_replace(tw.word, '[{_O}{_C}]', '\ufffd', 'g')
  GROUP BY t.idx)
SELECT idx, len(tokens)::BIGINT AS n_tokens, array_to_string(tokens, ' ') AS tokens_text FROM rec"""


# ---- the generation loop by recursive SQL ------------------------------------------------------------

G9_CAP = 100


def _g9_step(src: str, step: str) -> str:
    """Next token for every row of ``src`` (row_id, seq): the single-step
    composition, as a subquery over the recursive table."""
    return f"""(
  WITH cur AS (SELECT row_id, seq, CASE WHEN len(seq) > {BLOCK} THEN seq[-{BLOCK}:] ELSE seq END AS c FROM {src}),
  last AS (
    SELECT row_id, 3 AS ord, array_to_string(c[-2:], ' ') AS ctx FROM cur WHERE len(c) >= 2
    UNION ALL SELECT row_id, 2, c[-1]::VARCHAR FROM cur WHERE len(c) >= 1),
  hit AS (SELECT l.row_id, max_by(l.ord, l.ord) AS ord, max_by(l.ctx, l.ord) AS ctx
          FROM last l JOIN tot USING (ord, ctx) GROUP BY l.row_id),
  back AS (
    SELECT b.row_id, 2 AS ord, max_by(b.tok::VARCHAR, b.pos) AS ctx FROM (
      SELECT row_id, unnest(c) AS tok, generate_subscripts(c, 1) AS pos FROM cur
      WHERE row_id NOT IN (SELECT row_id FROM hit)) b
    JOIN tot ON tot.ord = 2 AND tot.ctx = b.tok::VARCHAR GROUP BY b.row_id),
  chosen AS (SELECT * FROM hit UNION ALL SELECT * FROM back
  UNION ALL SELECT row_id, 1, '' FROM cur WHERE row_id NOT IN (SELECT row_id FROM hit) AND row_id NOT IN (SELECT row_id FROM back)),
  cand AS (SELECT ch.row_id, c.token, ln(c.n / t.total) / 1.0e0 AS logit
           FROM chosen ch JOIN counts c USING (ord, ctx) JOIN tot t USING (ord, ctx)),
  seen AS (SELECT DISTINCT row_id, unnest(seq) AS token FROM cur),
  pen AS (SELECT c.row_id, c.token,
            CASE WHEN s.token IS NULL THEN c.logit WHEN c.logit < 0 THEN c.logit * 1.2e0 ELSE c.logit / 1.2e0 END AS logit
          FROM cand c LEFT JOIN (SELECT * FROM seen WHERE token <> 0) s USING (row_id, token)),
  sm AS (SELECT row_id, token, z / sum(z) OVER (PARTITION BY row_id) AS prob FROM (
    SELECT row_id, token, exp(logit - max(logit) OVER (PARTITION BY row_id)) AS z FROM pen)),
  kept AS (SELECT row_id, token, prob FROM (
    SELECT *, coalesce(sum(prob) OVER (PARTITION BY row_id ORDER BY prob DESC, token
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM sm) WHERE before <= 0.9e0),
  nuc AS (SELECT row_id, token, prob / sum(prob) OVER (PARTITION BY row_id) AS prob FROM kept)
  SELECT row_id, coalesce(min_by(token, pos) FILTER (WHERE cum > u * tot), max_by(token, pos)) AS next_token FROM (
    SELECT row_id, token,
      sum(prob) OVER (PARTITION BY row_id ORDER BY prob DESC, token ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
      sum(prob) OVER (PARTITION BY row_id) AS tot,
      row_number() OVER (PARTITION BY row_id ORDER BY prob DESC, token) AS pos,
      ('0x' || substr(md5('42|' || row_id::VARCHAR || '|' || {step}::VARCHAR), 1, 8))::BIGINT / 4294967296.0e0 AS u
    FROM nuc) GROUP BY row_id)"""


SQL["g9_generate"] = f"""WITH RECURSIVE {NGRAM},
{PROMPT_PART},
gen(step, row_id, prompt, g, done) AS (
  SELECT 0, row_id, tokens, []::INTEGER[], false FROM bos
  UNION ALL
  SELECT s.step + 1, s.row_id, s.prompt, list_append(s.g, coalesce(p.next_token, 3)::INTEGER),
         coalesce(p.next_token, 3) = 3 OR len(s.g) + 1 >= {G9_CAP}
  FROM gen s LEFT JOIN {_g9_step("(SELECT row_id, prompt || g AS seq FROM gen WHERE NOT done)", "(SELECT max(step) FROM gen)")} p
    USING (row_id)
  WHERE NOT s.done),
fin AS (SELECT row_id, prompt, g FROM gen WHERE done),
allids AS (SELECT row_id, unnest(prompt || g) AS id, generate_subscripts(prompt || g, 1) AS k FROM fin),
names AS (SELECT word, id FROM vocab)
SELECT f.row_id, array_to_string(f.g, ' ') AS answer_ids,
  (SELECT coalesce(string_agg(CASE WHEN i.id = 1 THEN '⁇' ELSE coalesce(n.word, '⁇') END, ' ' ORDER BY i.k), '')
   FROM allids i LEFT JOIN names n ON n.id = i.id WHERE i.row_id = f.row_id AND (i.id >= 4 OR i.id = 1)) AS text
FROM fin f"""


def _g9_whole_step(src: str, step: str) -> str:
    """As ``_g9_step`` with every id of the vocabulary a candidate."""
    head, tail = _g9_step(src, step).split("  last AS (", 1)
    return (head + _whole("cur") + """,
  cand AS (SELECT row_id, token, ln(p) / 1.0e0 AS logit FROM whole),
  seen AS (""" + tail.split("\n  seen AS (", 1)[1])


SQL["g9_generate_interpolated"] = SQL["g9_generate"].replace(
    _g9_step("(SELECT row_id, prompt || g AS seq FROM gen WHERE NOT done)", "(SELECT max(step) FROM gen)"),
    _g9_whole_step("(SELECT row_id, prompt || g AS seq FROM gen WHERE NOT done)", "(SELECT max(step) FROM gen)"))
