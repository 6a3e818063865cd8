"""Answer generation for a table of prompts.

The loop runs on the driver over steps only (at most ``max_new`` of them);
the rows are a DataFrame ``key, prompt, gen``. Each step: context = the last
``block_size`` ids (G7) -> next-token candidates (L2) -> temperature (G1) ->
repetition penalty (G2) -> softmax (G3) -> nucleus (G4, G5) -> seeded sample
(G6) -> append; rows that drew eos or reached the cap leave the active set
(G8). The active set is checkpointed every step, so lineage stays one step
deep and a lost executor costs one step.

Candidates are all ids under the interpolated model that L3 and L4 report the loss
of. By default the distribution is not written out: a row brings the few ids whose
probability is not the shared order-1 one, and the token is drawn from the merge of
the two (``sparse_scores``). ``scores='dense'`` writes a row per id (so does the
default where the vocabulary exceeds the broadcast bound), ``scores='backoff'`` takes
the continuations of one context only (``score_next``).
``max_new`` 0 generates nothing. Output text is the decoded prompt ids plus new ids, so the prompt is
echoed (G10).
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.config import Config
from tessera.functions.arrays import ensure_bos, truncate_context
from tessera.functions.text import format_prompt
from tessera.operators import decoding as G
from tessera.operators import sparse_scores
from tessera.operators.ngram import NgramModel, score_interpolated, score_next
from tessera.operators.tokenize import decode, encode
from tessera.operators.vocab import Tokenizer
from tessera.session import cut_lineage


COUNT_EVERY = 8  # steps between looks at whether any row is left


def _union(parts: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, parts)


def generate_ids(prompt_ids: DataFrame, lm: NgramModel, cfg: Config = Config(), key: str = "row_id",
                 tokens: str = "tokens", max_new: int | None = None, seen_mode: str = "all",
                 scores: str = "interpolated") -> DataFrame:
    """``key, prompt, gen``: new ids per prompt row (G9 on ids).

    ``seen_mode`` picks the ids a repetition penalty applies to: ``all``
    (prompt and generated ids, the base script) or ``generated`` (bos and
    generated ids, the improved script). ``scores`` picks the next-token
    distribution: ``interpolated`` (all ids, L3's probabilities), ``dense`` (the same,
    written out) or ``backoff``.
    """
    if scores not in ("interpolated", "dense", "backoff"):
        raise ValueError("scores is 'interpolated', 'dense' or 'backoff'")
    def score(ctx: DataFrame) -> DataFrame:
        if scores == "backoff":  # an id of the context and its ends ask for a context each
            return score_next(ctx, lm, key, "ctx", n_active * (cfg.block_size + lm.order))
        return score_interpolated(ctx, lm, key, "ctx")

    if seen_mode not in ("all", "generated"):
        raise ValueError("seen_mode is 'all' or 'generated'")
    cap = cfg.max_generate_length if max_new is None else max_new
    base = sparse_scores.shared_base(lm) if scores == "interpolated" else None
    shared = None if base is None else prompt_ids.sparkSession.sparkContext.broadcast(sparse_scores.Shared(base, cfg.temperature))
    active = cut_lineage(prompt_ids.select(
        key, ensure_bos(tokens, cfg.bos_id).alias("prompt"), F.array().cast("array<int>").alias("gen")))
    done_parts = []
    n_active = active.count()
    for step in range(cap):
        if n_active == 0:
            break
        seen_ids = (F.concat("prompt", "gen") if seen_mode == "all"
                    else F.concat(F.array(F.lit(cfg.bos_id)), "gen"))
        if shared is not None:
            met = F.filter(seen_ids, lambda t: t != cfg.pad_id)
            upd = sparse_scores.next_tokens(active, lm, shared, cfg, met, key, n_active)
        else:
            ctx = active.select(key, truncate_context(F.concat("prompt", "gen"), cfg.block_size).alias("ctx"))
            cand = G.temperature(score(ctx), cfg.temperature)
            seen = active.select(key, F.explode(seen_ids).alias("token")).filter(F.col("token") != cfg.pad_id)
            cand = G.repetition_penalty(cand, seen, cfg.repetition_penalty, cfg.penalty_mode, key)
            kept = G.top_p(G.softmax(cand, key), cfg.top_p, key)
            nxt = G.sample_token(kept, cfg.seed, step, key)
            upd = active.join(nxt, key, "left").withColumn(
                "next", F.coalesce(F.col("next_token"), F.lit(cfg.eos_id)).cast("int"))
        upd = upd.select(key, "prompt", F.concat("gen", F.array("next")).alias("gen"),
                         ((F.col("next") == cfg.eos_id) | (F.size("gen") + 1 >= cap)).alias("done"))
        upd = cut_lineage(upd)  # one write per step; both parts read it
        done_parts.append(upd.filter("done").drop("done"))
        active = upd.filter(~F.col("done")).drop("done")
        if step % COUNT_EVERY == COUNT_EVERY - 1:  # the rows left never grow, so an old count is a bound
            n_active = active.count()
            done_parts = [cut_lineage(_union(done_parts))]  # the plan stays short however many steps there are
    return _union([active, *done_parts])


def generate(prompts: DataFrame, lm: NgramModel, tok: Tokenizer, cfg: Config = Config(), key: str = "row_id",
             question: str = "question", max_new: int | None = None, seen_mode: str = "all",
             scores: str = "interpolated") -> DataFrame:
    """``key, answer_ids, text`` for a table of questions.

    Prompts are ``Q: {question} A:`` (P4), encoded (T6) with bos prepended
    (T9). A single prompt is a one-row table.
    """
    p = prompts.select(key, format_prompt(question).alias("text"))
    ids = encode(p, tok, "text", key)
    res = generate_ids(ids, lm, cfg, key, "tokens", max_new, seen_mode, scores)
    full = res.select(key, "gen", F.concat("prompt", "gen").alias("all_ids"))
    text = decode(full, tok, "all_ids", key)
    return full.join(text, key).select(key, F.col("gen").alias("answer_ids"), "text")
