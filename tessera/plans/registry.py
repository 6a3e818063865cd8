"""Registered queries: one per operator of the inventory, each reading the
given tables through ``tessera.plans.inputs`` and running the library's own
operators. Every computed column is aliased to the name its oracle uses."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.config import Config
from tessera.functions.arrays import ints_text
from tessera.functions.text import format_prompt, format_qa, strip_ws
from tessera.operators import bpe as BPE
from tessera.operators import decoding as G
from tessera.operators import ngram as L
from tessera.operators import runlog as R
from tessera.operators import split as SP
from tessera.operators import validate as V
from tessera.operators import vocab as VO
from tessera.operators import windows as W
from tessera.operators.generate import generate
from tessera.operators.infer import batch_losses, infer, mean_loss
from tessera.operators.ordering import global_rank
from tessera.operators.shuffle import sample_input, seeded_shuffle
from tessera.operators.tokenize import decode, encode, ensure_bos
from tessera.plans import corpus, inputs
from tessera.sources import artifacts as A
from tessera.sources.qa import read_qa
from tessera.streaming import prepare as ST

CFG = Config(step_size=128)  # the reference's mains pass step 128
T6_VOCAB = CFG.vocab_size  # total size of the capped word vocabulary in t6/t7

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


# ---- sources, validation, projection ---------------------------------------

@query("s3_pairs_from_turns")
def s3_pairs(spark, d):
    return inputs.qa_pairs(spark, d)


@query("v1_classify_qa")
def v1_classify(spark, d):
    return V.classify_qa(inputs.raw_records(spark, d)).select("idx", "error", "question", "answer")


@query("v3_quarantine_rejected")
def v3_rejected(spark, d):
    _, bad = V.quarantine(V.classify_qa(inputs.raw_records(spark, d)))
    return bad.select("idx", "error")


@query("v3_quarantine_good")
def v3_good(spark, d):
    good, _ = V.quarantine(V.classify_qa(inputs.raw_records(spark, d)))
    return good.select("idx", "question", "answer")


@query("v4_validation_report")
def v4_report(spark, d):
    return V.validation_report(V.classify_qa(inputs.raw_records(spark, d)))


@query("p1_strip_ws")
def p1_strip(spark, d):
    conv = inputs.table(spark, d, "conversations")
    padded = F.concat(F.lit("\u3000\t\u200b"), F.col("text"), F.lit(" \u0085 "))
    return conv.select("conv_id", "turn", strip_ws(padded).alias("stripped"))


@query("p2_has_pair")
def p2_has_pair(spark, d):
    return V.has_pair(V.classify_qa(inputs.raw_records(spark, d))).select("idx")


@query("p3_format_qa")
def p3_format(spark, d):
    return inputs.qa_pairs(spark, d).select("idx", format_qa("question", "answer", strip=True).alias("text"))


@query("p3_format_qa_raw")
def p3_format_raw(spark, d):
    return corpus.training_text(inputs.qa_pairs(spark, d), CFG, strip=False)


@query("p4_format_prompt")
def p4_prompt(spark, d):
    return inputs.prompts(spark, d).select("row_id", format_prompt("question").alias("prompt"))


@query("p5_seeded_shuffle")
def p5_shuffle(spark, d):
    return seeded_shuffle(inputs.qa_pairs(spark, d), "idx", CFG.seed).select("idx", "shuffle_rank")


# ---- tokenizer (word mode) ---------------------------------------------------

def _train_text(spark, d):
    return corpus.training_text(inputs.qa_pairs(spark, d), CFG)


def _word_tok(spark, d, max_size=None, text=None):
    return corpus.word_tokenizer(text if text is not None else _train_text(spark, d), max_size=max_size)


@query("t1_special_tokens")
def t1_specials(spark, d):
    """The vocabulary by kind: the four reserved ids come first and are no words."""
    return _word_tok(spark, d).vocab.groupBy("kind").agg(
        F.count(F.lit(1)).alias("n_pieces"), F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.min("piece").alias("least_piece"))


@query("t2_word_counts")
def t2_counts(spark, d):
    return VO.word_counts(inputs.documents(spark, d), "text")


@query("t3_alphabet")
def t3_alphabet(spark, d):
    return VO.alphabet(VO.word_counts(inputs.documents(spark, d), "text")).select("ch", "n")


@query("t3_alphabet_coverage")
def t3_coverage(spark, d):
    return VO.alphabet(VO.word_counts(inputs.documents(spark, d), "text"), 0.995).select("ch", "n")


@query("t6_encode_word")
def t6_encode(spark, d):
    text = _train_text(spark, d)
    ids = encode(text, _word_tok(spark, d, T6_VOCAB, text))
    return ids.select("idx", F.size("tokens").cast("bigint").alias("n_tokens"), ints_text("tokens").alias("tokens_text"))


@query("t7_decode_word")
def t7_decode(spark, d):
    text = _train_text(spark, d)
    tok = _word_tok(spark, d, T6_VOCAB, text)
    return decode(encode(text, tok), tok)


@query("t8_vocab_size")
def t8_size(spark, d):
    return _word_tok(spark, d).vocab.agg(F.count(F.lit(1)).alias("n_pieces"))


@query("t8_piece_to_id")
def t8_ids(spark, d):
    """Ids of the benchmark's words and of the special pieces."""
    asked = VO.word_counts(inputs.table(spark, d, "benchmark"), "text").select(F.col("word").alias("piece"))
    asked = asked.union(VO.special_tokens(spark).select("piece")).distinct()
    return VO.piece_to_id(asked, _word_tok(spark, d))


def _prompt_ids(spark, d):
    tok = _word_tok(spark, d)
    p = inputs.prompts(spark, d).select("row_id", format_prompt("question").alias("text"))
    return encode(p, tok, key="row_id")


@query("t9_ensure_bos")
def t9_bos(spark, d):
    return ensure_bos(_prompt_ids(spark, d)).select("row_id", ints_text("tokens").alias("tokens_text"))


# ---- dataset building ----------------------------------------------------------

def _ids(spark, d):
    text = _train_text(spark, d)
    return encode(text, _word_tok(spark, d, text=text))


def _windows(spark, d):
    return W.pack_windows(_ids(spark, d), CFG.block_size, CFG.step_size, CFG.pad_id)


@query("d1_global_offsets")
def d1_offsets(spark, d):
    return W.global_offsets(_ids(spark, d)).select("idx", "n", "start")


@query("d2_window_count")
def d2_count(spark, d):
    return W.window_count(_ids(spark, d), CFG.block_size, CFG.step_size)


@query("d3_pack_windows")
def d3_pack(spark, d):
    return _windows(spark, d).select("window_idx", ints_text("x").alias("x_text"), ints_text("y").alias("y_text"))


@query("d6_split_exact")
def d6_split(spark, d):
    return SP.split_exact(_windows(spark, d), CFG.train_ratio, CFG.seed).select("window_idx", "split")


@query("d7_assign_batches")
def d7_batches(spark, d):
    sw = SP.split_exact(_windows(spark, d), CFG.train_ratio, CFG.seed)
    return SP.batch_splits(sw, CFG.batch_size, CFG.seed, epoch=0).select("window_idx", "split", "batch_id", "batch_pos")


@query("d9_pad_batches")
def d9_pad(spark, d):
    p = ensure_bos(_prompt_ids(spark, d))
    return SP.pad_batches(p, CFG.generation_batch_size, CFG.pad_id).select(
        "row_id", "batch_id", ints_text("padded").alias("padded_text"))


@query("d10_pad_mask")
def d10_mask(spark, d):
    m = SP.with_pad_mask(_windows(spark, d), "x", CFG.pad_id)
    bits = F.array_join(F.transform("mask", lambda b: F.when(b, "1").otherwise("0")), "")
    return m.select("window_idx", bits.alias("mask_bits"))


@query("d11_positions")
def d11_positions(spark, d):
    return SP.positions(_windows(spark, d), "x").select("window_idx", F.col("pos").cast("bigint"), F.col("token").cast("bigint"))


@query("window_stats")
def window_stats(spark, d):
    pairs = inputs.qa_pairs(spark, d)
    tok = _word_tok(spark, d, text=corpus.training_text(pairs, CFG))
    return corpus.window_stats(pairs, CFG, tok)


# ---- decoding over logits tables -------------------------------------------------


G_TEMPERATURE = 0.7
G_SEEN_BELOW = -0.1  # stand-in seen set: a row's tokens with logit below this


def _r6(c):
    return F.round(F.col(c), 6).alias(c)


def _seen(lg):
    return lg.filter(F.col("logit") < G_SEEN_BELOW).select("row_id", "token")


@query("g1_temperature")
def g1_temperature(spark, d):
    return G.temperature(inputs.logits(spark, d), G_TEMPERATURE).select("row_id", "token", _r6("logit"))


@query("g2_repetition_penalty")
def g2_penalty(spark, d):
    lg = inputs.logits(spark, d)
    return G.repetition_penalty(lg, _seen(lg), CFG.repetition_penalty, "divide").select("row_id", "token", _r6("logit"))


@query("g2_repetition_penalty_sign_aware")
def g2_penalty_sign(spark, d):
    lg = inputs.logits(spark, d)
    return G.repetition_penalty(lg, _seen(lg), CFG.repetition_penalty, "sign_aware").select(
        "row_id", "token", _r6("logit"))


@query("g3_softmax")
def g3_softmax(spark, d):
    return G.softmax(inputs.logits(spark, d)).select("row_id", "token", _r6("prob"))


def _nucleus(spark, d):
    lg = G.temperature(inputs.logits(spark, d), G_TEMPERATURE)
    return G.top_p(G.softmax(lg), CFG.top_p)


@query("g4_top_p")
def g4_top_p(spark, d):
    return _nucleus(spark, d).select("row_id", "token", _r6("prob"))


@query("g6_sample_token")
def g6_sample(spark, d):
    return G.sample_token(_nucleus(spark, d), CFG.seed, 0)


def _ranked_tokens(spark, d):
    lg = inputs.logits(spark, d)
    seq = F.transform(F.array_sort(F.collect_list(F.struct(-F.col("logit"), F.col("token")))), lambda s: s["token"])
    return lg.groupBy("row_id").agg(seq.alias("tokens"))


@query("g7_truncate_context")
def g7_truncate(spark, d):
    return G.truncate_context(_ranked_tokens(spark, d), 16).select("row_id", ints_text("tokens").alias("tokens_text"))


@query("g8_trim_at_eos")
def g8_trim(spark, d):
    return G.trim_at_eos(_ranked_tokens(spark, d), CFG.eos_id).select("row_id", ints_text("tokens").alias("tokens_text"))


# ---- run-log analysis --------------------------------------------------------------

R_EVERY = 5  # evaluation interval used on the event log


def _log(spark, d):
    return R.number_iters(inputs.run_log(spark, d), ["ts", "event_id"]).select("run_id", "iter", "val_loss")


@query("r1_eval_points")
def r1_eval(spark, d):
    return R.eval_points(_log(spark, d), R_EVERY, include_last=True).select("run_id", "iter", "val_loss")


@query("r2_mark_improved")
def r2_improved(spark, d):
    m = R.mark_improved(_log(spark, d))
    return m.select("run_id", "iter", F.col("improved").cast("int").alias("improved"), "best_so_far")


@query("r3_early_stop")
def r3_stop(spark, d):
    s = R.early_stop(_log(spark, d), CFG.patience_early_stopping)
    return s.select("run_id", "iter", "since", F.col("stopped_here").cast("int").alias("stopped_here"))


def _diverged(spark, d):
    """The log with evaluations that diverged: +inf at the start of some runs, NaN now and then."""
    bad = (F.when(F.col("iter") < F.col("run_id") % 3, F.lit(float("inf")))
           .when((F.col("iter") + F.col("run_id")) % 7 == 0, F.lit(float("nan"))))
    return _log(spark, d).withColumn("val_loss", F.coalesce(bad, F.col("val_loss")))


@query("r2_mark_improved_inf")
def r2_improved_inf(spark, d):
    best = F.when(F.col("best_so_far") < float("inf"), F.col("best_so_far"))
    return R.mark_improved(_diverged(spark, d)).select("run_id", "iter", F.col("improved").cast("int").alias("improved"), best.alias("best_so_far"))


@query("r3_early_stop_inf")
def r3_stop_inf(spark, d):
    s = R.early_stop(_diverged(spark, d), CFG.patience_early_stopping)
    return s.select("run_id", "iter", "since", F.col("stopped_here").cast("int").alias("stopped_here"))


@query("r5_best_checkpoint")
def r5_best(spark, d):
    return R.best_checkpoint(R.early_stop(_log(spark, d), CFG.patience_early_stopping))


# ---- n-gram language model -----------------------------------------------------------



def _lm_parts(spark, d):
    text = _train_text(spark, d)
    tok = _word_tok(spark, d, text=text)
    ids = encode(text, tok)
    wins = W.pack_windows(ids, CFG.block_size, CFG.step_size, CFG.pad_id)
    sw = SP.split_exact(wins, CFG.train_ratio, CFG.seed)
    lm = L.fit_ngram(sw.filter(F.col("split") == "train"), CFG.ngram_order, tok.size, CFG.ngram_lambdas)
    return tok, sw, lm


@query("l1_fit_ngram")
def l1_fit(spark, d):
    _, _, lm = _lm_parts(spark, d)
    return lm.counts.select(F.col("order").alias("ctx_order"), "ctx", "token", "n")


@query("l3_token_loss")
def l3_loss(spark, d):
    _, sw, lm = _lm_parts(spark, d)
    return L.token_loss(sw.filter(F.col("split") == "val"), lm).select(_r6("loss"), "n_targets")


@query("l4_eval_loss")
def l4_eval(spark, d):
    _, sw, lm = _lm_parts(spark, d)
    val = SP.assign_batches(sw.filter(F.col("split") == "val"), CFG.batch_size, shuffle=False)
    return L.eval_loss(val, lm).select(_r6("val_loss"), "n_batches")


def _asked(spark, d):
    ctx = ensure_bos(_prompt_ids(spark, d)).select("row_id", "tokens")
    # and one prompt of which no id was ever seen
    unseen = spark.range(1).select(F.lit(-1).cast("bigint").alias("row_id"), F.array(F.lit(CFG.bos_id), F.lit(VO.UNK), F.lit(VO.UNK)).alias("tokens"))
    return ctx.unionByName(unseen)


@query("l2_score_next")
def l2_score(spark, d):
    _, _, lm = _lm_parts(spark, d)
    return L.score_next(_asked(spark, d), lm).select("row_id", "token", _r6("logit"), "ctx_order")


@query("l2_score_interpolated")
def l2_interpolated(spark, d):
    """The whole vocabulary for every prompt, with L3's probabilities."""
    _, _, lm = _lm_parts(spark, d)
    return L.score_interpolated(_asked(spark, d), lm).select("row_id", "token", _r6("logit"))


# ---- byte-pair tokenizer ------------------------------------------------------------------


BPE_CLASSIC = 200  # specials + alphabet + merges of the queries that SQL replays merge by merge
T5_SAMPLE = 100


def _tok_text(spark, d):
    """Tokenizer input: pairs formatted with stripped fields (preprocessing path)."""
    return inputs.qa_pairs(spark, d).select("idx", format_qa("question", "answer", strip=True).alias("text"))


def _bpe_tok(spark, d):
    """The configured size (or every piece the corpus supports)."""
    return BPE.train_bpe(VO.word_counts(_tok_text(spark, d)), CFG.vocab_size, allow_smaller=True)


def _bpe_classic(spark, d):
    """The first pieces, for the comparison with SQL, which replays one merge a round."""
    return BPE.train_bpe(VO.word_counts(_tok_text(spark, d)), BPE_CLASSIC)


@query("t4_bpe_pair_counts")
def t4_pairs(spark, d):
    wc = VO.word_counts(inputs.documents(spark, d), "text")
    return BPE.pair_counts(wc.select(BPE._marked(F.col("word")).alias("w"), "n")).select(
        "a", "b", F.col("cnt").cast("bigint").alias("cnt"))


@query("t4_train_bpe")
def t4_train(spark, d):
    return _bpe_tok(spark, d).merges.select("merge_rank", "left", "right", "piece")


@query("t4_train_bpe_classic")
def t4_train_classic(spark, d):
    return _bpe_classic(spark, d).merges.select("merge_rank", "left", "right", "piece")


@query("t5_sample_input")
def t5_sample(spark, d):
    return sample_input(inputs.qa_pairs(spark, d), "idx", T5_SAMPLE, CFG.seed).select("idx")


@query("t6_encode_bpe")
def t6_encode_bpe(spark, d):
    ids = encode(_tok_text(spark, d), _bpe_tok(spark, d))
    return ids.select("idx", F.size("tokens").cast("bigint").alias("n_tokens"), ints_text("tokens").alias("tokens_text"))


@query("t6_encode_bpe_classic")
def t6_encode_bpe_classic(spark, d):
    ids = encode(_tok_text(spark, d), _bpe_classic(spark, d))
    return ids.select("idx", F.size("tokens").cast("bigint").alias("n_tokens"), ints_text("tokens").alias("tokens_text"))


@query("t7_decode_bpe")
def t7_decode_bpe(spark, d):
    tok = _bpe_tok(spark, d)
    return decode(encode(_tok_text(spark, d), tok), tok)


# ---- generation, inference, artifacts -------------------------------------------------------


@query("g9_generate")
def g9_generate(spark, d):
    tok, _, lm = _lm_parts(spark, d)
    out = generate(inputs.prompts(spark, d), lm, tok, CFG, scores="backoff")  # as its SQL; up to CFG.max_generate_length new ids
    return out.select("row_id", ints_text("answer_ids").alias("answer_ids"), "text")


@query("g9_generate_interpolated")
def g9_generate_interpolated(spark, d):
    """The whole loop on the whole distribution, drawn without writing it out."""
    tok, _, lm = _lm_parts(spark, d)
    out = generate(inputs.prompts(spark, d), lm, tok, CFG)
    return out.select("row_id", ints_text("answer_ids").alias("answer_ids"), "text")


def _mean_model():
    """A user's model: the mean of each input vector."""
    def predict(x):
        return x.mean(axis=1)
    return predict


@query("l5_infer")
def l5_infer(spark, d):
    emb = inputs.table(spark, d, "embeddings").select(
        "vec_id", F.transform("embedding", lambda v: v.cast("double")).alias("x"))
    out = infer(emb, _mean_model, "x", batch_size=CFG.generation_batch_size, input_length=64)
    return out.select("vec_id", _r6("prediction"))


def _picky_model():
    """A user's model that cannot do with vectors of a positive mean."""
    def predict(x):
        if x.mean() > 0:
            raise ValueError("positive mean")
        return x.mean(axis=1)
    return predict


@query("l5_infer_skips")
def l5_skips(spark, d):
    """Batch inference that goes on where the model fails, a vector a batch."""
    emb = inputs.table(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda v: v.cast("double")).alias("x"))
    return infer(emb, _picky_model, "x", batch_size=1, input_length=64, on_error="skip").select("vec_id", _r6("prediction"), "error")


def _picky_loss():
    """A user's loss: mean ln(1 + y) over the real targets; it fails on some batches."""
    def loss(x, y):
        if x.sum() % 3 == 1:
            raise ValueError("odd batch")
        return np.log1p(y[y != CFG.pad_id]).mean()
    return loss


@query("l4_eval_loss_skips")
def l4_skips(spark, d):
    """Validation by batches with a user's loss, without the batches on which it fails."""
    _, sw, _ = _lm_parts(spark, d)
    val = SP.assign_batches(sw.filter(F.col("split") == "val"), CFG.generation_batch_size, shuffle=False)
    return mean_loss(batch_losses(val, _picky_loss)).select(_r6("val_loss"), "n_batches", "n_skipped")


@query("s4_write_prepared")
def s4_write(spark, d):
    recs = seeded_shuffle(_tok_text(spark, d), "idx", CFG.seed)
    path = A.shared_path(spark, "prepared")
    A.write_prepared(recs, path)
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("f"), F.monotonically_increasing_id().alias("r"), "value")
    return global_rank(lines, ["f", "r"], "line_no").select("line_no", F.col("value").alias("line"))


@query("s5_save_load_tokenizer")
def s5_tokenizer(spark, d):
    tok = _word_tok(spark, d)
    path = A.shared_path(spark, "tokenizer")
    A.save_tokenizer(tok, path)
    return A.load_tokenizer(spark, path).vocab.select("id", "piece", "kind")


@query("s7_save_load_model")
def s7_model(spark, d):
    _, _, lm = _lm_parts(spark, d)
    path = A.shared_path(spark, "model")
    A.save_model(lm, path, {"iter": 3000, "best_val_loss": 1.25, "config": {"block_size": CFG.block_size}})
    back, it, best = A.load_model(spark, path)
    config = A.model_config(spark, path)
    return back.counts.select(F.col("order").alias("ctx_order"), "ctx", "token", "n", F.lit(it).cast("bigint").alias("saved_iter"),
                              F.lit(best).alias("best_val_loss"), F.lit(config["block_size"]).cast("bigint").alias("block_size"))


@query("s7_resave_model")
def s7_resave(spark, d):
    """The resume flow: a model is loaded, saved where it came from, and loaded again."""
    _, _, lm = _lm_parts(spark, d)
    path = A.shared_path(spark, "model")
    A.save_model(lm, path, {"iter": 1000, "best_val_loss": 2.5})
    first, it, best = A.load_model(spark, path)
    A.save_model(first, path, {"iter": it + 500, "best_val_loss": best - 0.5})
    second, it, best = A.load_model(spark, path)
    return second.counts.select(F.col("order").alias("ctx_order"), "ctx", "token", "n", F.lit(it).cast("bigint").alias("saved_iter"),
                                F.lit(best).alias("best_val_loss"), F.lit(len(A.versions(spark, path))).cast("bigint").alias("n_versions"))


# ---- streaming ---------------------------------------------------------------------------------



@query("st_quarantine_stream")
def st_quarantine(spark, d):
    """Raw records as a stream of files, every seventh cut short, into two sinks."""
    raw = inputs.raw_records(spark, d).select("idx", F.to_json("value").alias("value"))
    cut = F.when(F.col("idx") % 7 == 0, F.substring("value", 1, 3)).otherwise(F.col("value"))
    source, good, rejected, ckpt = (A.shared_path(spark, f"quarantine-{x}") for x in ("in", "good", "rejected", "ckpt"))
    raw.select("idx", cut.alias("value")).repartitionByRange(3, "idx").write.parquet(source)
    ST.quarantine_batches(ST.stream_table(spark, source, "idx BIGINT, value STRING"), good, rejected, ckpt).awaitTermination()
    ok = spark.read.parquet(good).select("idx", "question", "answer", F.lit(None).cast("string").alias("error"))
    return ok.unionByName(spark.read.parquet(rejected).select("idx", "error"), allowMissingColumns=True)


@query("st_encode_prompts_stream")
def st_encode(spark, d):
    conv = inputs.table(spark, d, "conversations")
    tok = _word_tok(spark, d)
    stream = ST.prompt_records(ST.stream_table(spark, d, conv.schema, "conversations.parquet"))
    sink, ckpt = A.shared_path(spark, "stream-out"), A.shared_path(spark, "stream-ckpt")
    ST.encode_batches(stream, tok, sink, ckpt).awaitTermination()
    return spark.read.parquet(sink).select("conv_id", "turn", "tokens_text")


# ---- readers and typed validation ----------------------------------------------------------------



def _read_back(raw, path, fmt):
    return V.classify_qa(read_qa(raw.sparkSession, path, fmt=fmt)).select("idx", "question", "answer", "error")


def _write_lines(lines, path):
    """Lines in ``idx`` order over many files."""
    lines.orderBy("idx").select("line").write.mode("overwrite").text(path)


@query("s1_read_qa_json_lines")
def s1_read_jsonl(spark, d):
    """Raw records written as JSON lines, read back with their positions and validated."""
    path = A.shared_path(spark, "records-jsonl")
    raw = inputs.raw_records(spark, d)
    _write_lines(raw.select("idx", F.to_json("value").alias("line")), path)
    return _read_back(raw, path, "json_lines")


@query("s1_read_qa_json_array")
def s1_read_array(spark, d):
    """Raw records written as files that hold one JSON array each (64 records, two to a
    line), read back with their positions and validated."""
    path = A.shared_path(spark, "records-array")
    raw = inputs.raw_records(spark, d)
    js = raw.select("idx", F.to_json("value").alias("v"), F.lpad(F.floor(F.col("idx") / 64).cast("string"), 12, "0").alias("chunk"))
    sep = F.when(F.col("idx") % 2 == 0, F.lit(", ")).otherwise(F.lit(",\n"))
    files = js.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("idx", "v", sep.alias("sep")))).alias("r"))
    body = F.array_join(F.transform("r", lambda x, i: F.concat(F.when(i > 0, x["sep"]).otherwise(F.lit("")), x["v"])), "")
    files.select(F.concat(F.lit("["), body, F.lit("]")).alias("line"), "chunk").write.partitionBy("chunk").mode("overwrite").text(path)
    return _read_back(raw, path, "json_array")


def _write_single_lines(raw, path, size=100_000):
    """Records as files without any line break, one JSON array each, ``size`` records to a file."""
    js = raw.select("idx", F.to_json("value").alias("v"), F.lpad(F.floor(F.col("idx") / size).cast("string"), 12, "0").alias("chunk"))
    # numbers have no gaps, so the last one tells where every file ends: no join on the chunk
    # stands before the repartition, which may be left out and the join's rows dealt otherwise
    last = F.broadcast(raw.agg(F.max("idx").alias("last")))
    ends = (F.col("idx") % size == size - 1) | (F.col("idx") == F.col("last"))
    line = F.concat(F.when(F.col("idx") % size == 0, "[").otherwise(""), "v", F.when(ends, "]").otherwise(","))
    rows = js.crossJoin(last).select("idx", "chunk", line.alias("line"))
    (rows.repartition("chunk").sortWithinPartitions("chunk", "idx").select("line", "chunk")
     .write.partitionBy("chunk").mode("overwrite").option("lineSep", " ").text(path))


@query("s1_read_qa_json_single_line")
def s1_read_single_line(spark, d):
    """Raw records written as JSON arrays without any line break (a file for each 100,000
    records), read back in small byte ranges with their positions and validated."""
    path = A.shared_path(spark, "records-single-line")
    raw = inputs.raw_records(spark, d)
    _write_single_lines(raw, path)
    return _read_back(raw, path, "json_array")


def _with_malformed(spark, d):
    """The raw records as JSON lines of which every fifth is cut short, read back."""
    path = A.shared_path(spark, "records-malformed")
    js = F.to_json("value")
    cut = F.when(F.col("idx") % 5 == 0, F.concat(F.lit("{"), F.substring(js, 1, 4))).otherwise(js)
    _write_lines(inputs.raw_records(spark, d).select("idx", cut.alias("line")), path)
    return V.classify_qa(read_qa(spark, path, fmt="json_lines"))


@query("v3_quarantine_malformed")
def v3_malformed(spark, d):
    _, bad = V.quarantine(_with_malformed(spark, d))
    return bad.select("idx", "error")


@query("v4_report_malformed")
def v4_malformed(spark, d):
    return V.validation_report(_with_malformed(spark, d))


@query("v1_classify_typed")
def v1_typed(spark, d):
    conv = inputs.table(spark, d, "conversations")
    user = conv.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    asst = conv.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    typed = user.join(asst, ["conv_id", "turn"], "left")
    return V.classify_typed(typed).select("conv_id", "turn", "error")


@query("v2_assert_valid")
def v2_assert(spark, d):
    """The record on which the corpus fails, and what the failure says; the good records pass."""
    classified = V.classify_qa(inputs.raw_records(spark, d))
    V.assert_valid(V.classify_typed(V.quarantine(classified)[0]))
    said = None
    try:
        V.assert_valid(classified.drop("value"))
    except ValueError as e:
        said = str(e)
    return V.first_bad(classified).select("idx", "error", F.lit(said).cast("string").alias("message"))


def _one_step(spark, d, scores):
    from tessera.operators.generate import generate_ids
    tok, _, lm = _lm_parts(spark, d)
    p = inputs.prompts(spark, d).select("row_id", format_prompt("question").alias("text"))
    ids = encode(p, tok, "text", "row_id")
    out = generate_ids(ids, lm, CFG, "row_id", "tokens", max_new=1, scores=scores)
    return out.select("row_id", F.element_at("gen", 1).alias("next_token"))


@query("g9_generate_step")
def g9_step(spark, d):
    """One generation step for every benchmark prompt: the composition
    L2 -> G1 -> G2 -> G3 -> G4/G5 -> G6 that each step of G9 runs."""
    return _one_step(spark, d, "backoff")


@query("g9_generate_step_interpolated")
def g9_step_interpolated(spark, d):
    """The same step on the whole distribution."""
    return _one_step(spark, d, "interpolated")
