"""Registered queries: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.llm import bpe, chat, decontam, divergence, langid, neardup, packing, phrases, pii, quality, rules, secrets, toxicity
from marquee.llm.common import table


def op8_quality_rules(spark, sf_dir):
    return rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_decontamination(spark, sf_dir):
    return decontam.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_chat_formatting(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)],
                                  "conv_id long, turn long, role string, text string")
    return chat.digest(chat.format_conversations(turns.unionByName(extra)))


def _fold(column, n):
    """crc32 of an id as text, modulo n."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def op1_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held = _fold("doc_id", 4) == 2
    model = langid.learn(docs.where(~held))
    return langid.predict(docs, model).select(
        "doc_id", held.alias("held_out"), "lang_pred", "score", "phrase_rate")


def op2_byte_bpe(spark, sf_dir):
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return bpe.tokenize(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN,
                        outputs=("ids_sha256", "decoded_sha256"))


def op3_quality_classifier(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.learn(docs, labels.where(_fold("doc_id", 5) != 0))
    return quality.score(docs, model).select(
        "doc_id", (_fold("doc_id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.learn(docs))


def op5_secret_scan(spark, sf_dir):
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


def op6_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.learn(docs, labels.where(_fold("doc_id", 5) != 0))
    return toxicity.score(docs, model).select(
        "doc_id", (_fold("doc_id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence", "cosines")


def op7_minhash_dedup(spark, sf_dir):
    return neardup.deduplicate(table(spark, sf_dir, "documents"), size=4, percent=80)


def op11_phrase_collocations(spark, sf_dir):
    return phrases.mine(table(spark, sf_dir, "documents"))


def op12_source_divergence(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_packing(spark, sf_dir):
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
                        outputs=("ids_crc32",))


def queries():
    return {
        "op1_language_id": op1_language_id,
        "op2_byte_bpe": op2_byte_bpe,
        "op3_quality_classifier": op3_quality_classifier,
        "op4_pii": op4_pii,
        "op5_secret_scan": op5_secret_scan,
        "op6_toxicity": op6_toxicity,
        "op7_minhash_dedup": op7_minhash_dedup,
        "op8_quality_rules": op8_quality_rules,
        "op9_decontamination": op9_decontamination,
        "op10_chat_formatting": op10_chat_formatting,
        "op11_phrase_collocations": op11_phrase_collocations,
        "op12_source_divergence": op12_source_divergence,
        "op13_packing": op13_packing,
    }
