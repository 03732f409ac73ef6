"""Corpus pipeline: quality rules, near-duplicates, decontamination,
personal data, byte-level BPE.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and read again as the
next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.llm import bpe, decontam, neardup, pii, rules
from marquee.llm.common import materialize, table


# pieces that byte_bpe remembers: its workers follow four stages in executors
# whose heaps are full by then
MEMO = 50_000


def quality_rules(spark, docs, sf_dir):
    """Documents that fail the base rule or a certified cutoff go."""
    return rules.filter_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark, docs, sf_dir):
    """Of every group of near copies (five-word shingles, similarity 0.8)
    the document of smallest id stays."""
    return neardup.keep_one(docs, size=5, percent=80)


def decontamination(spark, docs, sf_dir):
    """Documents that hold a window of a benchmark item go."""
    return decontam.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark, docs, sf_dir):
    """Personal data becomes a mark of its kind; every document stays."""
    masked = pii.mask(docs, pii.learn(docs))
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.when(
            F.col("text").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType))
            .otherwise(F.col("n_chars")))
    return masked


def byte_bpe(spark, docs, sf_dir):
    """Token ids of every text, with digests of the ids and of what they
    decode to."""
    import public_tokenizers

    return bpe.tokenize(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN,
                        outputs=("ids", "ids_sha256", "decoded_sha256"), memo=MEMO)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("byte_bpe", byte_bpe),
]


def run(spark, sf_dir):
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


# no SQL for certified cutoffs, a trained tagger and BPE merges; tested
# against a brute-force version
ORACLE_SQL = None
