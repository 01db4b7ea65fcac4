"""Corpus pipeline: five stages over ``documents``, each written as Parquet in
the cluster's shared folder and read back as the next one's input.

1. language_id: documents that nearest-centroid identification rejects go.
2. near_dedup: of each group of near copies the one with the smallest id stays.
3. suffix_dedup: byte strings of 200 or more that occur twice are taken out of
   the texts; every document stays.
4. decontaminate: documents that a benchmark window occurs in go.
5. bpe: every remaining text is encoded; the last stage's columns are doc_id,
   ids, n_tokens, ids_sha256 and decoded_sha256.

Defined cases: a null text, or one without a letter, has no language and goes at
stage 1; of rows that repeat an id and a text all that stage 2 keeps one of stay
(they are one document); a null id takes part and is kept if no row with an id is
in its group; a text from which stage 3 takes all is the empty text and has no
ids; without a benchmark stage 4 keeps all; an empty table gives an empty result;
further columns pass through stages 1 to 4.

Stages 1 to 4 return the columns of documents.  ``ORACLE_SQL`` is None: SQL
cannot express stages 1 and 5; the tests compare with brute force instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quayside.llm import bpe, common, decontaminate, langid, neardup, suffixdedup

#: Near copies share at least 80 % of their five-word sequences.
WORDS, PERCENT = 5, 80

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.predicted(docs, langid.learned(docs), stay=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs, shingle=WORDS, percent=PERCENT)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffixdedup.without_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_contaminated(docs, common.table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("decontaminate", decontamination),
    ("bpe", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
