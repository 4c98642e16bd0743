"""From raw documents to token ids: quality rules, near duplicates, personal data, mixing, encoding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sanitaria.llm.common import table, text_batches, written
from sanitaria.llm.jaccard import one_of_each
from sanitaria.llm.mixing import mixed_documents
from sanitaria.llm.pii import mask_private
from sanitaria.llm.quality import good_documents, train
from sanitaria.llm.queries import MODEL
from sanitaria.llm.sentencepiece import Vocabulary, encode

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the model keep; the model is trained on the labelled documents of ``sf_dir``."""
    text_batches(spark)
    model = train(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return good_documents(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word shingles: the one with the smallest id."""
    return one_of_each(docs)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; ``n_chars`` counts what is left."""
    text_batches(spark)
    return mask_private(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights, 150 % of all words; a document taken twice stands there twice."""
    return mixed_documents(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, ids, n_pieces, decoded_crc32, round_trip`` of each row."""
    text_batches(spark)
    return encode(docs, Vocabulary.load(MODEL))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("private data", private_data),
    ("source mix", source_mix),
    ("pieces", pieces),
]

#: The model of quality, the random field and the piece lattice have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again as the next one's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"corpus-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
