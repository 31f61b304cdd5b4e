"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a table that is written and read again as the next one's ``docs``; it
works on all that its predecessor kept. All but the last return the columns of ``documents``.

Defined results: a null or empty text is never toxic, a duplicate or contaminated, holds no personal data, and is packed as its end id alone; a null text
stays null until it is packed. A null doc_id is carried along, and such a row is no duplicate of another. Rows that repeat a doc_id count as one document for
duplicates, so they go or stay together, and are packed each. Of a group of duplicates the smallest doc_id stays. Columns beyond those of ``documents`` are
carried through all stages but the last, whatever they are called. An empty table stays empty; without labels nothing is toxic, without benchmark
items nothing is contaminated.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm.common import cut, shielded, table
from tallybook.llm.decontaminate import remove_overlap
from tallybook.llm.near_dedup import drop_near_duplicates
from tallybook.llm.packing import default_tokenizer, pack
from tallybook.llm.pii import replace_entities
from tallybook.llm.toxicity import held_out, toxicity_scores


def _recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now, if there is such a column."""
    if "n_chars" not in docs.columns:
        return docs
    kind = dict(docs.dtypes)["n_chars"]
    return docs.withColumn("n_chars", F.char_length("text").cast(kind))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    docs, named_back = shielded(docs, {"score", "predicted", "n_words", "n_hits", "_t"})
    scored = toxicity_scores(docs, table(spark, sf_dir, "labels"), train=~held_out("_id"))
    return named_back(scored.where("predicted = 0").select(*[F.col(f"`{c}`") for c in docs.columns]))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest doc_id of each group of near duplicates."""
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark; those that are mostly such passages go."""
    return _recounted(remove_overlap(docs, table(spark, sf_dir, "benchmark")))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates in place of personal data."""
    return _recounted(replace_entities(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in training sequences."""
    return pack(docs, default_tokenizer()).withColumn("ids_crc32", F.crc32("ids"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("pii", pii),
    ("packing", packing),
]

#: Learned scores, sketches and a tokenizer have no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n + 1 < len(STAGES):
            docs = cut(docs)
    return docs
