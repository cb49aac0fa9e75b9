"""The corpus pipeline over ``documents``: filter, dedup, mask, mix, pack.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and is written
as Parquet before the next one reads it. All but the last return the columns of ``documents``, extra
ones included, whatever their names. An empty table stays empty through all of them.
"""

from __future__ import annotations

import posixpath
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from courtlake.llm import bagminhash, mixing, packing, personal_data, toxicity
from courtlake.llm.common import shared_path, table

#: A quarter of a small source's tokens may be shown a second time.
MAX_REPEATS = 1.25
#: Workers that have served the other stages have less memory left than those of packing alone.
PACKED_AT_ONCE = 4 << 20


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic, repeated rows alike.

    Null, empty and very long texts are scored like others. Labels of one class alone, or none, give
    no classifier, and all documents stay.
    """
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the least doc_id, of equal ids one.

    Null, empty and blank texts are no copies of each other and stay.
    """
    return bagminhash.keep_one(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, personal data replaced by the name of its kind; null texts stay null."""
    return personal_data.masked(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once; small sources again, as far as ``MAX_REPEATS`` lets them.

    A null source is a source. Documents without a token are shown once an epoch; equal rows share
    their place, so a last part of an epoch shows all or none of them.
    """
    return mixing.mix(docs, max_repeats=MAX_REPEATS, places=False)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each with its sequence and its place there.

    A null or empty text is one piece of its end token; texts beyond a sequence are cut.
    """
    return packing.pack(docs, slice_bytes=PACKED_AT_ONCE)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("near_copies", without_near_copies),
    ("personal_data", without_personal_data),
    ("mixing", mixed_sources),
    ("packing", packed),
]

#: Trained models, signatures and tokenisers cannot be written in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    root = shared_path(spark, "pipeline")
    for name, stage in STAGES:
        path = posixpath.join(root, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
