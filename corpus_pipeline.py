"""The corpus pipeline: ``documents`` in five stages, each applying one operator to all that the stage before kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written and read again before the next.
All but the last return the columns of ``documents``. The numbers are parameters of the operators' modules.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from breakwater.llm import jaccard, lines, mixing, pieces, secrets
from breakwater.llm.common import prepare, shared_folder, table
from breakwater.llm.queries import vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go; documents that break the base rules or lose too much text go."""
    prepare(spark)
    return lines.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked at five-word similarity 0.8 the least row stays; texts without words stay."""
    prepare(spark)
    return jaccard.representatives(docs, words=5, num=80, den=100)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts, their holders counted before copies went; every document stays."""
    prepare(spark)
    return secrets.masked(docs, table(spark, sf_dir, "documents"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed as evenly as reading each at most twice allows; every document stays, some appear twice."""
    prepare(spark)
    return mixing.mixed(docs, mixing.Target(repetition=2.0))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of what they decode to."""
    prepare(spark)
    return pieces.digests(docs, vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("mask_secrets", mask_secrets),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

#: Prefix joins, hashed permutations and the vocabulary are not SQL; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what stands between them is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    base = f"{shared_folder(spark)}/breakwater-pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        found = stage(spark, docs, sf_dir)
        if number + 1 == len(STAGES):
            return found
        place = f"{base}/{number}-{name}"
        found.write.parquet(place)
        docs = spark.read.schema(found.schema).parquet(place)
    return docs
