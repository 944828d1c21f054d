"""The queries of this package, with the SQL that checks them where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from breakwater.llm import ctw, fingerprints, jaccard, lines, mixing, negatives, passages, pieces, repeats, search, secrets, shards, urls
from breakwater.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded and decoded again."""
    return pieces.digests(table(spark, sf_dir, "documents"), vocabulary())


def op2_ctw_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text scored by a model of the texts that are not held out."""
    return ctw.scores(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text judged line by line."""
    return lines.report(table(spark, sf_dir, "documents"))


def op4_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of whole texts that two documents share, with the document that keeps it."""
    return passages.passages(table(spark, sf_dir, "documents"))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed as evenly as reading each source at most twice allows; a row for each draw."""
    return mixing.draws(table(spark, sf_dir, "documents"), mixing.Target(repetition=2.0)).drop("row")


def op6_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text, its edited form and the text that follows, by fingerprint."""
    return fingerprints.followed(table(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text scanned; values judged by who holds them in the whole corpus."""
    return secrets.report(table(spark, sf_dir, "documents"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by the rules, or by the globs where no rule fits."""
    return urls.verdicts(table(spark, sf_dir, "pages"))


def op9_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of sixteen shards of nearly equal bytes."""
    return shards.document_shards(table(spark, sf_dir, "documents"), 16)


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the component its four-word shingles link it to."""
    return jaccard.linked(table(spark, sf_dir, "documents"), words=4, num=85, den=100)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every item of the benchmark."""
    return search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), best=10)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor and positive; a seventh of the rows count under the next label."""
    rows, moved = table(spark, sf_dir, "embeddings"), (F.col("label") + 1) % 10
    label = F.when(F.col("vec_id") % 7 == 0, moved).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.select("vec_id", label.alias("label"), "embedding"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text without the bytes of strings of 400 that occur elsewhere too."""
    return repeats.digests(table(spark, sf_dir, "documents"), length=400)


def queries() -> dict[str, Query]:
    return {
        "op1_sentencepiece": op1_sentencepiece,
        "op2_ctw_score": op2_ctw_score,
        "op3_quality_rules": op3_quality_rules,
        "op4_passage_dedup": op4_passage_dedup,
        "op5_source_mix": op5_source_mix,
        "op6_fingerprint": op6_fingerprint,
        "op7_secret_scan": op7_secret_scan,
        "op8_url_filter": op8_url_filter,
        "op9_kd_shards": op9_kd_shards,
        "op10_ngram_join": op10_ngram_join,
        "op11_ranked_search": op11_ranked_search,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_suffix_dedup": op13_suffix_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_quality_rules": lines.SQL,
        "op7_secret_scan": secrets.SQL,
        "op8_url_filter": urls.SQL,
        "op10_ngram_join": jaccard.SQL,
        "op11_ranked_search": search.SQL,
        "op12_hard_negatives": negatives.SQL,
        "op13_suffix_dedup": repeats.SQL,
    }
