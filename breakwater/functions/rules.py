"""Value rules that every analysis shares, as column expressions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Labels, limits and literals that results must show as they are.
MAX_RISK = 1000
REMEDIATED, STILL_PRESENT = "Remediated", "Still Present"
ACTIONABLE_SOLUTIONS = ("PATCH", "ROLLUP", "WORKAROUND")
UNKNOWN_SOLUTION = "UNKNOWN"
TAG_PATTERN = "<[^>]*>"
HIGH_EPSS = 0.5
CRITICAL_CVSS = 9.0
HIGH_CVSS = 7.0


def cloud_provider() -> Column:
    """First cloud id present decides; no id means on premise."""
    return (
        F.when(F.col("awsInstanceId").isNotNull(), "AWS")
        .when(F.col("azureResourceId").isNotNull(), "Azure")
        .when(F.col("gcpObjectId").isNotNull(), "GCP")
        .otherwise("On-Premise")
    )


def os_category(family: str = "osFamily") -> Column:
    """Windows, Linux or Unix by name; everything else, also NULL, is Other."""
    column = F.col(family)
    return (
        F.when(column.like("%Windows%"), "Windows")
        .when(column.like("%Linux%"), "Linux")
        .when(column.like("%Unix%"), "Unix")
        .otherwise("Other")
    )


def like(column: Column, pattern: str) -> Column:
    """LIKE without an escape character: a backslash stands for itself."""
    return column.like(pattern.replace("\\", "\\\\"))


def any_like(array: str, pattern: str) -> Column:
    """True where some element of the array matches; a row expression, no join."""
    return F.exists(F.col(array), lambda item: like(item, pattern))


def days_between(start: str | Column, end: str | Column) -> Column:
    """Date boundaries crossed from start to end (23:00 to 01:00 is one day)."""
    return F.datediff(end, start)


def moment(as_of: datetime | str | None) -> Column:
    """The time an age is measured at: the given one, else now."""
    return F.localtimestamp() if as_of is None else F.lit(str(as_of)).cast("timestamp_ntz")


def week_of(column: str) -> Column:
    """Monday of the ISO week, independent of the session time zone."""
    return F.trunc(F.col(column).cast("date"), "week").cast("timestamp_ntz")


def month_of(column: str) -> Column:
    """First day of the month, independent of the session time zone."""
    return F.trunc(F.col(column).cast("date"), "month").cast("timestamp_ntz")


def age_bucket(first_found: str, as_of: datetime | str | None) -> Column:
    """Age in days as a label; an unknown date counts as the oldest."""
    days = days_between(first_found, moment(as_of))
    return (
        F.when(days < 30, "0-30 days")
        .when(days < 90, "30-90 days")
        .when(days < 180, "90-180 days")
        .otherwise("180+ days")
    )


def remediation_status() -> Column:
    return F.when(F.col("lastRemoved").isNotNull(), REMEDIATED).otherwise(STILL_PRESENT)


def capped(score: Column) -> Column:
    """A risk score as it is shown: at most the top of the scale, NULL if unknown."""
    return F.when(score > MAX_RISK, F.lit(MAX_RISK)).otherwise(score)


def asset_risk() -> Column:
    """Current risk score before the legacy one, as it is shown."""
    return capped(F.coalesce(F.col("riskScoreV2_0").cast("double"), F.col("riskScore")))


def percent(part: Column, whole: Column) -> Column:
    return F.round(F.lit(100.0) * part / whole, 2)


def strip_tags(column: str | Column) -> Column:
    """Text without HTML tags."""
    return F.regexp_replace(column, TAG_PATTERN, "")


def solution_type() -> Column:
    return F.coalesce(F.col("bestSolutionType"), F.lit(UNKNOWN_SOLUTION))


def digest(text: str) -> Column:
    """A text as a number, ``<text>_digest``, so that the text stays out of shuffles that count assets."""
    return F.xxhash64(text).alias(f"{text}_digest")


def with_text(counts: DataFrame, rows: DataFrame, text: str, key: str) -> DataFrame:
    """Put the texts back behind the digests of ``counts``; ``rows`` has them next to ``key``.

    Texts are read once more and reduced to the different ones before they move.
    """
    texts = rows.select(F.col(key).alias("_key"), digest(text).alias("_digest"), text).distinct()
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col(f"{text}_digest") == F.col("_digest"))
    return counts.join(texts, same).drop("_key", "_digest", f"{text}_digest")
