"""All registered queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from breakwater.plans import driver_views
from breakwater.plans.analyses import ANALYSES, Analysis
from breakwater.plans.loading import CHECKS


def _over_views(analysis: Analysis) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: analysis.result(driver_views.tables(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _over_views(analysis) for name, analysis in ANALYSES.items()} | {
        name: check.run for name, check in CHECKS.items()
    }


def oracle_sql() -> dict[str, str]:
    return {name: driver_views.with_views(a.sql) for name, a in ANALYSES.items() if a.sql is not None} | {
        name: check.sql for name, check in CHECKS.items() if check.sql is not None
    }
