"""Deterministic ordering and top-k.

A key is a column name, with a leading ``-`` for descending. NULLs sort last
both ways. The remaining output columns follow as tie-breaks, so equal keys
give the same rows on every run, and a value that a third of the rows share
still spreads over many range partitions in a full sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _by(keys: tuple[str, ...]) -> list[Column]:
    return [F.col(k[1:]).desc_nulls_last() if k.startswith("-") else F.col(k).asc_nulls_last() for k in keys]


def _with_ties(frame: DataFrame, keys: tuple[str, ...]) -> tuple[str, ...]:
    named = [k.lstrip("-") for k in keys]
    fields = frame.schema.fields
    return (*keys, *[f.name for f in fields if f.name not in named and not isinstance(f.dataType, T.MapType)])


def ordered(frame: DataFrame, *keys: str, spread_by: tuple[str, ...] = ()) -> DataFrame:
    """All rows, sorted.

    A full sort samples its input to find the range of each partition, and so
    computes it twice. That is cheap behind a shuffle, whose output is kept, but
    would repeat a bare scan and filter; ``spread_by`` puts a shuffle of the
    remaining rows in between. Its columns then decide ties alone: the driver
    receives the sort keys of the sample, so wide rows should not be keys whole.
    """
    if spread_by:
        return frame.repartition(*spread_by).orderBy(*_by((*keys, *spread_by)))
    return frame.orderBy(*_by(_with_ties(frame, keys)))


def top(frame: DataFrame, n: int, *keys: str) -> DataFrame:
    """First ``n`` rows: every task keeps its own best ``n``, nothing is fully sorted."""
    return frame.orderBy(*_by(_with_ties(frame, keys))).limit(n)
