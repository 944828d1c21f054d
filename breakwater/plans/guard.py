"""Read-only SQL over the six tables.

This keeps honest users from writing, reading files or calling into the JVM by
accident. It is a convenience, not a security boundary: whoever must not see
other data needs a cluster and storage credentials that cannot reach it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from breakwater.tables import Tables

# Leaves of a plan that hold no stored rows, and expressions that run code of the caller's choice.
HARMLESS_LEAVES = ("OneRowRelation", "LocalRelation", "Range", "CTERelationRef")
REFUSED_EXPRESSIONS = ("CallMethodViaReflection",)


class QueryRefused(ValueError):
    """The text is not a plain query over the loaded tables, or it failed."""


class GuardedSql:
    """A session of its own in which only queries over the given tables run."""

    def __init__(self, spark: SparkSession, build: Callable[[SparkSession], Tables]):
        """``build`` makes the tables with the session it is given."""
        self._session = spark.newSession()
        for key, value in spark.conf.getAll.items():
            if key.startswith("spark.sql.") and self._session.conf.isModifiable(key):
                self._session.conf.set(key, value)
        tables = build(self._session)
        self._names = set(tables)
        for name, frame in tables.items():
            frame.createOrReplaceTempView(name)
        self._session.conf.set("spark.sql.runSQLOnFiles", "false")

    def query(self, sql: str, args: dict[str, Any] | list[Any] | None = None) -> DataFrame:
        """The result of a query, not yet run; ``args`` bind its parameters."""
        text = sql.strip().rstrip("; \n\t")
        try:
            # only a check: DDL, DML, SET and several statements do not parse inside the brackets
            self._run(f"SELECT * FROM (\n{text}\n) LIMIT 0", args)
            frame = self._run(text, args)
            self._inspect(frame)
            return frame
        except QueryRefused:
            raise
        except Exception as problem:
            raise QueryRefused(f"query failed: {problem}") from problem

    def _run(self, text: str, args: dict[str, Any] | list[Any] | None) -> DataFrame:
        return self._session.sql(text, args=args) if args else self._session.sql(text)

    def _inspect(self, frame: DataFrame) -> None:
        """Refuse a query whose analysed plan reads anything but the given views, or runs code by name."""
        analysed = frame._jdf.queryExecution().analyzed()
        for plan in (analysed, *_items(analysed.subqueriesAll())):
            for node in self._outside_views(plan):
                kind = node.getClass().getSimpleName()
                if kind == "View" or node.children().isEmpty() and kind not in HARMLESS_LEAVES:
                    raise QueryRefused(f"{node.nodeName()} is not one of the loaded tables")
                for expression in _items(node.expressions()):
                    for part in _tree(expression):
                        if part.getClass().getSimpleName() in REFUSED_EXPRESSIONS:
                            raise QueryRefused(f"function {part.prettyName()} is not available")

    def _outside_views(self, plan: Any) -> Iterator[Any]:
        """Nodes of a plan, without what lies behind the given views."""
        if plan.getClass().getSimpleName() == "View" and plan.isTempView():
            name = plan.desc().identifier()  # a global view has a database, and may bear the name of a table
            if name.table() in self._names and name.database().isEmpty():
                return
        yield plan
        for child in _items(plan.children()):
            yield from self._outside_views(child)


def _items(sequence: Any) -> Iterator[Any]:
    return (sequence.apply(i) for i in range(sequence.size()))


def _tree(expression: Any) -> Iterator[Any]:
    yield expression
    for child in _items(expression.children()):
        yield from _tree(child)
