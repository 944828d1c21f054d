"""The set of tables an analysis reads."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from breakwater.schemas import ASSET_ATTRIBUTES, KNOWN_TABLES, SCHEMAS


class MissingTable(LookupError):
    """An analysis asked for a table that has not been loaded."""


class Tables(Mapping[str, DataFrame]):
    """Loaded tables by name, with tolerance for columns an export lacks."""

    def __init__(self, **frames: DataFrame | Callable[[], DataFrame]):
        """A table may be given as a function; it is called when the table is first read."""
        unknown = set(frames) - set(KNOWN_TABLES)
        if unknown:
            raise ValueError(f"not tables of this model: {sorted(unknown)}")
        self._frames = frames

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str) -> Tables:
        """Every known table that exists in ``database``."""
        present = [t for t in KNOWN_TABLES if spark.catalog.tableExists(f"{database}.{t}")]
        return cls(**{t: partial(spark.table, f"{database}.{t}") for t in present})

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            raise MissingTable(f"table {name!r} is not loaded")
        frame = self._frames[name]
        if not isinstance(frame, DataFrame):
            frame = self._frames[name] = frame()
        return frame

    def __contains__(self, name: object) -> bool:
        return name in self._frames

    def __iter__(self):
        return iter(self._frames)

    def __len__(self) -> int:
        return len(self._frames)

    def read(self, name: str, *columns: str) -> DataFrame:
        """The named columns of a table.

        A documented column that this export lacks comes back as a typed NULL.
        Asset attributes that ``vulnerabilities`` lacks come from ``assets``;
        the join happens only when such a column is asked for.
        """
        borrowed = self.borrowed(name, *columns)
        frame = self[name]
        documented = {f.name: f.dataType for f in SCHEMAS[name].fields}
        available = set(frame.columns)
        picked = []
        for column in dict.fromkeys([*columns, *(["assetId"] if borrowed else [])]):
            if column in available:
                picked.append(F.col(column))
            elif column not in documented:
                raise ValueError(f"{name} has no column {column!r}, and none is documented")
            elif column not in borrowed:
                picked.append(F.lit(None).cast(documented[column]).alias(column))
        own = frame.select(*picked)
        return self.borrow(own, borrowed).select(*columns) if borrowed else own

    def borrowed(self, name: str, *columns: str) -> list[str]:
        """Those of the columns that ``vulnerabilities`` has to take from ``assets``."""
        if name != "vulnerabilities" or "assets" not in self:
            return []
        absent = [c for c in columns if c in ASSET_ATTRIBUTES and c not in self[name].columns]
        return [c for c in absent if c in self["assets"].columns]

    def borrow(self, frame: DataFrame, columns: list[str]) -> DataFrame:
        """Add attributes of the asset to rows with an ``assetId``, and no rows.

        Aggregates and top-k results borrow after they are computed, so a
        frequent asset does not gather its findings in one task of the join.
        """
        if not columns:
            return frame
        owner = self["assets"].groupBy("assetId").agg(F.max(F.struct(*columns)).alias("owner"))
        return frame.join(owner.select("assetId", "owner.*"), "assetId", "left")
