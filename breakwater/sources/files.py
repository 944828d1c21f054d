"""Finding export files and reading their footers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# A file below this size is reported, and columns that tell tables apart.
SMALL_FILE_BYTES = 100
FINDING_COLUMNS = ("vulnId", "checkId")
POLICY_COLUMNS = ("finalStatus",)
REMEDIATION_COLUMNS = ("lastRemoved", "lastDetected", "cveId")
EXCEPTION_COLUMNS = ("exceptionDetails",)
ASSET_COLUMNS = ("hostName", "osFamily")
# What Spark says of a file that it reached and cannot read as Parquet, or that is gone.
_SIGNS_OF_DAMAGE = (
    "CANNOT_READ_FILE_FOOTER", "UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND", "is not a Parquet file", "FAILED_READ_FILE"
)

# What came of looking at a file: its footer can be read, it is there but damaged (or gone), or this library has no
# way to its file system, which says nothing about the file.
READABLE, DAMAGED, UNREACHABLE = "readable", "damaged", "unreachable"

_PROBE = (
    "path string, outcome string, readable boolean, bytes long, rows long, "
    "columns array<struct<name:string,type:string>>, error string, ranges array<struct<place:int,low:long,high:long>>"
)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, bytes`` of one file, or of the ``*.parquet`` files right inside a directory."""
    root = path.rstrip("/").split(":", 1)[-1].lstrip("/")
    below = F.substring_index("path", root, -1)
    found = spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("bytes"))
    return found.where((below == "") | below.rlike(r"^/[^/]*\.parquet$"))


def probe(paths: DataFrame) -> DataFrame:
    """Read the footer of every file in ``paths`` (one column, ``path``), in parallel.

    Footers say whether a file is readable and which columns and how many rows
    it has; no data pages are read. ``ranges`` has the least and greatest value
    of every column of 64-bit whole numbers (by place) whose row groups all have
    statistics; NULL if it has no value. A bad file is a row with its error.
    """

    # Inner functions travel to the executors whole, so these need not have this package installed.
    def footer(path: str) -> tuple:
        from pyarrow import fs
        from pyarrow import parquet as pq

        size, outcome = None, "unreachable"
        try:
            local = path.startswith("file:")
            system, name = fs.FileSystem.from_uri("/" + path[5:].lstrip("/") if local else path)
            found = system.get_file_info(name)
            size, outcome = found.size, "damaged"
            with system.open_input_file(name) as source:
                file = pq.ParquetFile(source)
                columns = [{"name": f.name, "type": str(f.type)} for f in file.schema_arrow]
                return path, "readable", True, size, file.metadata.num_rows, columns, None, ranges(file)
        except Exception as problem:  # any unreadable file becomes a row of the report
            return path, outcome, False, size, None, None, f"{type(problem).__name__}: {problem}", None

    def ranges(file) -> list:
        leaves = {file.schema.column(i).path: i for i in range(len(file.schema.names))}
        found = []
        for place, f in enumerate(file.schema_arrow):
            if str(f.type) != "int64" or f.name not in leaves:
                continue
            groups = [file.metadata.row_group(i).column(leaves[f.name]) for i in range(file.metadata.num_row_groups)]
            stats = [(g.statistics, g.num_values) for g in groups]
            valued = [s for s, n in stats if s is None or not s.has_null_count or s.null_count < n]
            if all(s is not None and s.has_min_max for s in valued):
                low, high = min((s.min for s in valued), default=None), max((s.max for s in valued), default=None)
                found.append({"place": place, "low": low, "high": high})
        return found

    def footers(batches):
        import pandas as pd

        names = ["path", "outcome", "readable", "bytes", "rows", "columns", "error", "ranges"]
        for batch in batches:
            yield pd.DataFrame([footer(path) for path in batch["path"]], columns=names)

    return paths.select("path").mapInPandas(footers, _PROBE)


def look(spark: SparkSession, path: str) -> tuple[str, StructType | None, str | None]:
    """Outcome, schema and error of one file, through Spark's own file systems and credentials.

    Raises whatever keeps Spark from reaching the file.
    """
    try:
        return READABLE, spark.read.parquet(path).schema, None
    except Exception as problem:
        text = str(problem)
        if any(sign in text for sign in _SIGNS_OF_DAMAGE):
            return DAMAGED, None, f"{type(problem).__name__}: {text.splitlines()[0]}"
        raise


def spread(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Driver-side file names as a DataFrame with enough partitions to probe in parallel."""
    parts = max(1, min(len(rows), 4 * spark.sparkContext.defaultParallelism))
    return spark.createDataFrame(rows, schema).repartition(parts)


def _has(columns: Column, names: Iterable[str]) -> Column:
    return F.arrays_overlap(columns, F.array(*[F.lit(n) for n in names]))


def sniffed_prefix(columns: Column, mode: str = "full") -> Column:
    """The prefix a file with these column names (an array) would have had.

    ``basic`` knows findings and calls everything else assets. ``full`` tells
    policies, remediation history, exceptions, findings and assets apart and
    gives NULL for a file that is none of them.
    """
    if mode == "basic":
        return F.when(_has(columns, FINDING_COLUMNS), "asset_vulnerability").otherwise("asset")
    if mode != "full":
        raise ValueError("mode is 'basic' or 'full'")
    return (
        F.when(_has(columns, POLICY_COLUMNS), "asset_policy")
        .when(_has(columns, REMEDIATION_COLUMNS), "vulnerability_remediation")
        .when(_has(columns, EXCEPTION_COLUMNS), "vulnerability_exception")
        .when(_has(columns, FINDING_COLUMNS), "asset_vulnerability")
        .when(_has(columns, ASSET_COLUMNS), "asset")
    )
