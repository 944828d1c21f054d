"""What several operators of this package share."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: a word is a run of bytes other than these, the ASCII white space.
ASCII_SPACE = " \t\n\x0b\f\r"


# Rows of text handed to a Python task at a time; bounds its memory and changes no result.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Make a session ready for Python tasks on texts.

    They take few rows at a time, because texts are long and executors small, and find this package: executors need
    not have it installed.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    context = spark.sparkContext
    if not context.__dict__.get("_breakwater_shipped"):
        package = Path(__file__).parents[1]
        archive = Path(tempfile.mkdtemp(prefix="breakwater-package-")) / "breakwater-package.zip"
        with zipfile.ZipFile(archive, "w") as held:
            for file in sorted(package.rglob("*.py")):
                held.write(file, file.relative_to(package.parent))
        context.addPyFile(str(archive))
        context.__dict__["_breakwater_shipped"] = True


def steady_scans(frame: DataFrame) -> DataFrame:
    """Keep the partitions of file scans as they are now, whatever executors come and go.

    Operators that number rows and read them again rely on equal partitions; by default Spark sizes those of small
    inputs by the cores it has at the time.
    """
    spark, key = frame.sparkSession, "spark.sql.files.minPartitionNum"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(max(1, spark.sparkContext.defaultParallelism)))
    return frame


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share; where a local session names none, as in tests, a temporary one of its own."""
    place = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if place is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        place = tempfile.mkdtemp(prefix="breakwater-shared-")
        spark.sparkContext.setCheckpointDir(place)
    return place.rstrip("/")


def stored(frame: DataFrame) -> DataFrame:
    """Write ``frame`` into the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = frame.sparkSession
    place = f"{shared_folder(spark)}/breakwater-{uuid.uuid4().hex}"
    frame.write.option("compression", "zstd").parquet(place)
    return spark.read.schema(frame.schema).parquet(place)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shuffle_width(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
