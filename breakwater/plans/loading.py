"""Routing, loading, ledger and guarded SQL over the driver tables, with the SQL that checks them."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import partial, reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from breakwater.operators import derived, growing
from breakwater.plans import driver_views
from breakwater.plans.analyses import AS_OF
from breakwater.plans.guard import GuardedSql
from breakwater.sources import catalog, files, ledger, manifest, prefixes, versions
from breakwater.sources.loader import load, load_path
from breakwater.tables import Tables


class Check(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _as_text(frame: DataFrame) -> DataFrame:
    """Dates and arrays as text, the form in which both engines are compared."""
    kinds = {f.name: f.dataType for f in frame.schema.fields}
    return frame.withColumns(
        {c: F.col(c).cast("string") for c, k in kinds.items() if isinstance(k, T.DateType)}
        | {c: F.array_join(c, ", ") for c, k in kinds.items() if isinstance(k, T.ArrayType)}
    )


def _text_sql(sql: str, *, dates: tuple[str, ...] = (), arrays: tuple[str, ...] = ()) -> str:
    shown = [f"cast({c} as varchar) as {c}" for c in dates] + [f"array_to_string({c}, ', ') as {c}" for c in arrays]
    return f"select * replace ({', '.join(shown)}) from ({sql})"


# -- routing -------------------------------------------------------------------

_EVENT_PREFIX = """case event_type when 'view' then 'asset' when 'signup' then 'asset_scan_policy'
    when 'error' then 'vulnerability_remediation/daily' when 'click' then 'asset/v2'
    else concat('mystery/', event_type) end"""


def prefix_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "events").selectExpr("event_id", f"{_EVENT_PREFIX} as prefix")
    return prefixes.route(rows, skip=["asset"])


_ROUTING_SQL = f"""
    select event_id, prefix,
           case when prefix in ('vulnerability_remediation/daily', 'asset/v2') then split_part(prefix, '/', 1)
                else prefix end as normalised,
           case split_part(prefix, '/', 1) when 'asset' then 'assets' when 'asset_scan_policy' then 'policies'
                when 'vulnerability_remediation' then 'vulnerability_remediation' end as table_name,
           case when prefix = 'asset_scan_policy' then 'scan' end as source,
           case when prefix in ('asset', 'asset/v2') then 'skip' when prefix like 'mystery/%' then 'unknown'
                else 'load' end as outcome
    from (select event_id, {_EVENT_PREFIX} as prefix from events)"""

_COLUMN_SETS = {
    "view": ("assetId", "hostName", "osFamily"),
    "signup": ("assetId", "finalStatus", "ruleTitle"),
    "error": ("assetId", "vulnId", "cveId", "lastRemoved"),
    "click": ("assetId", "checkId", "severity"),
    "purchase": ("assetId", "packageName"),
}


def sniffed_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = reduce(
        lambda rest, item: F.when(F.col("event_type") == item[0], F.array(*map(F.lit, item[1]))).otherwise(rest),
        _COLUMN_SETS.items(),
        F.array().cast("array<string>"),
    )
    return _read(spark, sf_dir, "events").select(
        "event_id",
        files.sniffed_prefix(columns, "basic").alias("basic_prefix"),
        files.sniffed_prefix(columns, "full").alias("full_prefix"),
    )


_SNIFF_SQL = """
    select event_id, if(event_type in ('error', 'click'), 'asset_vulnerability', 'asset') as basic_prefix,
           case event_type when 'view' then 'asset' when 'signup' then 'asset_policy'
                when 'error' then 'vulnerability_remediation' when 'click' then 'asset_vulnerability' end
               as full_prefix
    from events"""


def file_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = files.probe(files.list_files(spark, sf_dir).select("path"))
    return found.select(
        F.substring_index(F.substring_index("path", "/", -1), ".", 1).alias("file"),
        "readable",
        "rows",
        (F.col("bytes") < files.SMALL_FILE_BYTES).alias("small"),
        F.array_size("columns").alias("column_count"),
    )


_DRIVER_TABLES = {
    "region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6, "lineitem": 11, "events": 6,
    "documents": 5, "embeddings": 3, "pages": 3, "benchmark": 2, "labels": 3, "conversations": 4,
}
_FOOTERS_SQL = "\nunion all ".join(
    f'select \'{t}\' as file, true as readable, count(*) as "rows", false as small, {n} as column_count from {t}'
    for t, n in _DRIVER_TABLES.items()
)

# -- loads ---------------------------------------------------------------------


def _scratch(spark: SparkSession) -> str:
    """A folder of its own, in the cluster's shared folder if it names one, else in the warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/breakwater/{uuid.uuid4().hex}"


@contextmanager
def _scratch_database(spark: SparkSession) -> Iterator[str]:
    """A database under a name that no other run has; it goes in any case."""
    place = _scratch(spark)
    name = f"breakwater_{place.rsplit('/', 1)[1]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{place}/{name}.db'")
    try:
        yield name
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def _kept(frame: DataFrame) -> DataFrame:
    """The rows, written now, so that the check leaves no tables behind; they stay in the scratch folder."""
    place = f"{_scratch(frame.sparkSession)}/result"
    frame.write.parquet(place)
    return frame.sparkSession.read.schema(frame.schema).parquet(place)


def snapshot_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load the driver files twice; snapshots do not add up, and both policy sources share a table."""

    def path(table: str) -> str:
        return f"{sf_dir}/{table}.parquet"

    files = {
        "asset": [path("customer")],
        "asset_vulnerability": [path("lineitem")],
        "asset_policy": [path("orders")],
        "asset_scan_policy/v2": [path("orders"), path("orders")],
        "asset_software": [path("part"), path("supplier")],
        "mystery": [path("nation")],
    }
    with _scratch_database(spark) as database:
        for _ in range(2):
            load(spark, database, files)
        none = F.lit(None).cast("string")
        found = [
            spark.table(f"{database}.{table}")
            .groupBy(tag.alias("source"))
            .agg(F.count("*").alias("row_count"), F.sum(number).alias("total"), F.max(text).alias("last_text"))
            .select(F.lit(table).alias("table_name"), "source", "row_count", F.col("total").cast("bigint"), "last_text")
            for table, tag, number, text in (
                ("assets", none, "c_custkey", "c_name"),
                ("vulnerabilities", none, F.col("l_orderkey") * F.col("l_linenumber"), "l_returnflag"),
                ("policies", F.col("source"), "o_orderkey", "o_orderpriority"),
                ("asset_software", F.when(F.col("p_partkey").isNull(), "other columns"), F.coalesce("p_partkey", "s_suppkey"),
                 F.coalesce("p_name", "s_name")),
            )
        ]
        return _kept(reduce(DataFrame.unionByName, found))


_SNAPSHOT_SQL = """
    select 'assets' as table_name, null as source, count(*) as row_count, cast(sum(c_custkey) as bigint) as total,
           max(c_name) as last_text from customer
    union all select 'vulnerabilities', null, count(*), sum(l_orderkey * l_linenumber), max(l_returnflag) from lineitem
    union all select 'policies', 'agent', count(*), sum(o_orderkey), max(o_orderpriority) from orders
    union all select 'policies', 'scan', 2 * count(*), 2 * sum(o_orderkey), max(o_orderpriority) from orders
    union all select 'asset_software', null, count(*), sum(p_partkey), max(p_name) from part
    union all select 'asset_software', 'other columns', count(*), sum(s_suppkey), max(s_name) from supplier"""


def append_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replace, add the same chunk under another load id, then try that load again: it adds nothing more."""
    chunk = {"vulnerability_remediation/daily": [f"{sf_dir}/lineitem.parquet"]}
    with _scratch_database(spark) as database:
        load(spark, database, chunk)
        for _ in range(2):
            load(spark, database, chunk, append=True, load_id="second")
        return _kept(
            spark.table(f"{database}.vulnerability_remediation")
            .groupBy("l_returnflag")
            .agg(
                F.count("*").alias("row_count"), F.min("l_shipdate").alias("first_ship"),
                F.sum(F.col("l_orderkey") * F.col("l_linenumber")).alias("total"),
            )
        )


_APPEND_SQL = """
    select l_returnflag, 2 * count(*) as row_count, min(l_shipdate) as first_ship,
           cast(2 * sum(l_orderkey * l_linenumber) as bigint) as total
    from lineitem group by all"""


def combined_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two slices of one table, one with whole quantities and one with halves, in either order of files."""
    place, items = _scratch(spark), _read(spark, sf_dir, "lineitem")
    whole, half = f"{place}/whole", f"{place}/half"
    slices = items.select("l_orderkey", "l_suppkey", "l_quantity")
    slices.where("l_orderkey % 2 = 0").withColumn("l_quantity", F.col("l_quantity").cast("bigint")).write.parquet(whole)
    slices.where("l_orderkey % 2 = 1").withColumn("l_quantity", F.col("l_quantity").cast("double") + 0.5).write.parquet(half)
    with _scratch_database(spark) as database:
        load(spark, database, {"asset_vulnerability": _parts(spark, whole) + _parts(spark, half)})
        load(spark, database, {"vulnerability_remediation": _parts(spark, half) + _parts(spark, whole)})
        found = [
            spark.table(f"{database}.{table}")
            .groupBy("l_suppkey")
            .agg(F.count("*").alias("row_count"), F.sum("l_quantity").alias("total"), F.max("l_quantity").alias("largest"))
            .withColumn("table_name", F.lit(table))
            for table in ("vulnerabilities", "vulnerability_remediation")
        ]
        return _kept(reduce(DataFrame.unionByName, found))


_COMBINED_SQL = """
    select t.table_name, l_suppkey, count(*) as row_count, sum(q) as total, max(q) as largest
    from (select l_suppkey, cast(cast(l_quantity as bigint) as double) as q from lineitem where l_orderkey % 2 = 0
          union all select l_suppkey, cast(l_quantity as double) + 0.5 from lineitem where l_orderkey % 2 = 1),
         (values ('vulnerabilities'), ('vulnerability_remediation')) t(table_name)
    group by all"""


def exact_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole numbers beyond 2^53 beside halves: in one load, and in two of which the second is wider."""
    place, items = _scratch(spark), _read(spark, sf_dir, "lineitem")
    whole, half = f"{place}/whole", f"{place}/half"
    slices = items.select("l_suppkey", "l_orderkey", "l_quantity")
    slices.where("l_orderkey % 2 = 0").withColumn("l_quantity", F.col("l_quantity").cast("bigint") + (2**53 + 1)).write.parquet(whole)
    slices.where("l_orderkey % 2 = 1").withColumn("l_quantity", F.col("l_quantity").cast("double") + 0.5).write.parquet(half)
    with _scratch_database(spark) as database:
        load(spark, database, {"asset_vulnerability": _parts(spark, half) + _parts(spark, whole)})
        load(spark, database, {"vulnerability_remediation": _parts(spark, whole)})
        report = load(spark, database, {"vulnerability_remediation": _parts(spark, half)}, append=True)
        told = sum("l_quantity" in w for w in report.warnings)
        found = [
            spark.table(f"{database}.{table}")
            .groupBy("l_suppkey")
            .agg(
                F.count("*").alias("row_count"), F.sum("l_quantity").cast("string").alias("total"),
                F.min("l_quantity").cast("string").alias("smallest"), F.max("l_quantity").cast("string").alias("largest"),
            )
            .select(F.lit(table).alias("table_name"), "*", F.lit(warned).alias("warned"))
            for table, warned in (("vulnerabilities", 0), ("vulnerability_remediation", told))
        ]
        return _kept(reduce(DataFrame.unionByName, found))


_EXACT_SQL = """
    select t.table_name, l_suppkey, count(*) as row_count, cast(sum(q) as varchar) as total, cast(min(q) as varchar) as smallest,
           cast(max(q) as varchar) as largest, t.warned
    from (select l_suppkey, cast(cast(l_quantity as bigint) + 9007199254740993 as decimal(38, 1)) as q from lineitem where l_orderkey % 2 = 0
          union all select l_suppkey, cast(l_quantity as decimal(38, 1)) + 0.5 from lineitem where l_orderkey % 2 = 1),
         (values ('vulnerabilities', 0), ('vulnerability_remediation', 1)) t(table_name, warned)
    group by all"""


def interleaved_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An append whose rows are written before a snapshot load ends and committed after it, and one beside another."""
    name, items = "vulnerability_remediation", _read(spark, sf_dir, "lineitem")
    place = _scratch(spark)
    for step in range(4):
        items.where(F.col("l_orderkey") % 4 == step).select("l_orderkey", "l_quantity").write.parquet(f"{place}/{step}")

    def began(database: str, step: int) -> str:
        rows = spark.read.parquet(f"{place}/{step}").withColumn(versions.LOAD, F.lit(f"load {step}"))
        return versions.write_part(spark, database, name, rows, f"load {step}")

    def ended(database: str, part: str) -> None:
        versions.commit(spark, database, name, lambda now: [*(now.parts if now else ()), part])

    with _scratch_database(spark) as database:
        load(spark, database, {name: _parts(spark, f"{place}/0")})
        first, second = began(database, 1), began(database, 2)
        load(spark, database, {name: _parts(spark, f"{place}/3")})
        ended(database, second)
        ended(database, first)
        versions.compact(spark, database, name)
        return _kept(
            spark.table(f"{database}.{name}")
            .groupBy((F.col("l_orderkey") % 4).alias("step"))
            .agg(F.count("*").alias("row_count"), F.sum("l_orderkey").alias("total"))
        )


_INTERLEAVED_SQL = """
    select l_orderkey % 4 as step, count(*) as row_count, cast(sum(l_orderkey) as bigint) as total
    from lineitem where l_orderkey % 4 > 0 group by all"""


_GROWN = ("vulnerabilities", "assets", "policies", "vulnerability_remediation", "asset_software")
_GROWN_COLUMNS = {
    "vulnerabilities": ("assetId", "vulnId", "severity", "cvssV3Score", "hasExploits", "epssscore", "awsInstanceId", "azureResourceId", "gcpObjectId"),
    "assets": ("assetId", "osFamily"),
    "policies": ("assetId", "finalStatus", "source"),
    "vulnerability_remediation": ("assetId", "cvssV3Severity"),
    "asset_software": ("assetId",),
}


def grown_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile after a snapshot and an append: summaries of two parts of each table, added."""
    place, views = _scratch(spark), driver_views.tables(spark, sf_dir)
    frames = {table: views[table].select(*_GROWN_COLUMNS[table]) for table in _GROWN}

    def worked_out(table: str) -> None:
        """A view's joins run once; both loads read their rows of what they gave."""
        frames[table].write.parquet(f"{place}/{table}")

    def loaded(database: str, step: int, table: str) -> None:
        rows = spark.read.schema(frames[table].schema).parquet(f"{place}/{table}")
        own = rows.where(F.pmod(F.xxhash64("assetId"), F.lit(2)) == step)
        part = versions.write_part(spark, database, table, own.withColumn(versions.LOAD, F.lit(str(step))), str(step))
        versions.commit(spark, database, table, lambda now: [*(now.parts if now else ()), part])

    # Tables do not depend on each other, so the last tasks of one leave no cores idle.
    with _scratch_database(spark) as database, ThreadPoolExecutor(max_workers=len(_GROWN)) as pool:
        list(pool.map(worked_out, _GROWN))
        for step in range(2):
            list(pool.map(partial(loaded, database, step), _GROWN))
            growing.blocks(spark, database)
        shown = growing.as_rows(spark, database)
        return _kept(shown.withColumn("value", F.round("value", 6)))


def _grown_sql() -> str:
    counts = [(t, "rows", "total_rows", "count(*)") for t in _GROWN]
    counts += [
        ("vulnerabilities", "unique", "unique_assets", "count(distinct assetId)"),
        ("vulnerabilities", "unique", "unique_vulnerabilities", "count(distinct vulnId)"),
        ("assets", "unique", "unique_assets", "count(distinct assetId)"),
        ("asset_software", "unique", "unique_assets", "count(distinct assetId)"),
        ("vulnerabilities", "cvss_v3_stats", "min_score", "min(cvssV3Score)"),
        ("vulnerabilities", "cvss_v3_stats", "max_score", "max(cvssV3Score)"),
        ("vulnerabilities", "cvss_v3_stats", "avg_score", "avg(cvssV3Score)"),
        ("vulnerabilities", "cvss_v3_stats", "median_score", "median(cvssV3Score)"),
        ("vulnerabilities", "exploit_stats", "with_exploits", "count(*) filter (where hasExploits)"),
        ("vulnerabilities", "exploit_stats", "high_epss", "count(*) filter (where epssscore > 0.5)"),
        ("vulnerabilities", "exploit_stats", "avg_epss", "avg(epssscore)"),
        ("vulnerabilities", "cloud_distribution", "aws_rows", "count(awsInstanceId)"),
        ("vulnerabilities", "cloud_distribution", "azure_rows", "count(azureResourceId)"),
        ("vulnerabilities", "cloud_distribution", "gcp_rows", "count(gcpObjectId)"),
    ]
    groups = [
        ("vulnerabilities", "severity_distribution", "severity"), ("assets", "os_family_distribution", "osFamily"),
        ("policies", "finalStatus_distribution", "finalStatus"), ("policies", "source_distribution", "source"),
        ("vulnerability_remediation", "severity_distribution", "cvssV3Severity"),
    ]
    start = "select '{}' as table_name, '{}' as block, "
    each = [(start + "'{}' as item, round(cast({} as double), 6) as value from {}").format(*row, row[0]) for row in counts]
    each += [
        (start + "cast({} as varchar) as item, cast(count(*) as double) as value from {} where {} is not null group by {}").format(t, b, c, t, c, c)
        for t, b, c in groups
    ]
    return driver_views.with_views("\nunion all ".join(each))


def sniffed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a folder loaded by what their columns look like; one of them looks like nothing known."""
    place = _scratch(spark)
    slices = {
        "hosts": _read(spark, sf_dir, "customer").selectExpr("c_custkey as assetId", "c_name as hostName"),
        "found": _read(spark, sf_dir, "lineitem").selectExpr("l_orderkey as assetId", "l_partkey as vulnId"),
        "rules": _read(spark, sf_dir, "orders").selectExpr("o_custkey as assetId", "o_orderstatus as finalStatus"),
        "fixed": _read(spark, sf_dir, "part").selectExpr("p_partkey as assetId", "p_name as cveId"),
    }
    other = _read(spark, sf_dir, "nation").coalesce(1)  # 25 rows at any scale; one file, so one warning
    other.write.parquet(f"{place}/files")
    unknown = _parts(spark, f"{place}/files")
    for frame in slices.values():
        frame.write.mode("append").parquet(f"{place}/files")
    with _scratch_database(spark) as database:
        report = load_path(spark, database, f"{place}/files")
    rows = [("rows", table, count) for table, count in report.row_counts.items()]
    rows += [("warning", "other", sum(any(path in w for path in unknown) for w in report.warnings))]
    return spark.createDataFrame(rows, "kind string, name string, n bigint")


_SNIFFED_FILES_SQL = """
    select 'rows' as kind, 'assets' as name, count(*) as n from customer
    union all select 'rows', 'vulnerabilities', count(*) from lineitem
    union all select 'rows', 'policies', count(*) from orders
    union all select 'rows', 'vulnerability_remediation', count(*) from part
    union all select 'warning', 'other', 1"""


def json_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of JSON files that rows were written to."""
    place = f"{_scratch(spark)}/json"
    rows = _read(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_orderdate", "nullif(o_orderstatus, 'F') as o_orderstatus")
    catalog.write_json(rows, place)
    return spark.read.text(place).withColumnRenamed("value", "json")


_JSON_FILES_SQL = """
    select cast(to_json(struct_pack(o_orderkey := o_orderkey, o_orderdate := strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'),
                                    o_orderstatus := nullif(o_orderstatus, 'F'))) as varchar) as json from orders"""


def _parts(spark: SparkSession, folder: str) -> list[str]:
    return [row.path for row in files.list_files(spark, folder).orderBy("path").collect()]


def _put(spark: SparkSession, path: str, content: bytes) -> str:
    """Write a file through Spark's file systems."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(content))
    out.close()
    return path


def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What loads report of a good file, one with damaged pages, a tiny one, a prefix they do not know, a file without rows."""
    place = _scratch(spark)
    _read(spark, sf_dir, "nation").coalesce(1).write.parquet(f"{place}/good")
    (good,) = _parts(spark, f"{place}/good")
    content = bytearray(spark.read.format("binaryFile").load(good).first().content)
    pages = len(content) - 8 - int.from_bytes(content[-8:-4], "little")
    content[4:pages] = b"\xff" * (pages - 4)
    with _scratch_database(spark) as database:
        report = load(
            spark,
            database,
            {
                "asset": [good, _put(spark, f"{place}/torn.parquet", content), _put(spark, f"{place}/tiny.parquet", b"PAR1")],
                "asset_software": [f"{sf_dir}/part.parquet"],
                "mystery": [good],
            },
        )
        _read(spark, sf_dir, "nation").where("false").coalesce(1).write.parquet(f"{place}/none")
        empty = load(spark, database, {"vulnerability_exception": _parts(spark, f"{place}/none")})
    kinds = ("unknown prefix", "unusually small", "not readable", "0 rows loaded")
    told = [("warning", kind, sum(kind in w for w in report.warnings + empty.warnings)) for kind in kinds]
    rows = [("rows", table, count) for table, count in (report.row_counts | empty.row_counts).items()] + told
    return spark.createDataFrame(rows, "kind string, name string, n bigint")


_REPORT_SQL = """
    select 'rows' as kind, 'assets' as name, count(*) as n from nation
    union all select 'rows', 'asset_software', count(*) from part
    union all select 'warning', 'unknown prefix', 1 union all select 'warning', 'unusually small', 1
    union all select 'warning', 'not readable', 2 union all select 'warning', '0 rows loaded', 1
    union all select 'rows', 'vulnerability_exceptions', 0"""


def table_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of loaded tables, as the catalogue describes them."""
    loaded = {"asset": "customer", "asset_vulnerability": "lineitem", "vulnerability_remediation": "orders"}
    with _scratch_database(spark) as database:
        load(spark, database, {prefix: [f"{sf_dir}/{table}.parquet"] for prefix, table in loaded.items()})
        return _kept(catalog.schema(spark, Tables.from_catalog(spark, database)))


_COLUMNS_SQL = "\nunion all ".join(
    f"""select '{name}' as table_name, cid + 1 as ordinal, name as column_name,
               case "type" when 'VARCHAR' then 'string' when 'INTEGER' then 'int' when 'TIMESTAMP' then 'timestamp_ntz'
                    else lower("type") end as data_type
        from pragma_table_info('{table}')"""
    for name, table in (("assets", "customer"), ("vulnerabilities", "lineitem"), ("vulnerability_remediation", "orders"))
)


def catalogue_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether there is data, and the tables with their rows: before a load, after it, after a purge."""
    rows = []

    def note(step: str, database: str) -> None:
        tables = Tables.from_catalog(spark, database)
        rows.append((step, catalog.has_data(tables), len(tables), sum(frame.count() for frame in tables.values())))

    with _scratch_database(spark) as database:
        note("empty", database)
        load(spark, database, {"asset": [f"{sf_dir}/customer.parquet"], "asset_policy": [f"{sf_dir}/orders.parquet"]})
        note("loaded", database)
        catalog.purge(spark, database)
        note("purged", database)
    return spark.createDataFrame(rows, "step string, has_data boolean, tables int, row_count bigint")


_STEPS_SQL = """
    select 'empty' as step, false as has_data, 0 as tables, cast(0 as bigint) as row_count
    union all select 'loaded', true, 2, (select count(*) from customer) + (select count(*) from orders)
    union all select 'purged', false, 0, 0"""

# -- manifests -----------------------------------------------------------------


def manifest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifests = _read(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey as string) as id",
        """array(
             named_struct('prefix', 'asset', 'urls', if(o_orderkey % 2 = 0,
                 array(concat('a-', o_custkey), concat('b-', o_orderkey)), array(concat('a-', o_custkey)))),
             named_struct('prefix', 'asset_policy/x', 'urls',
                 array(concat('a-', o_custkey), concat('c-', o_orderkey), concat('a-', o_custkey)))) as result""",
    )
    return manifest.flatten(manifests)


_MANIFEST_SQL = """
    select cast(o_orderkey as varchar) as id, concat('a-', o_custkey) as url, 'asset_policy/x' as prefix,
           0 as item, 0 as position, cast(3 as bigint) as copies from orders
    union all select cast(o_orderkey as varchar), concat('b-', o_orderkey), 'asset', 0, 1, 1
    from orders where o_orderkey % 2 = 0
    union all select cast(o_orderkey as varchar), concat('c-', o_orderkey), 'asset_policy/x', 1, 1, 1 from orders"""


def date_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranges = _read(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "cast(o_orderdate as date) as start_date",
        "date_add(cast(o_orderdate as date), cast(o_orderkey % 120 + 1 as int)) as end_date",
    )
    return _as_text(manifest.date_chunks(ranges))


_CHUNKS_SQL = """
    select o_orderkey, start_date, end_date, start_date + 31 * i as chunk_start,
           least(start_date + 31 * (i + 1), end_date) as chunk_end
    from (select *, unnest(range(cast(ceil((end_date - start_date) / 31.0E0) as bigint)))::integer as i
          from (select o_orderkey, cast(o_orderdate as date) as start_date,
                       cast(o_orderdate as date) + cast(o_orderkey % 120 + 1 as integer) as end_date from orders))"""

# -- ledger --------------------------------------------------------------------


def _ledger(engine: str) -> str:
    text, arr = ("string", "array") if engine == "spark" else ("varchar", "list_value")
    return f"""
        select event_id as seq, concat('export-', cast(user_id as {text}), '-', cast(day(ts) as {text})) as export_id,
               cast(ts as date) as export_date, ts as created_at,
               case event_type when 'purchase' then 'COMPLETE' when 'view' then 'COMPLETE' when 'error' then 'FAILED'
                    else 'PROCESSING' end as status,
               case when event_id % 5 <> 0 then event_id % 1000 end as row_count,
               case when event_id % 3 > 0 then {arr}(concat('u-', cast(event_id as {text})), event_type) end
                   as parquet_urls,
               {arr}(concat('f-', cast(event_id as {text}))) as local_files,
               case user_id % 4 when 0 then 'vulnerability' when 1 then 'policy' when 2 then 'remediation'
                    else 'asset_software' end as export_type"""


def _exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.sql(f"{_ledger('spark')} from parquet.`{sf_dir}/events.parquet`")
    return ledger.current(ledger.with_file_count(events))


_EXPORTS_SQL = f"""
    with entries as ({_ledger('ansi')} from events),
    exports as (
        select f.export_id, f.export_date, f.created_at, l.status, cast(coalesce(len(l.parquet_urls), 0) as integer)
               as file_count, l.row_count, l.parquet_urls, l.local_files, l.export_type
        from (select * from entries qualify row_number() over (partition by export_id order by seq) = 1) f
        join (select * from entries qualify row_number() over (partition by export_id order by seq desc) = 1) l
             using (export_id))"""


def ledger_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    exports = _exports(spark, sf_dir)
    return _as_text(ledger.reuse_decision(exports.select("export_date", "export_type").distinct(), exports))


# -- SQL -----------------------------------------------------------------------

_GUARDED = """
    select a.osFamily, count(distinct v.assetId) as assets_hit, count(*) as findings
    from vulnerabilities v join assets a on v.assetId = a.assetId
    where v.severity = 'Critical' and a.osType = 'Server' group by a.osFamily"""
_PARAMETERS = """
    select severity, count(*) as findings from vulnerabilities
    where cvssV3Score >= {score} and epssscore > {epss} group by severity"""


def _guarded(spark: SparkSession, sf_dir: str) -> GuardedSql:
    return GuardedSql(spark, lambda session: driver_views.tables(session, sf_dir))


def eol_software(spark: SparkSession, sf_dir: str) -> DataFrame:
    installed = driver_views.tables(spark, sf_dir)["asset_software"]
    listed = _read(spark, sf_dir, "part").selectExpr(
        "p_brand as vendor", "date_add(date'1995-01-01', cast(ascii(right(p_brand, 1)) * 45 as int)) as eol_date"
    )
    return _as_text(derived.eol_flagging(installed, listed, ["vendor"], AS_OF))


def eol_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions made of line items against release lines of one or two parts made of parts."""
    installed = _read(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "concat('product ', l_partkey % 20) as product",
        "concat(l_linenumber, '.', cast(l_quantity as int), '.', l_suppkey % 10) as version",
    )
    listed = _read(spark, sf_dir, "part").selectExpr(
        "concat('product ', p_partkey % 20) as product",
        "if(p_partkey % 3 = 0, cast(p_partkey % 7 + 1 as string), concat(p_partkey % 7 + 1, '.', p_partkey % 50 + 1)) as version",
        "date_add(date'1995-01-01', cast(p_partkey % 900 as int)) as eol_date",
    )
    return _as_text(derived.eol_by_version(installed, listed, ["product"], "version", "1996-06-01"))


_EOL_VERSIONS_SQL = """
    with listed as (
        select concat('product ', p_partkey % 20) as product,
               if(p_partkey % 3 = 0, cast(p_partkey % 7 + 1 as varchar), concat(p_partkey % 7 + 1, '.', p_partkey % 50 + 1)) as entry,
               max(date '1995-01-01' + cast(p_partkey % 900 as integer)) as eol_date
        from part group by all),
    installed as (
        select l_orderkey, l_linenumber, concat('product ', l_partkey % 20) as product,
               concat(l_linenumber, '.', cast(l_quantity as integer), '.', l_suppkey % 10) as version from lineitem),
    met as (select distinct i.product, i.version, e.entry, e.eol_date
            from (select distinct product, version from installed) i
            join listed e on e.product = i.product and starts_with(i.version || '.', e.entry || '.')
            qualify row_number() over (partition by i.product, i.version order by length(e.entry) desc) = 1)
    select l_orderkey, l_linenumber, product, version, entry, cast(eol_date as varchar) as eol_date
    from installed join met using (product, version) where eol_date < date '1996-06-01'"""

CHECKS: dict[str, Check] = {
    "prefix_routing": Check(prefix_routing, _ROUTING_SQL),
    "sniffed_prefixes": Check(sniffed_prefixes, _SNIFF_SQL),
    "file_footers": Check(file_footers, _FOOTERS_SQL),
    "snapshot_load": Check(snapshot_load, _SNAPSHOT_SQL),
    "append_load": Check(append_load, _APPEND_SQL),
    "combined_types": Check(combined_types, _COMBINED_SQL),
    "exact_types": Check(exact_types, _EXACT_SQL),
    "interleaved_loads": Check(interleaved_loads, _INTERLEAVED_SQL),
    "grown_profile": Check(grown_profile, _grown_sql()),
    "sniffed_files": Check(sniffed_files, _SNIFFED_FILES_SQL),
    "json_files": Check(json_files, _JSON_FILES_SQL),
    "eol_by_version": Check(eol_versions, _EOL_VERSIONS_SQL),
    "load_report": Check(load_report, _REPORT_SQL),
    "table_columns": Check(table_columns, _COLUMNS_SQL),
    "catalogue_steps": Check(catalogue_steps, _STEPS_SQL),
    "manifest_files": Check(manifest_files, _MANIFEST_SQL),
    "date_chunks": Check(
        date_chunks, _text_sql(_CHUNKS_SQL, dates=("start_date", "end_date", "chunk_start", "chunk_end"))
    ),
    "json_rows": Check(
        lambda spark, sf_dir: catalog.json_rows(
            _read(spark, sf_dir, "orders").selectExpr(
                "o_orderkey", "o_orderdate", "o_orderpriority", "nullif(o_orderstatus, 'F') as o_orderstatus"
            )
        ),
        """select cast(to_json(struct_pack(o_orderkey := o_orderkey,
                       o_orderdate := strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), o_orderpriority := o_orderpriority,
                       o_orderstatus := nullif(o_orderstatus, 'F'))) as varchar) as json from orders""",
    ),
    "table_overview": Check(
        lambda spark, sf_dir: catalog.overview(driver_views.tables(spark, sf_dir)),
        driver_views.with_views(
            "\nunion all ".join(
                f"select '{t}' as table_name, {n} as column_count, count(*) as row_count, count(*) > 0 as has_rows"
                f" from {t}"
                for t, n in {
                    "assets": 20, "vulnerabilities": 25, "vulnerability_exceptions": 7, "policies": 11,
                    "vulnerability_remediation": 12, "asset_software": 3,
                }.items()
            )
        ),
    ),
    "ledger_exports": Check(
        lambda spark, sf_dir: _as_text(_exports(spark, sf_dir)),
        _text_sql(
            f"{_EXPORTS_SQL} select * from exports", dates=("export_date",), arrays=("parquet_urls", "local_files")
        ),
    ),
    "ledger_same_day": Check(
        lambda spark, sf_dir: _as_text(ledger.newest_complete(_exports(spark, sf_dir))),
        f"""{_EXPORTS_SQL}
            select cast(export_date as varchar) as export_date, export_type, export_id, created_at from exports
            where status = 'COMPLETE'
            qualify row_number() over (partition by export_date, export_type
                                       order by created_at desc, export_id desc) = 1""",
    ),
    "ledger_completed_on": Check(
        lambda spark, sf_dir: _as_text(ledger.completed_on(_exports(spark, sf_dir), "2024-01-05", "policy")),
        _text_sql(
            f"""{_EXPORTS_SQL} select * from exports
                where export_date = date '2024-01-05' and status = 'COMPLETE' and export_type = 'policy'
                order by created_at desc, export_id limit 1""",
            dates=("export_date",),
            arrays=("parquet_urls", "local_files"),
        ),
    ),
    "ledger_reuse": Check(
        ledger_reuse,
        f"""{_EXPORTS_SQL}, hits as (
              select export_date, export_type, export_id from exports where status = 'COMPLETE'
              qualify row_number() over (partition by export_date, export_type
                                         order by created_at desc, export_id desc) = 1)
            select cast(r.export_date as varchar) as export_date, r.export_type, if(r.export_type <> 'remediation', h.export_id, null)
                       as reused_export_id,
                   reused_export_id is not null as reuse
            from (select distinct export_date, export_type from exports) r
            left join hits h on r.export_date = h.export_date and r.export_type = h.export_type""",
    ),
    "ledger_lookup": Check(
        lambda spark, sf_dir: _as_text(ledger.by_id(_exports(spark, sf_dir), "export-7-3")),
        _text_sql(
            f"{_EXPORTS_SQL} select * from exports where export_id = 'export-7-3'",
            dates=("export_date",),
            arrays=("parquet_urls", "local_files"),
        ),
    ),
    "ledger_recent": Check(
        lambda spark, sf_dir: _as_text(ledger.recent(_exports(spark, sf_dir), 10, "policy")),
        f"""{_EXPORTS_SQL}
            select export_id, cast(export_date as varchar) as export_date, created_at, status, file_count, row_count,
                   export_type
            from exports where export_type = 'policy' order by created_at desc, export_id limit 10""",
    ),
    "ledger_staleness": Check(
        lambda spark, sf_dir: _as_text(ledger.staleness(_exports(spark, sf_dir), "2024-01-31")),
        f"""{_EXPORTS_SQL} select export_type, cast(max(export_date) as varchar) as last_export_date,
                   cast(date '2024-01-31' - max(export_date) as integer) as age_days, age_days > 1 as stale
            from exports group by all""",
    ),
    "guarded_sql": Check(
        lambda spark, sf_dir: _guarded(spark, sf_dir).query(_GUARDED), driver_views.with_views(_GUARDED)
    ),
    "parameterised_sql": Check(
        lambda spark, sf_dir: _guarded(spark, sf_dir).query(
            _PARAMETERS.format(score=":score", epss=":epss"), {"score": 7.0, "epss": 0.5}
        ),
        driver_views.with_views(_PARAMETERS.format(score="7.0", epss="0.5")),
    ),
    "clean_fix_text": Check(
        lambda spark, sf_dir: derived.clean_fix_text(_read(spark, sf_dir, "pages"), "html", "text").drop("html"),
        "select page_id, url, regexp_replace(html, '<[^>]*>', '', 'g') as text from pages",
    ),
    "eol_flagging": Check(
        eol_software,
        driver_views.with_views(
            f"""select s.assetId, s.softwareName, s.vendor, cast(e.eol_date as varchar) as eol_date
                from asset_software s
                join (select p_brand as vendor,
                             max(date '1995-01-01' + cast(ascii(right(p_brand, 1)) * 45 as integer)) as eol_date
                      from part group by all) e using (vendor)
                where e.eol_date < date '{AS_OF}'"""
        ),
    ),
}
