from __future__ import annotations

import pytest

from breakwater.plans import driver_views
from breakwater.plans.guard import GuardedSql, QueryRefused


@pytest.fixture(scope="module")
def guarded(spark):
    from tests.conftest import SF_DIR

    spark.sql("create table if not exists outside using parquet as select 1 as secret")
    yield GuardedSql(spark, lambda session: driver_views.tables(session, SF_DIR))
    spark.sql("drop table if exists outside")


@pytest.mark.parametrize(
    "sql",
    [
        "select count(*) as n from assets",
        "select count(*) as n from assets; ",
        "with c as (select severity from vulnerabilities) select count(*) as n from c",
        "select n from (values (1)) as t(n)",
        "select count(*) as n from assets where exists (select 1 from policies where policies.assetId = assets.assetId)",
        "select 1 as n union select 2 order by n",
        "-- a remark\nselect count(*) as n from asset_software -- and another",
        "select count(*) as n from assets a left join vulnerability_exceptions e on a.assetId = e.assetId",
    ],
)
def test_queries_run(guarded, sql):
    assert guarded.query(sql).first().n > 0


@pytest.mark.parametrize(
    "sql",
    [
        "drop view assets",
        "create table x as select 1",
        "insert into assets select * from assets",
        "set spark.sql.runSQLOnFiles=true",
        "cache table assets",
        "show tables",
        "select 1; drop view assets",
        "select 1) union (select 2",
        "select * from parquet.`/root/testdata/sf0.001/nation.parquet`",
        "select * from csv.`/etc/passwd`",
        "select * from outside",
        "select * from default.outside",
        "select * from spark_catalog.default.outside",
        "select (select max(secret) from outside) as n from assets",
        "select reflect('java.lang.System', 'getProperty', 'user.home')",
        "select REFLECT /* */ ('java.lang.System', 'getProperty', 'user.home')",
        "select `reflect`('java.lang.System', 'getProperty', 'user.home')",
        "select builtin.reflect('java.lang.System', 'getProperty', 'user.home')",
        "select system.builtin.java_method('java.lang.System', 'getProperty', 'user.home')",
        "select try_reflect('java.lang.System', 'getProperty', 'user.home')",
        "select * from assets where reflect('java.lang.System', 'getProperty', 'a') is null",
        "select * from IDENTIFIER('outside')",
        "select * from IDENTIFIER('out' || 'side')",
        "select * from assets a, lateral (select * from IDENTIFIER('default.outside')) x",
        "select count(*) as n from assets where exists (select * from IDENTIFIER('out' || 'side'))",
        "with c as (select * from IDENTIFIER('outside')) select * from c",
        "select IDENTIFIER('ref' || 'lect')('java.lang.System', 'getProperty', 'user.home')",
        "select (select java_method('java.lang.System', 'getProperty', 'user.home')) as n",
        "INVALID SQL",
        "",
    ],
)
def test_everything_else_is_refused(guarded, sql):
    with pytest.raises(QueryRefused):
        guarded.query(sql).collect()


def test_global_views_of_the_same_name_are_refused(spark, guarded):
    spark.sql("create or replace global temporary view assets as select 1 as n")
    try:
        for sql in ("select n from global_temp.assets", "select (select max(n) from global_temp.assets) as n"):
            with pytest.raises(QueryRefused):
                guarded.query(sql).collect()
        assert guarded.query("select count(*) as n from assets").first().n > 1
    finally:
        spark.catalog.dropGlobalTempView("assets")


def test_texts_that_name_functions_or_relations_are_only_texts(guarded):
    sql = """select count(*) as n from assets
             where hostName not like '%java_method(%' and hostName <> 'UnresolvedRelation [outside]' and 'reflect(' <> hostName"""
    assert guarded.query(sql).first().n > 0


def test_settings_of_the_session_are_inherited(spark):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "12345678")
    try:
        inner = GuardedSql(spark, lambda session: driver_views.tables(session, "/root/testdata/sf0.001"))
        assert inner.query("select 1 as n").sparkSession.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "12345678"
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_parameters(guarded):
    named = guarded.query("select count(*) as n from vulnerabilities where severity = :s", {"s": "Critical"}).first().n
    placed = guarded.query("select count(*) as n from vulnerabilities where severity = ?", ["Critical"]).first().n
    assert named == placed > 0
    hostile = guarded.query("select count(*) as n from assets where hostName = :h", {"h": "x' or '1'='1"}).first().n
    assert hostile == 0


def test_order_is_kept(guarded):
    rows = guarded.query("select distinct severity from vulnerabilities order by severity desc nulls last").collect()
    assert [r.severity for r in rows][:3] == ["Severe", "Moderate", "Critical"]


def test_other_sessions_are_untouched(spark, guarded):
    assert spark.conf.get("spark.sql.runSQLOnFiles") == "true"
    assert not spark.catalog.tableExists("assets")


@pytest.mark.parametrize(
    "sql",
    [
        "select count(*) filter (where hasExploits) as n from vulnerabilities",
        "select percentile_cont(0.5) within group (order by cvssV3Score) as n from vulnerabilities",
        "select case when hasExploits then 'yes' else 'no' end as known, count(*) as n from vulnerabilities group by known",
        "select source, count(distinct assetId) as n from policies group by source having n > 0",
        "select count(*) as n from vulnerabilities where exists(cves, c -> c like '%CVE-1%')",
        "select count(*) as n from vulnerabilities v where exists (select 1 from explode(v.cves) as t(c) where c like '%CVE-1%')",
        "select max(datediff(timestamp_ntz'2030-01-01', firstFoundTimestamp)) as n from vulnerabilities",
        "select date_trunc('week', lastRemoved) as w, count(*) as n from vulnerability_remediation group by w order by w desc",
        "select row_number() over (partition by assetId order by epssscore desc) as n from vulnerabilities",
    ],
)
def test_sql_that_the_analyses_are_made_of(guarded, sql):
    assert guarded.query(sql).first().n > 0
