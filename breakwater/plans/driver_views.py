"""The six tables expressed over the star-schema test tables.

One text serves Spark and the SQL check: only type names, array and struct
constructors and the table references differ.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import SparkSession

from breakwater.tables import Tables


def view_sql(engine: str, table: Callable[[str], str] = str) -> dict[str, str]:
    """Text of each view; ``engine`` is ``spark`` or ``ansi``."""
    spark = engine == "spark"
    text = "string" if spark else "varchar"

    def s(expr: str) -> str:
        return f"cast({expr} as {text})"

    def arr(*items: str) -> str:
        return f"{'array' if spark else 'list_value'}({', '.join(items)})"

    def tag(name: str, kind: str) -> str:
        if spark:
            return f"named_struct('name', {name}, 'tagType', '{kind}')"
        return f"struct_pack(name := {name}, tagType := '{kind}')"

    def ip(key: str) -> str:
        return f"concat('10.', {s(key + ' % 250')}, '.', {s(key + ' % 249')}, '.', {s(key + ' % 247')})"

    family = (
        "case c_nationkey % 5 when 0 then 'Microsoft Windows' when 1 then 'Linux'"
        " when 2 then 'Unix' when 3 then 'Mac OS' end"
    )
    describe = f"({family}) || ' ' || c_mktsegment"
    cloud = f"""
        case when c_nationkey % 4 = 0 then concat('i-', {s('c_custkey')}) end as awsInstanceId,
        case when c_nationkey % 4 = 1 then concat('az-', {s('c_custkey')}) end as azureResourceId,
        case when c_nationkey % 4 = 2 then concat('gcp-', {s('c_custkey')}) end as gcpObjectId"""
    finding = (
        f"concat_ws('-', {s('l_orderkey')}, {s('l_linenumber')}, {s('l_partkey')},"
        f" {s('l_suppkey')}, {s('cast(l_shipdate as date)')})"
    )
    score = "case when p_size <> 13 then p_size / 5.0E0 end"
    li, o, p, c, n, r = (table(t) for t in ("lineitem", "orders", "part", "customer", "nation", "region"))

    return {
        "assets": f"""
            select {s('c_custkey')} as assetId, concat('org-', {s('r_regionkey')}) as orgId,
                   c_name as hostName, {ip('c_custkey')} as ip,
                   concat('02:00:', {s('c_custkey % 100')}) as mac,
                   {family} as osFamily, c_mktsegment as osProduct,
                   concat('vendor-', {s('c_nationkey % 3')}) as osVendor,
                   concat('v', {s('c_custkey % 7')}) as osVersion,
                   case when c_custkey % 3 = 0 then 'arm64' else 'x86_64' end as osArchitecture,
                   case when c_custkey % 2 = 0 then 'Server' else 'Workstation' end as osType,
                   {describe} as osDescription,
                   cast(floor((c_acctbal + 1000) / 10) as double) as riskScore,
                   case when c_custkey % 4 <> 0 then cast(c_custkey * 37 % 1100 as integer) end as riskScoreV2_0,
                   {arr('n_name', 'r_name')} as sites, {arr('c_mktsegment', 'r_name')} as assetGroups,
                   {arr(tag('n_name', 'LOCATION'), tag('c_mktsegment', 'OWNER'))} as tags,
                   {cloud}
            from {c} join {n} on c_nationkey = n_nationkey join {r} on n_regionkey = r_regionkey""",
        "vulnerabilities": f"""
            select {s('o_custkey')} as assetId, {s('p_partkey')} as vulnId, {finding} as checkId,
                   cast(l_linenumber * 100 as integer) as port, p_name as title,
                   case when p_partkey % 97 = 0 then null when p_size >= 40 then 'Critical'
                        when p_size >= 20 then 'Severe' else 'Moderate' end as severity,
                   {score} as cvssV3Score, p_partkey % 3 = 0 as hasExploits,
                   (p_partkey % 100) / 100.0E0 as epssscore, (p_partkey % 50) / 50.0E0 as epsspercentile,
                   cast(p_size * 21 as integer) as riskScoreV2_0,
                   cast(p_size % 5 + 1 as integer) as pciSeverity, p_size % 2 = 0 as pciCompliant,
                   {arr(f"concat('CVE-', {s('p_partkey % 50')})", f"concat('CVE-', {s('p_partkey')})")} as cves,
                   case when l_quantity > 1 then l_shipdate end as firstFoundTimestamp,
                   case when l_linenumber = 7 then l_shipdate + interval 45 day end as reintroducedTimestamp,
                   case p_partkey % 4 when 0 then 'PATCH' when 1 then 'ROLLUP' when 2 then 'UNKNOWN' end
                       as bestSolutionType,
                   case when p_partkey % 4 < 2 then concat('Upgrade ', p_brand) end as bestSolutionSummary,
                   case when p_partkey % 4 < 2 then concat('<p>Upgrade <b>', p_brand, '</b></p>') end
                       as bestSolutionFix,
                   c_name as hostName, {ip('c_custkey')} as ip, {describe} as osDescription,
                   {cloud}
            from {li} join {o} on l_orderkey = o_orderkey join {p} on l_partkey = p_partkey
                 join {c} on o_custkey = c_custkey
            where o_custkey % 10 <> 7""",
        "vulnerability_exceptions": f"""
            select {s('o_custkey')} as assetId, {s('l_partkey')} as vulnId, {finding} as checkId,
                   {s('l_suppkey')} as key, cast(l_linenumber * 100 as integer) as port,
                   l_shipdate as firstFoundTimestamp,
                   concat('{{"state":"approved","item":"', {s('l_orderkey')}, '"}}') as exceptionDetails
            from {li} join {o} on l_orderkey = o_orderkey
            where l_partkey % 20 = 0""",
        "policies": f"""
            select {s('o_custkey')} as assetId, concat('bench-', {s('c_nationkey % 2')}) as benchmarkNaturalId,
                   c_mktsegment as benchmarkTitle, concat('Level ', {s('o_custkey % 2 + 1')}) as profileTitle,
                   o_orderpriority as ruleNaturalId, concat('Rule ', o_orderpriority) as ruleTitle,
                   case when o_orderkey % 11 = 0 then 'notApplicable' when o_orderstatus = 'F' then 'pass'
                        when o_orderstatus = 'P' then 'fail' else 'error' end as finalStatus,
                   case when o_orderkey % 3 > 0 then concat('fix ', o_orderpriority) end as fixTexts,
                   concat('because ', o_orderpriority) as rationales,
                   o_orderdate as lastAssessmentTimestamp,
                   case when o_orderkey % 2 = 0 then 'agent' else 'scan' end as source
            from {o} join {c} on o_custkey = c_custkey""",
        "vulnerability_remediation": f"""
            select {s('o_custkey')} as assetId, concat('CVE-', {s('p_partkey')}) as cveId,
                   {s('p_partkey')} as vulnId, {finding} as proof, p_name as title,
                   {score} as cvssV3Score,
                   case when p_size >= 45 then 'Critical' when p_size >= 35 then 'High'
                        when p_size >= 20 then 'Medium' else 'Low' end as cvssV3Severity,
                   (p_partkey % 100) / 100.0E0 as epssscore, (p_partkey % 50) / 50.0E0 as epsspercentile,
                   least(o_orderdate, l_shipdate) as firstFoundTimestamp,
                   case when l_linestatus = 'F' then greatest(o_orderdate, l_shipdate) end as lastRemoved,
                   case when l_linestatus = 'F' and l_linenumber = 7
                        then greatest(o_orderdate, l_shipdate) + interval 30 day end as reintroducedTimestamp
            from {li} join {o} on l_orderkey = o_orderkey join {p} on l_partkey = p_partkey""",
        "asset_software": f"""
            select distinct {s('o_custkey')} as assetId, p_name as softwareName, p_brand as vendor
            from {li} join {o} on l_orderkey = o_orderkey join {p} on l_partkey = p_partkey""",
    }


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    """All six views as DataFrames over the Parquet files in ``sf_dir``.

    A session lists the files and reads their schemas once, as it would for
    tables of the catalogue; the files do not change under it. The views are
    kept with the session and go with it.
    """
    kept = spark.__dict__.setdefault("_breakwater_views", {})
    if sf_dir in kept:
        return kept[sf_dir]
    texts = view_sql("spark", lambda name: f"parquet.`{sf_dir}/{name}.parquet`")
    kept[sf_dir] = Tables(**{name: partial(spark.sql, text) for name, text in texts.items()})
    return kept[sf_dir]


def with_views(query: str) -> str:
    """``query`` behind the definitions of the views it names, as plain SQL."""
    used = {name: text for name, text in view_sql("ansi").items() if name in query}
    if not used:
        return query
    views = "with " + ",\n".join(f"{name} as ({text})" for name, text in used.items())
    return views + ("," + query.removeprefix("with") if query.startswith("with ") else "\n" + query)
