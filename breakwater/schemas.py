"""Documented columns of the six tables and of the export ledger.

Tables keep the schema of the files they were loaded from; these types only
say what a documented column is when a particular export lacks it.
"""

from __future__ import annotations

from pyspark.sql import types as T

_STRING = T.StringType()
_STRINGS = T.ArrayType(_STRING)
_TAGS = T.ArrayType(T.StructType([T.StructField("name", _STRING), T.StructField("tagType", _STRING)]))
_TIME = T.TimestampNTZType()
_DOUBLE, _INTEGER, _BOOLEAN = T.DoubleType(), T.IntegerType(), T.BooleanType()

# Table names, in load order.
KNOWN_TABLES = (
    "assets",
    "vulnerabilities",
    "vulnerability_exceptions",
    "policies",
    "vulnerability_remediation",
    "asset_software",
)


# Documented columns per table. The last ones of findings belong to the asset; several analyses read them
# from findings, and they are taken from assets where absent.
SCHEMAS: dict[str, T.StructType] = {
    "assets": T.StructType(
        [
            T.StructField("orgId", _STRING),
            T.StructField("assetId", _STRING),
            T.StructField("agentId", _STRING),
            T.StructField("awsInstanceId", _STRING),
            T.StructField("azureResourceId", _STRING),
            T.StructField("gcpObjectId", _STRING),
            T.StructField("mac", _STRING),
            T.StructField("ip", _STRING),
            T.StructField("hostName", _STRING),
            T.StructField("osArchitecture", _STRING),
            T.StructField("osFamily", _STRING),
            T.StructField("osProduct", _STRING),
            T.StructField("osVendor", _STRING),
            T.StructField("osVersion", _STRING),
            T.StructField("osType", _STRING),
            T.StructField("osDescription", _STRING),
            T.StructField("riskScore", _DOUBLE),
            T.StructField("riskScoreV2_0", _INTEGER),
            T.StructField("sites", _STRINGS),
            T.StructField("assetGroups", _STRINGS),
            T.StructField("tags", _TAGS),
        ]
    ),
    "vulnerabilities": T.StructType(
        [
            T.StructField("orgId", _STRING),
            T.StructField("assetId", _STRING),
            T.StructField("vulnId", _STRING),
            T.StructField("checkId", _STRING),
            T.StructField("port", _INTEGER),
            T.StructField("protocol", _STRING),
            T.StructField("nic", _STRING),
            T.StructField("title", _STRING),
            T.StructField("description", _STRING),
            T.StructField("proof", _STRING),
            T.StructField("cvssScore", _DOUBLE),
            T.StructField("cvssV3Score", _DOUBLE),
            T.StructField("cvssAccessVector", _STRING),
            T.StructField("cvssAccessComplexity", _STRING),
            T.StructField("cvssAuthentication", _STRING),
            T.StructField("cvssConfidentialityImpact", _STRING),
            T.StructField("cvssIntegrityImpact", _STRING),
            T.StructField("cvssAvailabilityImpact", _STRING),
            T.StructField("cvssV3Severity", _STRING),
            T.StructField("cvssV3AttackVector", _STRING),
            T.StructField("cvssV3AttackComplexity", _STRING),
            T.StructField("cvssV3PrivilegesRequired", _STRING),
            T.StructField("cvssV3UserInteraction", _STRING),
            T.StructField("cvssV3Scope", _STRING),
            T.StructField("cvssV3Confidentiality", _STRING),
            T.StructField("cvssV3Integrity", _STRING),
            T.StructField("cvssV3Availability", _STRING),
            T.StructField("cvssV3SeverityRank", _INTEGER),
            T.StructField("severityRank", _INTEGER),
            T.StructField("severityScore", _INTEGER),
            T.StructField("skillLevelRank", _INTEGER),
            T.StructField("pciSeverity", _INTEGER),
            T.StructField("severity", _STRING),
            T.StructField("skillLevel", _STRING),
            T.StructField("riskScore", _DOUBLE),
            T.StructField("epssscore", _DOUBLE),
            T.StructField("epsspercentile", _DOUBLE),
            T.StructField("riskScoreV2_0", _INTEGER),
            T.StructField("hasExploits", _BOOLEAN),
            T.StructField("threatFeedExists", _BOOLEAN),
            T.StructField("pciCompliant", _BOOLEAN),
            T.StructField("firstFoundTimestamp", _TIME),
            T.StructField("reintroducedTimestamp", _TIME),
            T.StructField("dateAdded", _TIME),
            T.StructField("dateModified", _TIME),
            T.StructField("datePublished", _TIME),
            T.StructField("cves", _STRINGS),
            T.StructField("tags", _TAGS),
            T.StructField("bestSolutionType", _STRING),
            T.StructField("bestSolutionSummary", _STRING),
            T.StructField("bestSolutionFix", _STRING),
            T.StructField("hostName", _STRING),
            T.StructField("ip", _STRING),
            T.StructField("osDescription", _STRING),
            T.StructField("awsInstanceId", _STRING),
            T.StructField("azureResourceId", _STRING),
            T.StructField("gcpObjectId", _STRING),
        ]
    ),
    "vulnerability_exceptions": T.StructType(
        [
            T.StructField("orgId", _STRING),
            T.StructField("assetId", _STRING),
            T.StructField("vulnId", _STRING),
            T.StructField("checkId", _STRING),
            T.StructField("key", _STRING),
            T.StructField("port", _INTEGER),
            T.StructField("protocol", _STRING),
            T.StructField("nic", _STRING),
            T.StructField("proof", _STRING),
            T.StructField("firstFoundTimestamp", _TIME),
            T.StructField("reintroducedTimestamp", _TIME),
            T.StructField("exceptionDetails", _STRING),
        ]
    ),
    "policies": T.StructType(
        [
            T.StructField("orgId", _STRING),
            T.StructField("assetId", _STRING),
            T.StructField("benchmarkNaturalId", _STRING),
            T.StructField("benchmarkTitle", _STRING),
            T.StructField("benchmarkVersion", _STRING),
            T.StructField("profileNaturalId", _STRING),
            T.StructField("profileTitle", _STRING),
            T.StructField("publisher", _STRING),
            T.StructField("ruleNaturalId", _STRING),
            T.StructField("ruleTitle", _STRING),
            T.StructField("finalStatus", _STRING),
            T.StructField("proof", _STRING),
            T.StructField("fixTexts", _STRING),
            T.StructField("rationales", _STRING),
            T.StructField("lastAssessmentTimestamp", _TIME),
            T.StructField("source", _STRING),
        ]
    ),
    "vulnerability_remediation": T.StructType(
        [
            T.StructField("orgId", _STRING),
            T.StructField("assetId", _STRING),
            T.StructField("cveId", _STRING),
            T.StructField("vulnId", _STRING),
            T.StructField("proof", _STRING),
            T.StructField("title", _STRING),
            T.StructField("description", _STRING),
            T.StructField("cvssV2Severity", _STRING),
            T.StructField("cvssV3Severity", _STRING),
            T.StructField("cvssV2AttackVector", _STRING),
            T.StructField("cvssV3AttackVector", _STRING),
            T.StructField("firstFoundTimestamp", _TIME),
            T.StructField("reintroducedTimestamp", _TIME),
            T.StructField("lastDetected", _TIME),
            T.StructField("lastRemoved", _TIME),
            T.StructField("datePublished", _TIME),
            T.StructField("dateAdded", _TIME),
            T.StructField("dateModified", _TIME),
            T.StructField("cvssV2Score", _DOUBLE),
            T.StructField("cvssV3Score", _DOUBLE),
            T.StructField("epssscore", _DOUBLE),
            T.StructField("epsspercentile", _DOUBLE),
            T.StructField("riskScoreV2_0", _INTEGER),
        ]
    ),
    "asset_software": T.StructType(
        [
            T.StructField("assetId", _STRING),
            T.StructField("orgId", _STRING),
        ]
    ),
}

# Findings attributes that belong to the asset.
ASSET_ATTRIBUTES = ("hostName", "ip", "osDescription", "awsInstanceId", "azureResourceId", "gcpObjectId")

LEDGER = T.StructType(
    [
        T.StructField("seq", T.LongType(), False),
        T.StructField("export_id", _STRING, False),
        T.StructField("export_date", T.DateType(), False),
        T.StructField("created_at", _TIME, False),
        T.StructField("status", _STRING, False),
        T.StructField("file_count", T.IntegerType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("parquet_urls", _STRINGS),
        T.StructField("local_files", _STRINGS),
        T.StructField("export_type", _STRING),
    ]
)
