"""Tiny export files."""

from __future__ import annotations

from datetime import datetime
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq

# Rows with NULLs, assets that come back, and several types; no two tables have as many rows.
FINDINGS = {
    "assetId": ["web-1", "db-7", "web-1", None, "db-7"],
    "vulnId": ["openssl-heap", "sudo-race", "tls-old", "tls-old", "kernel-leak"],
    "severity": ["Severe", "Critical", None, "Moderate", "Critical"],
    "cvssV3Score": [6.5, 9.1, None, 4.0, 8.4],
    "firstFoundTimestamp": [datetime(2023, 5, 1, 8), None, datetime(2023, 5, 2), datetime(2022, 12, 31), None],
}
ASSETS = {
    "assetId": ["web-1", "db-7", "db-7", "nas-3"],
    "hostName": ["shop", "ledger", "ledger-new", None],
    "ip": ["172.16.0.4", "172.16.0.9", "172.16.1.9", "172.16.0.30"],
    "osFamily": ["Linux", "Unix", "Unix", None],
}
REMEDIATION = {
    "assetId": ["nas-3", "web-1", "web-1"],
    "cveId": ["CVE-1999-0001", "CVE-1999-0001", "CVE-1999-0017"],
    "cvssV3Severity": ["Low", "Low", None],
    "proof": ["port 445 answers", None, "banner says 1.0"],
}
POLICIES = {
    "assetId": ["db-7", "nas-3", "nas-3", "web-1", "web-1", "web-1"],
    "benchmarkNaturalId": ["baseline", "baseline", "storage", "baseline", "web", "web"],
    "ruleTitle": ["No empty passwords", "No empty passwords", "Shares are private", "Clock is set", "Logs rotate", None],
    "finalStatus": ["fail", "pass", "pass", "notApplicable", "fail", "error"],
}


def write(folder: Path, name: str, columns: dict) -> str:
    path = folder / f"{name}.parquet"
    pq.write_table(pa.table(columns), path)
    return str(path)
