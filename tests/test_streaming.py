from __future__ import annotations

import uuid

import pytest
from pyspark.sql import types as T

from breakwater.sources.loader import load
from breakwater.streaming.append import append_arrivals
from tests.fixtures import REMEDIATION, write

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in REMEDIATION])


def test_each_file_is_appended_once(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex[:10]}"
    folder = tmp_path / "chunks"
    folder.mkdir()

    def run():
        return append_arrivals(
            spark, name, "vulnerability_remediation", str(folder), SCHEMA, name, str(tmp_path / "kept"), files_per_batch=1
        )

    write(folder, "one", REMEDIATION)
    write(folder, "two", REMEDIATION)
    assert run() == 6
    assert run() == 6
    late = write(folder, "three", {"cveId": ["CVE-9"], "assetId": ["new-1"]})
    assert run() == 7
    row = spark.table(f"{name}.vulnerability_remediation").where("cveId = 'CVE-9'").first()
    assert (row.assetId, row.proof) == ("new-1", None)
    with pytest.raises(ValueError, match="fed by a stream"):
        load(spark, name, {"vulnerability_remediation": [late]}, append=True)
    load(spark, name, {"vulnerability_remediation": [late]})
    assert spark.table(f"{name}.vulnerability_remediation").count() == 1
    spark.sql(f"DROP DATABASE {name} CASCADE")
