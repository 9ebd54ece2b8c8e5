"""Results do not depend on the session's time zone."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_DIR
from tests.oracle import compare, connect

TIMED = [
    "chunk_limit_offset",
    "chunk_limit_offset_manifest",
    "chunk_partition_manifest",
    "chunk_tracker_latest",
    "load_durations",
    "partition_profile",
    "recovery_close",
    "validate_minmax",
]


@pytest.mark.parametrize("name", TIMED)
def test_other_zone(spark, name):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        problem = compare(spark, connect(SF_DIR), SF_DIR, name, entry.queries()[name], entry.oracle_sql()[name])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert problem is None
