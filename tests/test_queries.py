"""Every query against its SQL, and again with all keys treated as too big for a task."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from check import TABLES, _table
from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")

# Queries whose plan changes when keys are split.
SPLIT = (
    "apply_identity asof_profile asof_group asof_super_props events_with_logs logs_near_event metrics_align "
    "latency_summary running_revenue counter_increase counter_normalize histogram_increase moving_gauge_rows "
    "moving_gauge_interval sessionize_gap sessionize_reset event_sequence funnel_users funnel time_between abandonment "
    "auth_failures rank_users pack_batches unpack_batches batch_gaps retain_newest_bytes resolve_identities"
).split()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def _expected(db, name):
    cursor = db.execute(oracle_sql()[name])
    return _table([c[0] for c in cursor.description], cursor.fetchall())


def _got(spark, name):
    df = queries()[name](spark, FOLDER)
    return _table(df.columns, df.collect())


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query_equals_sql(spark, db, name):
    assert _got(spark, name) == _expected(db, name)


@pytest.mark.parametrize("name", SPLIT)
def test_split_query_equals_sql(spark, db, forced_split, name):
    with forced_split(rows=20, partitions=6):
        assert _got(spark, name) == _expected(db, name)


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
