"""The stored star forest against the full computation, link by link."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from signalyard import operators as op
from signalyard.sources import versions as versions_module

DDL = "previous_id string, user_id string"


def test_increments_give_what_all_links_give(spark, tmp_path, rows_of):
    draw = random.Random(11)
    parts = []
    for size in (60, 25, 0):
        part = [(f"u{draw.randint(0, 150):03d}", f"u{draw.randint(0, 150):03d}") for _ in range(size)]
        parts.append(part + ([("z", "z"), (None, "u1"), ("u1", None)] if size == 60 else []))
    parts[2] = parts[0][:20] + [(b, a) for a, b in parts[0][:5]]  # nothing new
    store, links, upto = op.IdentityStore(spark, str(tmp_path / "ids"), buckets=4), [], []
    for number, part in enumerate(parts, 1):
        links += part
        assert store.add_links(spark.createDataFrame(part, DDL)) == number
        want = rows_of(op.resolve_identities(spark.createDataFrame(links, DDL)), "user_id", "canonical_id")
        upto.append(want)
        assert rows_of(store.map(), "user_id", "canonical_id") == want
    assert [rows_of(store.map(k + 1), "user_id", "canonical_id") for k in range(len(parts))] == upto
    written = {r["version"]: r["n_rows"] for r in store.versions().collect()}
    # A version has the rows that differ from the version before, and no others.
    before = set()
    for number, rows in enumerate(upto, 1):
        assert written[number] == len(set(rows) - before), number
        before = set(rows)
    assert written[3] == 0


def test_cost_follows_the_new_links(spark, tmp_path):
    """Many large components, one link between two of them: only the members of the one whose root falls are written."""
    store = op.IdentityStore(spark, str(tmp_path / "ids"), buckets=64)
    first = spark.range(3000).select(
        F.format_string("c%02d", F.col("id") % 30).alias("previous_id"), F.format_string("m%05d", "id").alias("user_id")
    )
    store.add_links(first)
    store.add_links(spark.createDataFrame([("m00001", "m00002")], DDL))
    assert {r["version"]: r["n_rows"] for r in store.versions().collect()} == {1: 3030, 2: 101}
    got = {r["user_id"]: r["canonical_id"] for r in store.map().collect()}
    assert {got[f"m{k:05d}"] for k in range(2, 3000, 30)} == {"c01"} and got["m00003"] == "c03"


def test_a_version_that_fails_is_not_seen(spark, tmp_path, monkeypatch, rows_of):
    path = str(tmp_path / "ids")
    store = op.IdentityStore(spark, path, tenant="string")
    ddl = f"tenant string, {DDL}"
    store.add_links(spark.createDataFrame([("t", "a", "b"), ("v", "b", "c")], ddl))
    real = versions_module.VersionedTable.bucket

    def broken(self, *keys):
        if "canonical_id" in keys:
            raise RuntimeError("lost")
        return real(self, *keys)

    more = spark.createDataFrame([("t", "b", "0"), ("v", "x", "y")], ddl)
    monkeypatch.setattr(versions_module.VersionedTable, "bucket", broken)
    with pytest.raises(RuntimeError, match="lost"):
        store.add_links(more)
    monkeypatch.undo()
    columns = ("tenant", "user_id", "canonical_id")
    assert rows_of(store.map(), *columns) == [("t", "a", "a"), ("t", "b", "a"), ("v", "b", "b"), ("v", "c", "b")]
    assert store.add_links(more) == 2
    assert rows_of(op.IdentityStore(spark, path, tenant="string").map(), *columns) == [
        ("t", "0", "0"), ("t", "a", "0"), ("t", "b", "0"), ("v", "b", "b"), ("v", "c", "b"), ("v", "x", "x"), ("v", "y", "x"),
    ]
    with pytest.raises(ValueError, match="scope"):
        store.add_links(spark.createDataFrame([("a", "b")], DDL))
