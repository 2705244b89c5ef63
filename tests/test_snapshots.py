"""The versioned table: pruned rewrites, refused duplicates, versions that stay readable."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tidegauge.operators.keyed import upsert
from tidegauge.sources.snapshots import SnapshotTable, by_month, hashed, one_row_per_key

SCHEMA = "k long, v double, w string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names}


@pytest.fixture
def kept(spark, tmp_path):
    def build(data, part=None, schema=SCHEMA, keys=("k",)):
        table = SnapshotTable(spark, str(tmp_path / "t"), keys, part if part is not None else F.floor(F.col("k") / 10))
        table.create(spark.createDataFrame(data, schema))
        return table

    return build


def test_merge_equals_a_join_of_the_whole_table(spark, kept):
    data = [(i, float(i), f"w{i}") for i in range(100)] + [(None, 1.0, "none")]
    source = spark.createDataFrame([(i, -1.0, None) for i in (5, 7, 95, 300)] + [(None, 2.0, "again"), (None, 2.0, "again")], SCHEMA)
    table = kept(data)
    assert rows(table.read(table.merge(source))) == rows(upsert(spark.createDataFrame(data, SCHEMA), source, ["k"], checked=False))
    assert rows(table.read(1)) == rows(spark.createDataFrame(data, SCHEMA))


def test_only_touched_partitions_are_rewritten(spark, kept, tmp_path):
    table = kept([(i, float(i), "old") for i in range(100)])
    before = files(tmp_path)
    table.merge(spark.createDataFrame([(42, 0.0, "new"), (150, 0.0, "new")], SCHEMA))
    after = files(tmp_path)
    assert {f: t for f, t in after.items() if f in before} == before
    data = {f.split("table_part=")[1].split("/")[0] for f in set(after) - set(before) if "table_part=" in f}
    assert data == {"4", "15"}
    assert table.read().count() == 101 and table.read(parts=["4"]).filter("w = 'new'").count() == 1


def test_two_source_rows_of_one_key_leave_the_table_as_it_was(spark, kept):
    table = kept([(1, 1.0, "a")])
    with pytest.raises(Exception, match="several source rows for one key: k=2"):
        table.merge(spark.createDataFrame([(2, 1.0, "a"), (2, 1.0, "b"), (3, 0.0, "c")], SCHEMA))
    assert table.versions() == [1] and rows(table.read()) == [(1, 1.0, "a")]
    table.merge(spark.createDataFrame([(2, 5.0, "b")], SCHEMA))  # files of the failed run do not show
    assert rows(table.read()) == [(1, 1.0, "a"), (2, 5.0, "b")]


def test_the_source_of_a_merge_runs_once(spark, kept):
    table = kept([(1, 1.0, "a")])
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    table.merge(spark.createDataFrame([(i, 0.0, "s") for i in range(50)], SCHEMA).mapInArrow(count, SCHEMA))
    assert seen.value == 50


def test_partial_columns_audit_and_insert_only(spark, kept):
    table = kept([(1, 1.0, "a"), (2, 2.0, "b")])
    source = spark.createDataFrame([(2, 9.0, "z"), (3, 3.0, "c")], SCHEMA)
    assert rows(table.read(table.merge(source, update=["v"]))) == [(1, 1.0, "a"), (2, 9.0, "b"), (3, 3.0, None)]
    again = spark.createDataFrame([(2, 0.0, "x"), (4, 4.0, "d")], SCHEMA)
    assert rows(table.read(table.merge(again, insert_only=True))) == [(1, 1.0, "a"), (2, 9.0, "b"), (3, 3.0, None), (4, 4.0, "d")]


def test_empty_tables_and_empty_sources(spark, kept):
    table = kept([])
    assert table.read().count() == 0 and table.read().columns == ["k", "v", "w"]
    assert table.merge(spark.createDataFrame([], SCHEMA)) == 1
    assert rows(table.read(table.merge(spark.createDataFrame([(1, None, None)], SCHEMA)))) == [(1, None, None)]


def test_a_second_writer_of_one_version_is_refused(spark, kept):
    table = kept([(1, 1.0, "a")])
    holders, columns = table._list(1)
    table.merge(spark.createDataFrame([(2, 0.0, "b")], SCHEMA))
    with pytest.raises(Exception, match="already exists"):
        table._commit(2, holders, columns)


def test_months_and_hashes_as_partitions(spark, tmp_path):
    data = spark.range(200).select(F.lit("s").alias("symbol"), (F.col("id") * 86_400).alias("unix_timestamp"), F.col("id").alias("v"))
    keys = ("symbol", "unix_timestamp")
    for name, part in (("m", by_month("unix_timestamp")), ("h", hashed(list(keys), 4))):
        table = SnapshotTable(spark, str(tmp_path / name), keys, part)
        table.create(data)
        table.merge(data.filter("v >= 190").withColumn("v", F.lit(-1).cast("long")))
        assert table.read().agg(F.sum("v"), F.count("v")).first() == (sum(range(190)) - 10, 200)
    assert sorted(SnapshotTable(spark, str(tmp_path / "m"), keys, by_month("unix_timestamp"))._list(2)[0].items())[-1] == ("1970-07", 2)


def test_duplicates_are_found_in_the_aggregate_the_merge_needs(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (None, 2.0, "b"), (None, 2.0, "b")], SCHEMA)
    one = one_row_per_key(df, ["k"])
    assert rows(one) == rows(df)
    plan = upsert(df, one, ["k"], checked=False)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(k") <= 2
