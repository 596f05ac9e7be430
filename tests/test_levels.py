"""Tables of versions: crashes, readers during merges, number of folders; sketches and clustered days built beside them."""

import math
import random

import pytest
from pyspark.sql import functions as F

from logspark.operators.keyed import KeyedTable
from logspark.operators.levels import LeveledTable
from logspark.operators.versions import VersionConflict
from logspark.sources.bronze import append_clustered, lookup
from logspark.streaming.sketches import sketched_totals, store_sketches

DDL = "k string, t int, v string"


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def folders_on_disk(path):
    return [f for f in (path / "data").glob("batch_id=*/*") if f.is_dir()]


def test_folders_follow_the_logarithm_of_the_batches(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), DDL, ("k",), order=("t",), fan=2)
    rng, want, counts = random.Random(1), {}, []
    for n in range(16):
        batch = [(rng.choice("abcde"), rng.randrange(9), f"{n}-{i}") for i in range(3)]
        batch = list({(k, t): (k, t, v) for k, t, v in batch}.values())
        table.write(spark.createDataFrame(batch, table.schema).coalesce(1), n)
        want |= {k: (k, t, v) for k, t, v in sorted(batch, key=lambda r: r[1])}
        counts.append(len(table.stored.folders(spark)))
    assert rows_of(table.read(spark)) == sorted(want.values())
    assert max(counts) <= 2 * math.log2(16) + 1
    assert len(table.stored.versions(spark)) == 16
    # Two folders at most for each version kept, and those that the oldest of them names.
    assert len(folders_on_disk(tmp_path / "t")) <= 16 + 2 * math.log2(16) + 1


def test_append_mode_and_other_ids_keep_every_row(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), "k string", ("k",), mode="append", fan=2)
    for n in (-1, 0, 3, 7, 7, 9, 12):
        table.write(spark.createDataFrame([("a",), (None,)], table.schema).coalesce(1), n)
    assert table.read(spark).count() == 12
    with pytest.raises(ValueError, match="merged with others"):
        table.write(spark.createDataFrame([("a",)], table.schema), 0)
    assert table.batch(spark, 12).count() == 2


def test_reader_that_opened_a_version_sees_it_through_merges(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), DDL, ("k",), fan=2)
    table.write(spark.createDataFrame([("a", 1, "x"), ("b", 1, "x")], table.schema), 0)
    opened, version = table.read(spark), table.stored.versions(spark)[-1]
    for n in range(1, 5):
        table.write(spark.createDataFrame([("a", n, f"new {n}")], table.schema), n)
    assert rows_of(opened) == [("a", 1, "x"), ("b", 1, "x")]
    assert rows_of(table.read(spark, version)) == [("a", 1, "x"), ("b", 1, "x")]
    assert rows_of(table.read(spark)) == [("a", 4, "new 4"), ("b", 1, "x")]


@pytest.mark.parametrize("crash_at", [1, 2, 3])
def test_crash_between_data_and_version_loses_and_doubles_nothing(spark, tmp_path, monkeypatch, crash_at):
    table = KeyedTable(str(tmp_path / "t"), "k string", ("k",), mode="append", fan=2)
    for n in range(2):
        table.write(spark.createDataFrame([(f"{n}",)], table.schema).coalesce(1), n)
    commit, calls = LeveledTable._commit, []

    def failing(self, *args):
        calls.append(1)
        if len(calls) == crash_at:
            raise ConnectionError("lost")
        return commit(self, *args)

    monkeypatch.setattr(LeveledTable, "_commit", failing)
    for n in (2, 3):
        before = rows_of(table.read(spark))
        for _ in range(2):
            try:
                table.write(spark.createDataFrame([(f"{n}",)], table.schema).coalesce(1), n)
                break
            except ConnectionError:
                # What readers see is whole: the new batch is there if its version is, and merging changes no row.
                assert rows_of(table.read(spark)) in (before, [*before, (f"{n}",)])
    assert len(calls) > crash_at
    assert rows_of(table.read(spark)) == [("0",), ("1",), ("2",), ("3",)]


def test_second_writer_of_a_version_gets_an_error(spark, tmp_path):
    table = LeveledTable(str(tmp_path / "t"))
    table.write(spark.range(3), 0)
    with pytest.raises(VersionConflict):
        table._commit(spark, 1, [])
    assert table.read(spark).count() == 3
    assert not list((tmp_path / "t" / "_versions").glob("draft-*"))


def test_table_without_a_version(spark, tmp_path):
    assert KeyedTable(str(tmp_path / "t"), DDL, ("k",)).read(spark).count() == 0
    with pytest.raises(FileNotFoundError):
        LeveledTable(str(tmp_path / "u")).read(spark)


def test_sketches_of_batches_unite_to_the_sketch_of_all(spark, tmp_path):
    rows = spark.range(60_000).select(
        (F.col("id") % 2).cast("string").alias("g"), F.when(F.col("id") % 7 > 0, F.col("id") % 20_000).alias("x"), F.lit(None).cast("string").alias("none"))
    base = str(tmp_path)
    for n in range(5):
        rows.where(F.col("x").isNull() & (n == 0) | (F.col("x") % 5 == n)).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{base}/in")
        store_sketches(stream, f"{base}/s", f"{base}/c", ["g"], {"xs": "x", "nones": "none"}, fan=2).awaitTermination()
    got = {r.g: r for r in sketched_totals(spark, f"{base}/s", ["g"], {"xs": "x", "nones": "none"}).collect()}
    at_once = {r.g: r.e for r in rows.groupBy("g").agg(F.hll_sketch_estimate(F.hll_sketch_agg(F.col("x").cast("string"), F.lit(12))).alias("e")).collect()}
    exact = {r.g: (r.n, r.e) for r in rows.groupBy("g").agg(F.count("*").alias("n"), F.count_distinct("x").alias("e")).collect()}
    for g, (n, e) in exact.items():
        assert (got[g].event_count, got[g].nones) == (n, 0)
        assert abs(got[g].xs - e) <= 0.05 * e and abs(got[g].xs - at_once[g]) <= 0.03 * e


def scanned_rows(df):
    """Rows the scan handed on."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if hasattr(plan, "executedPlan") and "Adaptive" in plan.nodeName() else plan
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_lookup_reads_few_row_groups(spark, tmp_path):
    rows = spark.range(400_000).select(
        F.concat(F.lit("ip"), F.lpad((F.hash("id") % 5_000).cast("string"), 6, "0")).alias("source_ip"),
        F.concat(F.lit("user"), (F.col("id") * 7919 % 100_000).cast("string")).alias("username"),
        F.expr("timestamp_millis(1704067200000 + id * 400)").alias("event_ts"), F.col("id").alias("event_time"),
        F.expr("date_add(DATE'2024-01-01', cast(id / 200000 as int))").alias("event_date"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 2).alias("details"))
    path = str(tmp_path / "days")
    append_clustered(rows, path, ("source_ip", "username"), group_bytes=256 * 1024)
    some = rows.where("id = 4242").first() if "id" in rows.columns else rows.where("event_time = 4242").first()
    for wanted, most in (({"source_ip": some.source_ip}, 20_000), ({"username": some.username}, 100_000)):
        found = lookup(spark, path, wanted)
        assert scanned_rows(found) <= most
        column, value = next(iter(wanted.items()))
        assert found.count() == rows.where(F.col(column) == value).count() > 0
    assert lookup(spark, path, {"source_ip": "nowhere"}).count() == 0
