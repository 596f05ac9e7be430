"""Day tables in versions: readers during a rewrite, crashes, two writers, replayed batches, number of parts."""

import math
from datetime import date, datetime

import pytest

from logspark.operators.versions import VersionConflict
from logspark.sources.days import DayTable, Part

DDL = "event_ts timestamp, k string, event_date date"


def rows(spark, *days_and_keys):
    made = [(datetime.fromisoformat(f"{d} 12:00:00") if d else None, k, date.fromisoformat(d) if d else None) for d, k in days_and_keys]
    return spark.createDataFrame(made, DDL).coalesce(1)


def keys(df):
    return sorted(r.k for r in df.collect())


@pytest.fixture
def table(spark, tmp_path):
    return DayTable(str(tmp_path / "t"), spark.createDataFrame([], DDL).schema, fan=3, keep=4)


def parts_on_disk(path):
    return {(f.parent.name[6:], f.name[11:]) for f in path.glob("t/data/write=*/event_date=*")}


def test_table_without_rows(spark, table):
    assert table.read(spark).collect() == [] and table.read(spark).columns == ["event_ts", "k", "event_date"]
    table.append(rows(spark))
    table.replace_day(spark, "2024-01-01")
    assert table.read(spark, "2024-01-01").collect() == []
    assert table.read(spark).dtypes[2] == ("event_date", "date")


def test_reader_sees_one_version_through_a_replaced_day(spark, table):
    table.append(rows(spark, ("2024-01-01", "a"), ("2024-01-02", "b"), (None, "n")))
    table.append(rows(spark, ("2024-01-01", "c")))
    opened, version = table.read(spark), table.versions(spark)[-1]
    table.replace_day(spark, "2024-01-01", rows(spark, ("2024-01-01", "new")))
    table.replace_day(spark, None, rows(spark, (None, "none")))
    table.replace_day(spark, date(2024, 1, 2))
    assert keys(opened) == keys(table.read(spark, version=version)) == ["a", "b", "c", "n"]
    assert keys(table.read(spark)) == ["b", "new", "none"]
    assert {r.k: r.event_date for r in table.read(spark).collect()} == {"b": date(2024, 1, 2), "new": date(2024, 1, 1), "none": None}


def test_range_lists_only_its_days(spark, table):
    table.append(rows(spark, *((f"2024-01-{d:02}", f"{d}") for d in range(1, 29))))
    some = table.read(spark, "2024-01-10 00:00:00", datetime(2024, 1, 12, 12))
    assert keys(some) == ["10", "11"]
    assert len({f.split("event_date=")[1][:10] for f in some.inputFiles()}) <= 5
    assert keys(table.read(spark, since="2024-01-28")) == ["28"]


def test_parts_of_a_day_follow_the_logarithm_of_the_writes(spark, table, tmp_path):
    most = 0
    for n in range(20):
        table.append(rows(spark, ("2024-01-01", f"{n:02}"), *([("2024-01-02", "x")] if n == 7 else [])))
        most = max(most, len([p for p in table.content(spark).parts if p.day == "2024-01-01"]))
    assert most <= 2 * (math.log(20, 3) + 1)
    assert keys(table.read(spark)) == sorted([f"{n:02}" for n in range(20)] + ["x"])
    assert len(table.versions(spark)) == 4
    # What is on disk is what the kept versions list, nothing else.
    assert parts_on_disk(tmp_path) == {(p.write, p.day) for v in table.versions(spark) for p in table.content(spark, v).parts}


def test_batch_of_a_stream_is_added_once_even_when_merged(spark, table):
    for n in (0, 1, 2, 2, 0):
        table.append(rows(spark, ("2024-01-01", f"{n}")), "s", n)
    table.append(rows(spark, ("2024-01-01", "other")), "t", 0)
    assert keys(table.read(spark)) == ["0", "1", "2", "other"]
    assert {p.level for p in table.content(spark).parts} == {0, 1}


@pytest.mark.parametrize("step", ["_put_in_place", "_clean", "_swap"])
def test_crash_between_steps_loses_and_doubles_nothing(spark, table, tmp_path, monkeypatch, step):
    for n in range(2):
        table.append(rows(spark, ("2024-01-01", f"{n}")), "s", n)
    before = keys(table.read(spark))

    def lost(self, *args):
        raise ConnectionError("lost")

    with monkeypatch.context() as crash:
        crash.setattr(DayTable, step, lost)
        with pytest.raises(ConnectionError):
            table.append(rows(spark, ("2024-01-01", "2")), "s", 2)
    assert keys(table.read(spark)) in (before, ["0", "1", "2"])
    table.append(rows(spark, ("2024-01-01", "2")), "s", 2)
    table.append(rows(spark, ("2024-01-01", "3")), "s", 3)
    assert keys(table.read(spark)) == ["0", "1", "2", "3"]
    table.remove_leftovers(spark)
    assert {w for w, _ in parts_on_disk(tmp_path)} <= {p.write for v in table.versions(spark) for p in table.content(spark, v).parts}
    assert keys(table.read(spark)) == ["0", "1", "2", "3"]


def test_rows_added_during_a_rewrite_stay(spark, table, monkeypatch):
    table.append(rows(spark, ("2024-01-01", "a")))
    swap = DayTable._swap

    def overtaken(self, *args):
        monkeypatch.setattr(DayTable, "_swap", swap)
        table.append(rows(spark, ("2024-01-01", "late")))
        swap(self, *args)

    monkeypatch.setattr(DayTable, "_swap", overtaken)
    table.replace_day(spark, "2024-01-01", rows(spark, ("2024-01-01", "new")))
    assert keys(table.read(spark)) == ["late", "new"]


def test_second_rewrite_of_the_same_parts_is_an_error(spark, table, tmp_path):
    table.append(rows(spark, ("2024-01-01", "a")))
    old = table.content(spark).parts
    table.replace_day(spark, "2024-01-01", rows(spark, ("2024-01-01", "first")))
    new = table._store(rows(spark, ("2024-01-01", "second")))
    with pytest.raises(VersionConflict):
        table._swap(spark, old, new)
    assert keys(table.read(spark)) == ["first"]
    assert (new[0].write, new[0].day) not in parts_on_disk(tmp_path)


def test_writer_that_comes_second_makes_its_change_on_the_newer_version(spark, table, monkeypatch):
    put, calls = DayTable._put_in_place, []

    def overtaken(self, spark, version, content):
        calls.append(version)
        if len(calls) == 1:
            put(self, spark, version, {"parts": [], "streams": {"other": 7}})
        put(self, spark, version, content)

    monkeypatch.setattr(DayTable, "_put_in_place", overtaken)
    table.append(rows(spark, ("2024-01-01", "a")))
    assert calls == [1, 2]
    assert keys(table.read(spark)) == ["a"] and table.content(spark).streams == {"other": 7}


def test_clustered_days(spark, tmp_path):
    table = DayTable(str(tmp_path / "t"), spark.createDataFrame([], DDL).schema, by=("k",), fan=2)
    for n in range(3):
        table.append(rows(spark, *(("2024-01-01", f"{i}") for i in range(n, 9, 3))))
    assert keys(table.read(spark)) == [f"{i}" for i in range(9)]
    assert all(isinstance(p, Part) for p in table.content(spark).parts)


def test_stream_goes_on_where_it_stopped(spark, table, tmp_path):
    for n in range(4):
        rows(spark, ("2024-01-01", f"{n}"), (f"2024-01-0{n + 2}", f"d{n}")).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(DDL).parquet(str(tmp_path / "in"))
        table.stream(stream, str(tmp_path / "c"), available_now=True).awaitTermination()
    assert keys(table.read(spark)) == ["0", "1", "2", "3", "d0", "d1", "d2", "d3"]
    assert list(table.content(spark).streams.values()) == [3]
