"""The corrected stream pattern against plain Python after every micro-batch."""

import collections
import itertools
import random

import pytest
from pyspark.sql import functions as F

from logspark.streaming.corrections import RunPattern, match_run_then_corrected, nearest
from logspark.streaming.sinks import BatchTable

DDL = "user string, t long, id long, kind string, note string"


def matches(rows, min_run=3):
    """(user, run, note of the END row), as a bag."""
    out = collections.Counter()
    for user, of in itertools.groupby(sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0, r[2])), key=lambda r: r[0]):
        run = 0
        for _, _, _, kind, note in of:
            if kind == "end" and run >= min_run:
                out[user, run, note] += 1
            run = run + 1 if kind == "run" else 0
    return out


def run_then_end(keys=("user",), min_run=3):
    return RunPattern(
        keys, ("t", "id"), F.col("kind") == "run", F.col("kind") == "end", F.floor(F.col("t") / 10), min_run, (("note", "note"),), "run")


def feed(spark, path, batch):
    spark.createDataFrame(batch, DDL).coalesce(1).write.mode("append").parquet(path)


def run(spark, tmp_path, batches, **options):
    """Feed batch after batch, stopping between them; give the state and the matches after each."""
    events, seen, state = f"{tmp_path}/events", [], None
    for batch in batches:
        feed(spark, events, batch)
        stream = spark.readStream.schema(DDL).parquet(events)
        query, state = match_run_then_corrected(stream, f"{tmp_path}/state", f"{tmp_path}/checkpoint", run_then_end(), **options)
        query.awaitTermination()
        seen.append(collections.Counter(tuple(r) for r in state.matches(spark).collect()))
    return state, seen


def some_rows(rng, n, users, last):
    return [(rng.choice(users), rng.randrange(last), i, rng.choices(["run", "end", "other"], [6, 2, 1])[0], f"n{i}") for i in range(n)]


@pytest.fixture
def few_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.mark.parametrize("seed", [1])
def test_any_order_after_every_batch(spark, few_partitions, tmp_path, seed):
    rng = random.Random(seed)
    rows = some_rows(rng, 160, ["a", "a", "b", None], 120)
    rows += [("a", None, 900 + i, k, f"x{i}") for i, k in enumerate(["run", "run", "run", "end"])]
    rng.shuffle(rows)
    cuts = sorted(rng.sample(range(len(rows)), 3))
    batches = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
    state, seen = run(spark, tmp_path, batches)
    for k, found in enumerate(seen):
        assert found == matches([r for b in batches[: k + 1] for r in b])
    changes = state.all_changes(spark).collect()
    assert {r.change for r in changes} <= {1, -1, 2, -2} and any(r.change < 0 for r in changes)
    upto = collections.Counter()
    for k in range(len(batches)):
        for r in changes:
            if r.batch_id == k:
                upto[r.user, r["run"], r.note] += r.change
        assert +upto == seen[k] and not -upto


def test_a_run_over_many_slots_is_found_and_broken(spark, few_partitions, tmp_path):
    """One run over forty slots without a break; then a late row in its middle, then one that extends it in front."""
    long = [("a", 10 * i, i, "run", "") for i in range(40)] + [("a", 400, 40, "end", "e")]
    far = [("b", 10 * i, 100 + i, "other", "") for i in range(60)]
    state, seen = run(spark, tmp_path, [
        long + far, [("a", 195, 500, "other", "late")], [("a", -5, 501, "run", "")], [("a", 401, 502, "run", ""), ("b", 0, 503, "run", "")],
        [("a", 405, 504, "end", "f")],
    ])
    assert seen[0] == {("a", 40, "e"): 1} and seen[1] == seen[2] == seen[3] == seen[4] == {("a", 20, "e"): 1}
    got = [(r.batch_id, r["run"], r.change) for r in state.all_changes(spark).collect()]
    assert sorted(got) == [(0, 40, 1), (1, 20, 1), (1, 40, -1)]
    work = {r.batch_id: r for r in spark.read.parquet(state.work.path).collect()}
    # A late row scans the rows of its user in its slot, and reads no further than the breaks around it.
    assert [work[k].rows for k in range(5)] == [101, 2, 1, 4, 3]
    assert [work[k].touched for k in range(1, 5)] == [1, 1, 2, 1]


def test_the_read_of_a_late_row_does_not_grow_with_history(spark, few_partitions, tmp_path):
    read = []
    for n in (30, 120):
        rows = [("a", i, i, ["run", "run", "run", "end"][i % 4], f"n{i}") for i in range(10 * n)]
        state, seen = run(spark, tmp_path / str(n), [rows, [("a", 100, 10_000, "other", "")]])
        assert seen[1] == matches(rows + [("a", 100, 10_000, "other", "")])
        late = [r for r in spark.read.parquet(state.work.path).collect() if r.batch_id == 1][0]
        read.append((late.rows, late.touched, late.summarised))
    assert read[0] == read[1] == (11, 1, 3)


def test_a_batch_that_runs_again_changes_nothing(spark, few_partitions, tmp_path):
    rng = random.Random(5)
    rows = some_rows(rng, 60, ["a", "b"], 60)
    events, failed = f"{tmp_path}/events", []

    def fail_once(changes, batch_id):
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost")

    for k, batch in enumerate((rows[:30], rows[30:])):
        feed(spark, events, batch)
        for _ in range(1 + k):
            stream = spark.readStream.schema(DDL).parquet(events)
            query, state = match_run_then_corrected(stream, f"{tmp_path}/state", f"{tmp_path}/checkpoint", run_then_end(), on_changes=fail_once)
            try:
                query.awaitTermination()
            except Exception as error:
                assert "lost" in str(error)
    assert failed == [1]
    assert collections.Counter(tuple(r) for r in state.matches(spark).collect()) == matches(rows)


def test_several_keys_and_empty_input(spark, few_partitions, tmp_path):
    rows = [("a", i, i, "end" if i % 3 == 2 else "run", f"n{i}", i // 30) for i in range(60)]
    stream_ddl = DDL + ", kind2 int"
    path = f"{tmp_path}/events"
    spark.createDataFrame([], stream_ddl).write.parquet(path)
    spark.createDataFrame(rows, stream_ddl).coalesce(1).write.mode("append").parquet(path)
    query, state = match_run_then_corrected(
        spark.readStream.schema(stream_ddl).option("maxFilesPerTrigger", 1).parquet(path), f"{tmp_path}/s", f"{tmp_path}/c", run_then_end(("user", "kind2"), 2))
    query.awaitTermination()
    got = collections.Counter((r.user, r.kind2, r["run"], r.note) for r in state.matches(spark).collect())
    assert got == {("a", i // 30, 2, f"n{i}"): 1 for i in range(2, 60, 3)}


def test_most_matches_of_the_registered_stream_are_never_withdrawn(spark, sf_check):
    from logspark.plans.catalog import corrected

    changes = corrected(spark, sf_check, "w2-test").all_changes(spark).collect()
    added = sum(r.change for r in changes if r.change > 0)
    withdrawn = -sum(r.change for r in changes if r.change < 0)
    assert len({r.batch_id for r in changes}) == 5 and added > 2 * withdrawn > 0


def test_nearest_slots():
    known = [-5, 0, 1, 2, 7, 8, 20, 30]
    assert nearest(known, [1], 1) == {0: 0, 1: 0, 2: 0}
    assert nearest(known, [-5, 20], 1) == {-5: 0, 0: 0, 8: 1, 20: 1, 30: 1}
    assert nearest(known, [1, 7], 1) == {0: 0, 1: 0, 2: 0, 7: 0, 8: 0}
    assert list(nearest(known, [1], 10)) == known
    assert BatchTable("x").folder(1) == "x/batch_id=1"
