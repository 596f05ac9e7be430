"""Change feeds against plain Python, batch by batch; versions of a dimension."""

import collections
import itertools
import random

import pytest
from pyspark.sql import functions as F, types as T

from logspark.streaming.feeds import EnrichedFeed, PairFeed, TotalsFeed, VersionTable, join_as_of

DDL = "day int, kind string, who string, bytes long"


@pytest.fixture(autouse=True)
def few_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def fed(spark, tmp_path, ddl, batches, run):
    """Each batch is a run of the stream, which stops and goes on."""
    events = f"{tmp_path}/events"
    for k, batch in enumerate(batches):
        spark.createDataFrame(batch, ddl).coalesce(1).write.mode("append").parquet(events)
        run(spark.readStream.schema(ddl).parquet(events), f"{tmp_path}/checkpoint").awaitTermination()
        yield k


def totals(rows):
    out = collections.defaultdict(lambda: [0, set(), set()])
    for day, kind, who, size in rows:
        of = out[day, kind]
        of[0] += 1
        of[1] |= {who} - {None}
        of[2] |= {size} - {None}
    return {k: (n, len(a), len(b)) for k, (n, a, b) in out.items()}


def test_totals_by_their_changes(spark, tmp_path):
    rng = random.Random(1)
    some = lambda day, n: [(day, rng.choice(["x", "y", None]), rng.choice(["a", "b", None]), rng.randrange(3)) for _ in range(n)]
    batches = [some(0, 30), some(1, 30), some(2, 30), some(3, 30) + some(0, 1), [(None, "x", "a", 1)], []]
    feed = TotalsFeed(f"{tmp_path}/state", T.StructType.fromDDL(DDL), ("day", "kind"), (("users", "who"), ("sizes", "bytes")), F.col("day"))
    seen, before = [], {}
    for k in fed(spark, tmp_path, DDL, batches, feed.run):
        seen += batches[k]
        want = totals(seen)
        for got in (feed.totals(spark), feed.applied(spark)):
            assert {(r.day, r.kind): (r.event_count, r.users, r.sizes) for r in got.collect()} == want
        if batches[k]:
            changes = spark.read.parquet(feed.changes.folder(k)).collect()
            assert {(r.day, r.kind): (r.old_event_count, r.old_users, r.old_sizes) for r in changes} == {
                g: before.get(g, (0, 0, 0)) for g in want if want[g] != before.get(g)}
        before = want
    read = [r.rows for r in spark.read.parquet(feed.work.path).orderBy("batch_id").collect()]
    # New days read nothing; a late row reads its day only.
    assert read[:3] == [0, 0, 0] and 0 < read[3] <= 3 * (1 + 3 + 4) and read[4] == 0
    assert feed.totals(spark, 5).count() == sum(n > 5 for n, _, _ in before.values())


def test_pairs_by_the_change_of_a_product(spark, tmp_path):
    ddl = "side int, bucket string, host string, kind string"
    rng = random.Random(2)

    def some(n, buckets):
        rows = []
        for _ in range(n):
            side, bucket = rng.randrange(2), rng.choice(buckets)
            rows.append((side, bucket, rng.choice(["h", "i", None]) if not side else None, rng.choice(["k", "l"]) if side else None))
        return rows

    batches = [some(60, ["1", "2"]), some(40, ["2", "3", None]), some(5, ["1"]), some(30, ["4"])]
    feed = PairFeed(f"{tmp_path}/state", T.StructType.fromDDL(ddl), ("host",), ("kind",), F.col("bucket").cast("int"))
    seen = []
    for k in fed(spark, tmp_path, ddl, batches, feed.run):
        seen += batches[k]
        want = collections.Counter(
            (a[2], b[3]) for a, b in itertools.product(seen, seen) if a[0] == 0 and b[0] == 1 and a[1] is not None and a[1] == b[1])
        assert {(r.host, r.kind): r.correlated_events for r in feed.totals(spark).collect()} == want
    # State of a bucket's slot: the newest version and the one before.
    assert all(len(list((tmp_path / "state/counts" / f"_slot={s}").glob("_batch=*"))) <= 2 for s in (1, 2, 3, 4, -1))


def test_rows_with_the_version_that_held(spark):
    versions = spark.createDataFrame([("a", "m1", 10), ("a", "m2", 20), ("b", "n1", 0)], "username string, mail string, valid_from int")
    rows = spark.createDataFrame([("a", 9), ("a", 10), ("a", 19), ("a", 20), ("a", 99), ("b", 5), ("c", 5), (None, 5), ("b", None)], "username string, t int")
    got = {(r.username, r.t): r.mail for r in join_as_of(rows, versions, "t").collect()}
    assert got == {("a", 10): "m1", ("a", 19): "m1", ("a", 20): "m2", ("a", 99): "m2", ("b", 5): "n1"}


def test_a_user_that_changes_gives_a_new_text(spark, tmp_path):
    attempt = T.StructType.fromDDL(
        "username string, warning_count long, failure_time string, failure_source_ip string, failed_details string, log_id string")
    user = T.StructType.fromDDL("username string, first_name string, last_name string, language string, mail string, valid_from string")
    stream = T.StructType([T.StructField("attempt", attempt), T.StructField("user", user)])
    login = lambda name, n, at: ((name, n, at, "ip", "d", at), None)
    person = lambda name, mail, since: (None, (name, "F", "L", "en", mail, since))
    text = lambda mail, n, at: f"en, F, L, {mail}, {n}, {at}, ip, d"
    batches = [
        [login("a", 3, "t1"), login("b", 4, "t1"), person("a", "m1", "0")],
        [person("b", "n1", "0"), login("c", 5, "t2")],
        [person("a", "m2", "1"), person("b", "n1", "1")],
        [login("a", 6, "t5"), login("a", 7, "t4"), person("a", "m0", "0")],
    ]
    want = [
        [("a", text("m1", 3, "t1"), None)], [("b", text("n1", 4, "t1"), None)], [("a", text("m2", 3, "t1"), text("m1", 3, "t1"))],
        [("a", text("m2", 6, "t5"), text("m2", 3, "t1"))],
    ]
    feed = EnrichedFeed(f"{tmp_path}/state", attempt, user, ("failure_time", "log_id"), ("valid_from",), shares=2)
    for k in fed(spark, tmp_path, stream, batches, feed.run):
        assert [(r.username, r.big_string, r.old_big_string) for r in spark.read.parquet(feed.changes.folder(k)).collect()] == want[k]
    assert {tuple(r) for r in feed.enriched(spark).collect()} == {("a", text("m2", 6, "t5")), ("b", text("n1", 4, "t1"))}


def test_versions_of_slots(spark, tmp_path):
    table = VersionTable(f"{tmp_path}/t", T.StructType.fromDDL("v int"))
    rows = lambda *of: spark.createDataFrame(of, "v int, _slot long")
    assert table.latest(spark).count() == 0
    for batch_id, of in enumerate([rows((1, 0), (2, 1)), rows((3, 1)), rows((4, 1))]):
        table.write(of, batch_id)
    table.write(rows((5, 1)), 2)  # a batch that runs again
    assert sorted(r.v for r in table.latest(spark).collect()) == [1, 5]
    assert sorted(r.v for r in table.latest(spark, upto=1).collect()) == [1, 3]
    assert [r.v for r in table.latest(spark, [1, 7], 0).collect()] == [2]
    table.remove_before(spark, [0, 1], 2)
    assert sorted(p.name for p in (tmp_path / "t/_slot=1").glob("_batch=*")) == ["_batch=1", "_batch=2"]
