"""Archives, URL verdicts, conversations, the registry and the pipeline."""

import collections
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from compare import assert_same
from logspark.llm import warc
from logspark.llm.chat import format_chats
from logspark.llm.components import components
from logspark.llm.queries import QUERIES, RULES, SQL
from logspark.llm.url_filter import judge_urls


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_against_sql(spark, sf_check, name):
    assert assert_same(QUERIES[name](spark, sf_check), sf_check, SQL[name]) > 0


def test_registry():
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


# --- archives ------------------------------------------------------------------------------------


def archived(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    first, out = {}, collections.Counter()
    for page, _, html in order:
        body = (html or "").encode()
        digest = hashlib.sha256(body).hexdigest()
        again = len(body) >= 100 and digest in first
        out[page, len(body), digest, "revisit" if again else "response", first[digest] if again else None] += 1
        if len(body) >= 100:
            first.setdefault(digest, page)
    return out


BIG = "x" * 120
PAGES = [
    (5, "http://a b/\n", BIG), (3, "u", BIG), (None, None, BIG), (None, None, BIG), (9, "", None), (8, "é", "short"), (7, "q", "short"),
    (3, "u", BIG), (11, "z", "y" * 17_000_000), (12, "z", "y" * 17_000_000), (13, "e", "é" * 60), (2, "e", "é" * 60),
    (4, "h", "HTTP/1.1 200 OK\r\n\r\nWARC/1.1\r\n" * 9), (6, "h", "HTTP/1.1 200 OK\r\n\r\nWARC/1.1\r\n" * 9),
]


def test_archives_there_and_back(spark):
    frame = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("digest", F.lit(1)).repartition(3)
    got = warc.archived_pages(frame)
    assert collections.Counter(tuple(r)[:5] for r in got.collect()) == archived(PAGES)
    assert got.where("not intact").count() == 0 and warc.archived_pages(frame.limit(0)).count() == 0


def test_archives_of_all_pages(spark, sf_check):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_check}/pages.parquet").select("page_id", "url", "html").collect()]
    assert collections.Counter(tuple(r)[:5] for r in QUERIES["op1_warc_conversion"](spark, sf_check).collect()) == archived(rows)


def test_both_arc_versions_and_broken_ones():
    about = b"1 0 origin\nURL IP-address Archive-date Content-type Archive-length\n"
    one = b"filedesc://a.arc 0.0.0.0 1999 text/plain %d\n" % len(about) + about + b"\n"
    one += b"http://x/a b 1.2.3.4 19990101 text/html 5\nhello\ndns:x 1.2.3.4 19990101000000 text/dns 2\nok\n"
    got = list(warc.read_arc(one))
    assert [(a["URL"], b, p) for _, a, b, p in got] == [("http://x/a b", b"hello", None), ("dns:x", b"ok", None)]
    assert got[0][1]["archive"] == "a.arc" and warc._iso("19990101") == "1999-01-01T00:00:00Z"
    about = b"2 0 origin\nURL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length\n"
    two = b"filedesc://b.arc 0.0.0.0 1999 text/plain 200 - - 0 b.arc %d\n" % len(about) + about + b"\n"
    two += b"http://y 1.2.3.4 19990101000000 text/html 200 abc - 99 b.arc 3\nxyz\n"
    (_, arc, block, problem), = warc.read_arc(gzip.compress(two))
    assert (arc["URL"], arc["Checksum"], block, problem) == ("http://y", "abc", b"xyz", None)
    assert [p for *_, p in warc.read_arc(one[:-4])][-1] == "shorter than declared"
    assert "no 5 fields" in [p for *_, p in warc.read_arc(one + b"junk\n")][-1]
    assert "unreadable" in [p for *_, p in warc.read_arc(gzip.compress(one)[:-20])][-1]


# --- URL verdicts --------------------------------------------------------------------------------


def test_verdicts_of_edges(spark):
    pages = spark.createDataFrame([
        (1, None), (2, ""), (3, "no scheme"), (4, "HTTP://Example.ORG"), (5, "x://A.example.org/en/12?x"), (6, "a\nb://Ü.ORG/é#q"),
        (7, "http://h.net:80/x/?b=2&a=1&utm_x=3#f"), (7, "http://h.net:80/x/?b=2&a=1&utm_x=3#f"), (None, "https://www.h.net/x?a=1&b=2"),
        (8, "http://notexample.org/es/"), (9, "http://example.org/es/a"), (10, "http://h.net/x"),
    ], "page_id long, url string").withColumn("host", F.lit(1)).withColumn("block", F.lit(1))
    listed = spark.createDataFrame([("http://h.net/x?b=2&a=1",), ("http://h.net/x?b=2&a=1#z",), (None,)], "url string")
    got = collections.Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, RULES, listed).collect())
    assert got == collections.Counter([
        (1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "", "", None, "allow"), (4, "example.org", "", None, "allow"),
        (5, "a.example.org", "/en/12", "example.org/en/1", "block"), (6, "Ü.org", "/é", "org/", "allow"),
        (7, "h.net:80", "/x/", None, "block"), (7, "h.net:80", "/x/", None, "block"), (None, "www.h.net", "/x", None, "block"),
        (8, "notexample.org", "/es/", "org/", "allow"), (9, "example.org", "/es/a", "example.org/es/", "block"), (10, "h.net", "/x", None, "allow"),
    ])
    assert judge_urls(pages.limit(0), RULES, listed).count() == 0
    assert judge_urls(pages, [], listed.limit(0)).where("verdict = 'block'").count() == 0


def test_filter_lets_no_listed_url_through_and_few_others(spark):
    urls = spark.range(20_000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://a.net/"), "id").alias("url"))
    got = judge_urls(urls, [], urls.where("page_id % 2 = 0").select("url"))
    assert got.where("listed != (page_id % 2 = 0)").count() == 0
    assert got.where("possible and not listed").count() < 200


# --- conversations -------------------------------------------------------------------------------


def test_snapshots_collapse(spark):
    long = [(0, "user", "hi"), (1, "assistant", "a <|im_end|> b"), (2, "user", None), (3, None, "")]
    rows = [(i, *t) for i, n in ((1, 2), (2, 4), (3, 3), (4, 4)) for t in long[:n]]
    rows += [(5, 0, "user", "hi"), (5, 1, "assistant", "other"), (5, 1, "assistant", "other"), (6, 0, "", "hi"), (7, 1, "assistant", "other")]
    rows += [(8, None, "user", "x"), (8, None, "user", "x"), (None, 0, "user", "n"), (None, 1, "user", "m")]
    rows += [(9, t, "user", f"t{t}") for t in range(3000)] + [(10, t, "user", f"t{t}") for t in range(2000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit("x")).repartition(5)
    got = {(r.conv_id, r.part): (r.n_turns, r.text) for r in format_chats(frame).collect()}
    assert set(got) == {(2, 0), (5, 0), (6, 0), (7, 0), (8, -1), (None, 0), (9, 0), (9, 1), (9, 2)}
    assert got[2, 0] == (4, "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\na <im_end> b<|im_end|>\n"
                            "<|im_start|>user\n<|im_end|>\n<|im_start|>unknown\n<|im_end|>")
    assert got[5, 0][0] == 2 and got[8, -1][0] == 1 and sum(got[9, k][0] for k in range(3)) == 3000
    assert format_chats(frame.limit(0)).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 60, 2)] + [(i + 1, i + 2) for i in range(0, 58, 2)] + [(100, 101), (101, 100), (200, 200)]
    star = [(1000, 1000 + i) for i in range(1, 500)]
    got = {r.u: r.v for r in components(spark.createDataFrame(chain + star, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 60)} | {101: 100} | {1000 + i: 1000 for i in range(1, 500)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
