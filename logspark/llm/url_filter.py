"""URL verdicts: host and path rules first, then a list of canonical URLs behind a blocked Bloom filter.

The list is filed in blocks of 256 bits: a URL's hash picks one block and eight bits in it, so the
filter is a table with one row per block, built by OR within each task first, and a probe reads one row.
URLs whose bits are all set are possible hits; an exact hash join with the list removes those that
are not on it. All other URLs never meet the list.

The number of blocks follows the list. The filter is broadcast only where its size is below a
bound; beyond that the probe is an ordinary join on the block number, which is as even as the hash.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from logspark.llm.common import only, saved

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Query parameters that say where a visitor came from, not what is shown.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"
#: Listed URLs per block on average: 16 bits each.
PER_BLOCK, LANES = 16, 4
#: Blocks whose filter is broadcast: 40 bytes each, 8 MB in all.
BROADCAST_BLOCKS = 200_000
#: Odd multipliers below 2**31, two per lane.
SALTS = (1203114875, 1150766481, 1441836195, 1529816327, 1618033989, 1732050807, 1414213563, 2078917053)


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


def _extract(url: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://" + pattern, 1), F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.translate(_extract(url, "([^/?#]*)"), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return _extract(url, "[^/?#]*([^?#]*)")


def canonical(url: Column) -> Column:
    """One text for the variants of a URL: no scheme, default port, ``www.``, fragment, tracking or
    closing slash, and parameters in order. Null where there is no host."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), "^www[.]", ""), ":(80|443)$", "")
    path = F.regexp_replace(path_of(url), "/+$", "")
    asked = F.array_sort(F.filter(
        F.split(_extract(url, r"[^?#]*[?]([^#]*)"), "&", -1), lambda p: (p != "") & ~p.rlike(TRACKING)
    ))
    query = F.when(F.size(asked) > 0, F.concat(F.lit("?"), F.array_join(asked, "&"))).otherwise("")
    return F.when(host != "", F.concat(host, path, query))


def matched_rule(rules: Sequence[Rule], value) -> Column:
    """``value(rule)`` of the longest rule that fits the columns ``host`` and ``path``; null if none does."""
    out = None
    for rule in sorted(rules, key=lambda r: -len(r.host + r.path)):
        fits = ((F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)) & F.col("path").startswith(rule.path)
        out = F.when(fits, value(rule)) if out is None else out.when(fits, value(rule))
    return F.lit(None).cast("string") if out is None else out


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.shiftright(F.xxhash64(url), 32), F.lit(blocks)).cast("int")


def _masks(url: Column) -> list[Column]:
    low = F.xxhash64(url).bitwiseAND(F.lit(0x7FFFFFFF))

    def bit(salt: int) -> Column:
        # Six of the middle bits of a product below 2**62.
        return F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(low * salt, 25).bitwiseAND(F.lit(63)).cast("int"))

    return [bit(SALTS[2 * k]).bitwiseOR(bit(SALTS[2 * k + 1])) for k in range(LANES)]


def bloom_blocks(listed: DataFrame, blocks: int) -> DataFrame:
    """The filter as a table: ``block`` and its lanes. ``listed`` has ``listed_url``."""
    url = F.col("listed_url")
    rows = listed.select(_block(url, blocks).alias("block"), *[m.alias(f"lane{k}") for k, m in enumerate(_masks(url))])
    return rows.groupBy("block").agg(*[F.bit_or(f"lane{k}").alias(f"lane{k}") for k in range(LANES)])


def judge_urls(pages: DataFrame, rules: Sequence[Rule], listed: DataFrame) -> DataFrame:
    """Per page: host, path, the longest fitting rule, and the verdict.

    ``listed`` has a column ``url``; it is taken in canonical form, repeated and null URLs count once
    and not at all. Without a fitting rule a page is blocked if its canonical URL is listed. A null
    URL, or one without ``://``, has empty host and path and is allowed. Extra columns are dropped.
    """
    table = saved(listed.select(canonical(F.col("url").cast("string")).alias("listed_url")).where("listed_url is not null").distinct(), "listed")
    blocks = max(1, -(-table.count() // PER_BLOCK))
    bloom = bloom_blocks(table, blocks)
    if blocks <= BROADCAST_BLOCKS:
        bloom = F.broadcast(bloom)
    url = F.col("url")
    asked = only(pages, page_id="long", url="string").select(
        "page_id", host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias("canonical"),
    ).withColumn("block", F.coalesce(_block(F.col("canonical"), blocks), F.lit(0)))
    inside = F.lit(True)
    for k, mask in enumerate(_masks(F.col("canonical"))):
        inside = inside & (F.col(f"lane{k}").bitwiseAND(mask) == mask)
    probed = asked.join(bloom, "block", "left").withColumn(
        "possible", F.col("canonical").isNotNull() & F.coalesce(inside, F.lit(False))
    ).select("page_id", "host", "path", "canonical", "possible")
    exact = probed.where("possible").join(
        table.withColumn("listed", F.lit(True)), F.col("canonical") == F.col("listed_url"), "left"
    ).select(*probed.columns, F.coalesce("listed", F.lit(False)).alias("listed"))
    judged = exact.unionAll(probed.where("not possible").withColumn("listed", F.lit(False)))
    method = F.when(F.col("listed"), "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", matched_rule(rules, lambda r: r.host + r.path).alias("rule"),
        F.coalesce(matched_rule(rules, lambda r: r.verdict), method).alias("verdict"), "canonical", "possible", "listed",
    )
