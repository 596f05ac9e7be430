"""The registered queries of this folder, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from logspark.llm import sql
from logspark.llm.chat import format_chats
from logspark.llm.common import only, table
from logspark.llm.decontaminate import find_contamination
from logspark.llm.fill_in_middle import fill_in_middle, restored_text
from logspark.llm.neighbours import nearest_neighbours
from logspark.llm.packing import packed_documents
from logspark.llm.pii import replace_personal_data
from logspark.llm.quality import judge_quality
from logspark.llm.secret_scan import scan_secrets
from logspark.llm.simhash import near_duplicates
from logspark.llm.substring import remove_repeated
from logspark.llm.url_filter import Rule, judge_urls
from logspark.llm.warc import archived_pages
from logspark.llm.whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(name: str):
    def add(f):
        QUERIES[name] = f
        return f
    return add


@_query("op8_decontamination")
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query("op9_simhash_near_duplicates")
def simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@_query("op7_secret_scan")
def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


@_query("op6_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
    )


@_query("op10_quality_rules")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = only(table(spark, sf_dir, "documents"), doc_id="long", text="string")
    return judge_quality(docs, table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"
    )


#: Stands in for a secret that a real run gets from outside.
PII_KEY = "surrogates of the registered query"


@_query("op5_pii_surrogates")
def pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_personal_data(table(spark, sf_dir, "documents"), PII_KEY)


RULES = (
    Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"),
)


@_query("op3_url_filter")
def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list is made of the URLs of pages that are symbols by a twentieth or more, and holds for all their variants."""
    pages = table(spark, sf_dir, "pages")
    symbols = F.length("html") - F.length(F.translate("html", "#$%*", ""))
    listed = pages.where(20 * symbols > F.length("html")).select("url")
    return judge_urls(pages, RULES, listed).drop("possible")


SQL["op3_url_filter"] = sql.URL_FILTER


@_query("op1_warc_conversion")
def warc_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(table(spark, sf_dir, "pages"))


@_query("op4_chat_formatting")
def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))


SQL["op4_chat_formatting"] = sql.CHATS


@_query("op2_substring_dedup")
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated(table(spark, sf_dir, "documents"))


@_query("op13_fill_in_middle")
def fill_in_the_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored_text(), 256).alias("restored_sha256"),
    )


SQL["op13_fill_in_middle"] = sql.FILL_IN_MIDDLE


@_query("op12_embedding_whitening")
def embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


@_query("op11_nearest_neighbours")
def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
