"""Quality rules: counts over each text, and a likelihood ratio of hashed n-grams.

Words and pairs of neighbouring words are hashed into a fixed number of buckets. Two multinomials over the
buckets are compared: the trusted one from documents labelled good, the raw one from all documents.
A document's score is the sum of its n-grams' log ratios over their number, so long and short
documents are judged alike. Ratios are whole numbers of 1/10,000, so a sum does not depend on order
and the threshold decides alike on every run.

Everything is DataFrame functions. Counting combines within each task to one row per bucket at
most; the model is a fixed number of buckets, whatever the corpus. Scoring reads each row by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from logspark.llm.common import only

SPACE = r"\x20\x09-\x0D"
SYMBOLS = "#*$%&|<>"
#: Words of a window of the repetition rule.
WINDOW = 8
BUCKETS, SCALE = 1 << 16, 10_000
#: Added to each bucket of both multinomials: a bucket of few n-grams says little.
PRIOR = 4.0
#: Labelled documents that the trusted multinomial is fitted on, at most.
TRUSTED_DOCS = 20_000
#: Mean log ratio, in natural units, below which a document is rejected.
THRESHOLD = -0.15


def _with(value: Column, f) -> Column:
    """f(value) with ``value`` computed once, and only where the whole is asked for."""
    return F.transform(F.array(value), f)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), "")


def _neighbours(hashes: Column, step: int) -> Column:
    """Hash of each entry with the one ``step`` places after it, as far as there are any."""
    n = F.greatest(F.size(hashes) - step, F.lit(0))
    return F.zip_with(F.slice(hashes, 1, n), F.slice(hashes, step + 1, n), lambda a, b: F.xxhash64(a, b))


def _window_hashes(docs: DataFrame) -> DataFrame:
    """Adds ``hashes``, a 64-bit hash of each window of words; windows with equal hashes are taken as equal.

    Words are hashed once, then runs of two, four and eight from those of half the length.
    """
    docs = docs.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    for step in (1, 2, 4):
        docs = docs.withColumn("hashes", _neighbours(F.col("hashes"), step))
    return docs


def _covered(hashes: Column) -> Column:
    """Words inside windows whose hash occurs again: sort, find equal neighbours, merge their places."""
    in_order = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def places(s: Column) -> Column:
        def again(x: Column, k: Column) -> Column:
            before, after = F.get(s, k - 1)["h"], F.get(s, k + 1)["h"]
            return F.coalesce(before == x["h"], F.lit(False)) | F.coalesce(after == x["h"], F.lit(False))
        return F.array_sort(F.transform(F.filter(s, again), lambda x: x["i"]))

    def merge(acc: Column, i: Column) -> Column:
        end = i + WINDOW
        return F.struct((acc["n"] + end - F.greatest(acc["end"], i)).alias("n"), end.alias("end"))

    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    return F.aggregate(_with(in_order, places), start, merge, lambda acc: acc["n"])


def text_counts(docs: DataFrame) -> DataFrame:
    """Adds to ``text`` the columns ``words`` and the counts of the base rules."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(f"[^{SPACE}]"))
    repeated = F.when(F.size(F.array_distinct("hashes")) == F.size("hashes"), 0).otherwise(_covered(F.col("hashes")))
    return (
        _window_hashes(docs.withColumn("words", words_of(F.col("text"))))
        .withColumns({
            "n_words": F.size("words").cast("long"),
            "word_chars": F.length(F.array_join("words", "")).cast("long"),
            "n_symbols": (F.length(text) - F.length(F.regexp_replace(text, f"[{SYMBOLS}]+", ""))).cast("long"),
            "n_dup_lines": _with(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
            "n_repeat_words": repeated.cast("long"),
        })
        .withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
        .drop("hashes")
    )


def _bucket(*words: Column) -> Column:
    return F.xxhash64(*words).bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def _pairs(words: Column) -> tuple[Column, Column]:
    """Each word that has a word after it, and that word."""
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.slice(words, 1, n), F.slice(words, 2, n)


def _buckets(words: Column) -> Column:
    """Bucket of each word, then of each pair of neighbours."""
    return F.concat(F.transform(words, lambda w: _bucket(w)), F.zip_with(*_pairs(words), lambda a, b: _bucket(a, b)))


def trusted_ids(labels: DataFrame, bound: int = TRUSTED_DOCS) -> DataFrame:
    """doc_id of at most ``bound`` documents labelled good and not toxic, drawn by hash of the id."""
    return (
        only(labels, doc_id="long", quality="int", toxic="int")
        .where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null")
        .select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    )


def fit_ratios(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row, ``ratios``: the log ratio of each bucket, trusted over raw, in 1/SCALE."""
    trusted = F.broadcast(trusted_ids(labels).withColumn("good", F.lit(1)))  # TRUSTED_DOCS ids at most
    grams = (
        only(docs, doc_id="long", text="string").join(trusted, "doc_id", "left")
        .select("good", words_of(F.col("text")).alias("words"))
        # A row for each word and the one after it, if any: compiled, unlike functions over arrays.
        .select("good", F.explode(F.arrays_zip("words", F.slice("words", 2, F.size("words")).alias("next"))).alias("at"))
        .select("good", F.explode(F.array(_bucket(F.col("at.words")), F.when(F.col("at.next").isNotNull(), _bucket(F.col("at.words"), F.col("at.next"))))).alias("bucket"))
        .where("bucket is not null")
    )
    counts = grams.groupBy("bucket").agg(F.count("good").alias("good"), F.count("*").alias("raw"))
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    filled = every.join(counts, "bucket", "left").select("bucket", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "raw")])
    rows = F.array_sort(F.collect_list(F.struct("bucket", "good", "raw")))

    table = filled.agg(rows.alias("rows"), F.sum("good").alias("n_good"), F.sum("raw").alias("n_raw"))
    # Raw counts scaled to as many n-grams as the trusted ones; then both have the same total.
    expected = lambda r: r["raw"] * F.col("n_good") / F.col("n_raw")
    ratio = F.transform(
        "rows", lambda r: F.round(F.log((r["good"] + PRIOR) / (expected(r) + PRIOR)) * SCALE).cast("int")
    )
    # Nothing trusted to compare with: every ratio is zero.
    return table.select(F.when(F.col("n_good") > 0, ratio).otherwise(F.transform("rows", lambda r: F.lit(0))).alias("ratios"))


def judge_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` (doc_id, text), ``words``, the counts of the base rules, ``base_failed``,
    ``score`` (mean log ratio in 1/SCALE) and ``kept``.

    A null or empty text has no words and fails the base rules. Repeated rows are judged each and
    count each in the raw multinomial. Without trusted documents only the base rules decide.
    """
    at_least = round(threshold * SCALE)
    # Always true, and of a kind that filters on the result are not moved below: there they would
    # repeat the work on a text for each of its words.
    here = F.monotonically_increasing_id() >= 0
    return (
        text_counts(docs)
        .withColumn("grams", _buckets(F.col("words")))
        .withColumn("ratios", fit_ratios(docs, labels).scalar())
        .withColumn("total", F.aggregate("grams", F.lit(0).cast("long"), lambda a, b: a + F.get("ratios", b).cast("long")))
        .withColumn("score", F.col("total") / F.greatest(F.size("grams"), F.lit(1)))
        .withColumn("kept", here & ~F.col("base_failed") & (F.col("total") >= at_least * F.size("grams").cast("long")))
        .drop("grams", "ratios", "total")
    )
