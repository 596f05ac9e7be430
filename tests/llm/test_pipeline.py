"""Every stage of the pipeline against plain Python on what the stage before kept."""

import collections
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from logspark.llm import pii, quality, simhash
from logspark.llm.common import saved
from test_text_operators import EDGES, base_counts, contamination, docs_of, grams, linked, rows_of


def some_documents(spark, sf_dir):
    """The documents with clashing columns, a repeated row, a null text, and one doc_id with two texts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name in ("words", "row", "rest", "whole", "bits", "kept"):
        docs = docs.withColumn(name, F.lit("x"))
    two = docs.orderBy("doc_id").limit(2)
    return docs.unionAll(two).unionAll(two.withColumn("text", F.lit(None).cast("string"))).unionAll(
        two.withColumn("doc_id", F.lit(None).cast("long")))


def texts_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def good_rows(rows, labels):
    good = {d for d, q, t in labels if q == 1 and not t}
    raw, trusted = np.zeros(quality.BUCKETS), np.zeros(quality.BUCKETS)
    of = [grams(t) for _, t in rows]
    for (d, _), g in zip(rows, of):
        np.add.at(raw, g, 1)
        if d in good:
            np.add.at(trusted, g, 1)
    exact = np.log((trusted + quality.PRIOR) / (raw * trusted.sum() / raw.sum() + quality.PRIOR)) * quality.SCALE
    ratio = np.where(exact >= 0, np.floor(exact + 0.5), np.ceil(exact - 0.5))
    return [
        r for r, g in zip(rows, of)
        if not base_counts(r[1])[5] and ratio[g].mean() >= quality.THRESHOLD * quality.SCALE
    ]


def first_rows(rows):
    """One row of each group of linked fingerprints: the smallest doc_id."""
    groups = collections.defaultdict(list)
    prints = [simhash.fingerprint(t) for _, t in rows]
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p
    known = sorted(parent)
    bits = np.array(known, np.uint64)
    for p in known:
        for q in bits[np.bitwise_count(bits ^ np.uint64(p)) <= 3].tolist():
            a, b = sorted((root(p), root(q)))
            parent[b] = a
    for p, (doc, _) in zip(prints, rows):
        groups[root(p)].append(doc)
    return sorted((min((d for d in ids if d is not None), default=None) for ids in groups.values()), key=str)


ENTITY = re.compile(r"[\w.]+@[\w.]+\w|\+1 \(\d{3}\) \d{3}-\d{4}|(?<![\w.])\d+\.\d+\.\d+\.\d+(?!\w|\.\d)")


def test_each_stage_equals_plain_python(spark, sf_check):
    import public_tokenizers
    from tokenizers import Tokenizer

    docs, labels = some_documents(spark, sf_check), rows_of(spark, sf_check, "labels", ("doc_id", "quality", "toxic"))
    of = dict(corpus_pipeline.STAGES)
    assert list(of) == ["quality", "near-duplicates", "benchmark", "personal-data", "packing"]

    def stage(name, before):
        out = saved(of[name](spark, before, sf_check), name)
        return out, texts_of(before) if name != "packing" else None

    first, rows = stage("quality", docs)
    assert first.columns == docs.columns
    assert collections.Counter(texts_of(first)) == collections.Counter(good_rows(rows, labels))

    second, rows = stage("near-duplicates", first)
    kept = texts_of(second)
    assert sorted((d for d, _ in kept), key=str) == first_rows(rows) and not collections.Counter(kept) - collections.Counter(rows)
    assert second.columns == docs.columns and len(kept) < len(rows)

    third, rows = stage("benchmark", second)
    judged = contamination(rows, rows_of(spark, sf_check, "benchmark", ("item_id", "text")))
    assert collections.Counter(d for d, _ in texts_of(third)) == collections.Counter(r[0] for r in judged.elements() if not r[5])
    assert third.columns == docs.columns and third.count() < len(rows)

    fourth, rows = stage("personal-data", third)
    after = dict(texts_of(fourth))
    assert fourth.columns == docs.columns and sorted(after) == sorted(d for d, _ in rows)
    assert fourth.where("n_chars != length(text)").count() == 0
    given = {}
    for doc, text in rows:
        for x, y in zip(ENTITY.findall(text), ENTITY.findall(after[doc]), strict=True):
            assert given.setdefault(x, y) == y != x
    assert given and len(set(given.values())) == len(given)
    alone = pii.replace_personal_data(third, corpus_pipeline.PII_KEY)
    assert after == dict(texts_of(alone))

    fifth, _ = stage("packing", fourth)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = collections.defaultdict(list)
    for r in fifth.collect():
        pieces[r.doc_id].append(r)
    assert set(pieces) == set(after)
    for doc, text in after.items():
        ids, at = [*tokenizer.encode(text, add_special_tokens=False).ids, 0], 0
        for p in sorted(pieces[doc], key=lambda r: r.piece):
            assert p.start == at and p.ids_crc32 == zlib.crc32(np.array(ids[at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)


def test_stages_of_empty_tables(spark, sf_check):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, spark.read.parquet(f"{sf_check}/documents.parquet").limit(0), sf_check).count() == 0


def test_pipeline_runs(spark, sf_small):
    assert corpus_pipeline.run(spark, sf_small).count() > 0


@pytest.mark.parametrize("rows", [EDGES, EDGES * 2, [(None, None), (None, ""), (None, "a b"), (2, "A  b"), (1, "a\tB")]])
def test_one_of_each_group_of_near_duplicates(spark, rows):
    kept = simhash.without_near_duplicates(docs_of(spark, rows).repartition(3)).collect()
    assert sorted((r.doc_id for r in kept), key=str) == first_rows(rows) and len(kept[0]) == 9
    assert {r.doc_id for r in kept} == {c for _, _, c in linked(rows)}


def test_one_of_large_groups(spark):
    """A group of copies and a chain of near copies, each a third of all rows."""
    words = [f"w{i}" for i in range(400)]
    rows = [(3000 + i, " ".join(words)) for i in range(300)]
    rows += [(i, " ".join(words[:200] + [f"w{200 + j + (j == i % 200)}" for j in range(200)])) for i in range(300)]
    rows += [(5000 + i, " ".join(f"{i}x{j}" for j in range(50))) for i in range(300)]
    kept = simhash.without_near_duplicates(docs_of(spark, rows)).collect()
    assert sorted((r.doc_id for r in kept), key=str) == first_rows(rows)
    assert simhash.without_near_duplicates(docs_of(spark, rows).limit(0)).count() == 0
