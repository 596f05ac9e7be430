"""Operators on texts against plain Python, on small tables with nulls, ties, repeats and clashing columns."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from logspark.llm import packing, pii, quality, secret_scan, simhash, substring
from logspark.llm.decontaminate import find_contamination, without_contaminated
from logspark.llm.fm_index import FMIndex, matched_windows
from logspark.llm.queries import QUERIES


def docs_of(spark, rows):
    """Rows (doc_id, text) with columns whose names the operators use themselves."""
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("words", "row", "n_words", "spans", "kept", "bits", "rest"):
        frame = frame.withColumn(name, F.lit("x"))
    return frame


def rows_of(spark, sf, table="documents", columns=("doc_id", "text")):
    return [tuple(r) for r in spark.read.parquet(f"{sf}/{table}.parquet").select(*columns).collect()]


EDGES = [
    (None, None), (None, "a b c"), (1, None), (2, ""), (3, " \t\n"), (4, "x"), (4, "x"), (5, "ÉÀ é à"), (6, "y" * 200_000),
    (7, "w " * 30_000), (8, "a b c"),
]


# --- repeated passages ---------------------------------------------------------------------------


def removed(rows, width):
    least, out = {}, collections.Counter()
    for doc, text in rows:
        words = (text or "").encode().split()
        for k in range(len(words) - width + 1 if doc is not None else 0):
            key = tuple(words[k : k + width])
            least[key] = min(least.get(key, doc), doc)
    for doc, text in rows:
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for k in range(len(words) - width + 1 if doc is not None else 0):
            if least[tuple(words[k : k + width])] < doc:
                gone[k : k + width] = [True] * width
        kept = [w for w, g in zip(words, gone) if not g]
        out[doc, len(words), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest()] += 1
    return out


def some_repeats(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "c d", "é", "xx", "q"]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(0, 60))] for _ in range(6)]
    rows = []
    for i in range(90):
        x = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            if x:
                x[rng.randrange(len(x))] = rng.choice(vocabulary)
        text = rng.choice([" ".join(x + rng.choice(base)), "\n\x0b".join(x), " ".join(["w"] * rng.randint(0, 90)), None, ""])
        rows.append((rng.choice([i, i, None, 3]), text))
    return rows


@pytest.mark.parametrize("indexed", [True, False])
def test_repeated_passages(spark, monkeypatch, indexed):
    """Both ways of deciding on windows: shards of an index, and digests for very common anchors."""
    monkeypatch.setattr(substring, "ANCHOR_SEGMENTS", 2000 if indexed else 0)
    monkeypatch.setattr(substring, "SHARD_WORDS", 300)
    rows = some_repeats(5) + EDGES[:6]
    got = substring.remove_repeated(docs_of(spark, rows), 9)
    assert collections.Counter(tuple(r) for r in got.collect()) == removed(rows, 9)
    assert substring.remove_repeated(docs_of(spark, rows).limit(0)).count() == 0


def test_repeated_passages_of_all_documents(spark, sf_check):
    got = QUERIES["op2_substring_dedup"](spark, sf_check)
    assert collections.Counter(tuple(r) for r in got.collect()) == removed(rows_of(spark, sf_check), 50)


def test_repeated_texts_are_given(spark):
    rows = [(1, "a b c d"), (2, "x a b c d y")]
    got = {r.doc_id: r.kept_text for r in substring.remove_repeated(docs_of(spark, rows), 4, texts=True).collect()}
    assert got == {1: "a b c d", 2: "x y"}


def test_index_finds_what_smaller_owners_have():
    rng = np.random.default_rng(3)
    for _ in range(60):
        width, symbols = int(rng.integers(2, 8)), int(rng.integers(1, 6))
        parts = [rng.integers(1, symbols + 1, rng.integers(1, 30)) for _ in range(int(rng.integers(1, 12)))]
        owner = rng.integers(0, 5, len(parts))
        text = np.concatenate([np.append(p, 0) for p in parts])
        length = np.array([len(p) for p in parts])
        start = np.concatenate([[0], np.cumsum(length + 1)[:-1]])
        index = FMIndex(text, np.repeat(owner, length + 1), 64)
        least = {}
        for p, o in zip(parts, owner):
            for i in range(len(p) - width + 1):
                key = tuple(p[i : i + width])
                least[key] = min(least.get(key, 99), o)
        want = np.zeros(len(text), bool)
        for p, o, at in zip(parts, owner, start):
            for i in range(len(p) - width + 1):
                want[at + i] = least[tuple(p[i : i + width])] < o
        assert (matched_windows(index, text, start, length, owner, width) == want).all()


# --- packing -------------------------------------------------------------------------------------


def test_packing_of_all_documents(spark, sf_check, monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "PARTITION_PIECES", 400)
    got = QUERIES["op6_best_fit_packing"](spark, sf_check).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, places = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        places[r.sequence_id].append((r.offset, r.length))
    texts = dict(rows_of(spark, sf_check))
    assert set(pieces) == set(texts)
    for doc, text in texts.items():
        ids, at = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], 0
        assert len(pieces[doc]) == -(-len(ids) // 2048)
        for k, p in enumerate(sorted(pieces[doc], key=lambda r: r.piece)):
            assert (p.piece, p.start) == (k, at) and (k == 0 or p.length == 2048)
            assert p.ids_crc32 == zlib.crc32(np.array(ids[at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)
    for of in places.values():
        at = 0
        for offset, length in sorted(of):
            assert offset == at
            at += length
        assert at <= 2048
    lengths = np.array([r.length for r in got])
    assert len(places) <= packing.lower_bound(lengths, 2048) + 6


def test_packing_of_edges(spark):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    frame = docs_of(spark, EDGES[:6] + [(9, "Привет 世界 <|endoftext|>")])
    for ranks in (None, public_tokenizers.path("byte_bpe_50k.tiktoken")):
        got = packing.packed_documents(frame, path, ranks).collect()
        assert len(got) == 7 and sum(r.length == 1 for r in got) == 3
        assert 50256 not in packing._encoder(path, ranks)("<|endoftext|>")
    assert packing._encoder(path, None)("Привет") == packing._encoder(path, public_tokenizers.path("byte_bpe_50k.tiktoken"))("Привет")
    assert packing.packed_documents(frame.limit(0), path).count() == 0
    pieces = packing.tokenised(docs_of(spark, [(1, "a b c"), (2, "d")]), path, ids=True)
    whole = packing.sequences(packing.pack(pieces), pieces).collect()
    assert len(whole) == 1 and sorted(whole[0].ids) == sorted(i for r in pieces.collect() for i in r.ids)


def test_bound_and_packing_agree():
    rng = np.random.default_rng(1)
    for _ in range(50):
        lengths = rng.integers(1, 101, rng.integers(1, 200))
        bins, offsets = packing.best_fit_decreasing(lengths, 100)
        fill = np.bincount(bins, weights=lengths)
        assert fill.max() <= 100 and (offsets + lengths <= 100).all()
        assert packing.lower_bound(lengths, 100) <= len(fill)
    assert packing.lower_bound(np.array([60, 60, 60]), 100) == 3 and packing.lower_bound(np.array([], int), 100) == 0


# --- secrets -------------------------------------------------------------------------------------

ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"""
    r"""[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def base_secrets(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{secret_scan.BASE[k]}:{a}:{b}" for a, k, b in sorted(out))


def test_secrets_of_all_documents(spark, sf_check):
    texts = dict(rows_of(spark, sf_check))
    for r in QUERIES["op7_secret_scan"](spark, sf_check).collect():
        want = base_secrets(texts[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [want.count(k + ":") for k in secret_scan.BASE]
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))


def test_secrets_against_plain_expressions():
    rng = random.Random(1)
    parts = ["password", "PassWd", "secret", "tokEN", "api_key", "APIKEY", "api__key", "AKIA", "AKIAAKIA", "İ", "ſecret", ":", "=",
             " ", "'", '"', "abcdef", "0123456789", "tokentoken=", "\n", "é"]
    for _ in range(20_000):
        text = "".join(rng.choices(parts, k=rng.randint(1, 14)))
        got = ",".join(f"{k}:{a}:{b}" for k, a, b in secret_scan.find_secrets(text) if k in secret_scan.BASE)
        assert got == base_secrets(text), text


def test_checksums_decide():
    body = "aB3" * 10
    good = body + secret_scan.base62_crc32(body)
    assert secret_scan.find_secrets(f"x ghp_{good} ghp_{body}000000 npm_{good}") == [("ghtoken", 2, 42), ("npmtoken", 84, 124)]
    jwt = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxIn0.c2ln"
    assert secret_scan.find_secrets(jwt) == [("jwt", 0, len(jwt))] and not secret_scan.find_secrets("eyJhbGci.e30.x")
    assert secret_scan.find_secrets(None) == secret_scan.find_secrets("") == []


# --- benchmark passages --------------------------------------------------------------------------

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def contamination(docs, items, width=10):
    windows = {}
    for item, text in items:
        words = WORD.findall((text or "").encode().lower().decode())
        m = min(width, len(words))
        for i in range(len(words) - m + 1 if m else 0):
            windows.setdefault(tuple(words[i : i + m]), set()).update([] if item is None else [str(item)])
    out = collections.Counter()
    for doc, text in docs:
        words = WORD.findall((text or "").encode().lower().decode())
        hit, found = [False] * len(words), set()
        for m in {len(w) for w in windows}:
            for i in range(len(words) - m + 1):
                if tuple(words[i : i + m]) in windows:
                    hit[i : i + m] = [True] * m
                    found |= windows[tuple(words[i : i + m])]
        out[doc, len(words), sum(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), any(hit)] += 1
    return out


def test_contamination_of_all_documents(spark, sf_check):
    want = contamination(rows_of(spark, sf_check), rows_of(spark, sf_check, "benchmark", ("item_id", "text")))
    got = QUERIES["op8_decontamination"](spark, sf_check).collect()
    assert collections.Counter(tuple(r) for r in got) == want and any(r.contaminated for r in got)


def test_contamination_of_edges_in_blocks(spark):
    items = [(1, "one two THREE four five six seven eight nine ten eleven"), (2, "x"), (2, "x"), (3, None), (4, "--"), (None, "é à"),
             (5, "seven eight nine"), (10, "one two three four five six seven eight nine ten")]
    docs = EDGES + [(20, "One, two; three-four five six seven eight nine ten?"), (21, "one two three four five six seven eight nine")]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("spans", F.lit(1))
    for size in (4_000_000, 8):
        got = find_contamination(docs_of(spark, docs), benchmark, 10, size).collect()
        assert collections.Counter(tuple(r) for r in got) == contamination(docs, items)
    clean = without_contaminated(docs_of(spark, docs), benchmark, 10, 8)
    want = collections.Counter(r[0] for r in contamination(docs, items).elements() if not r[5])
    assert collections.Counter(r.doc_id for r in clean.collect()) == want and len(clean.columns) == 9
    assert find_contamination(docs_of(spark, docs), benchmark.limit(0)).where("contaminated").count() == 0
    assert find_contamination(docs_of(spark, docs).limit(0), benchmark).count() == 0


# --- fingerprints --------------------------------------------------------------------------------


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    k = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    least = collections.defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        least[root(i)].append(doc)
    smallest = {r: min((d for d in ids if d is not None), default=None) for r, ids in least.items()}
    return collections.Counter((d, f"{p:016x}", smallest[root(i)]) for i, ((d, _), p) in enumerate(zip(rows, prints)))


def test_near_duplicates_of_all_documents(spark, sf_small):
    got = QUERIES["op9_simhash_near_duplicates"](spark, sf_small).collect()
    assert collections.Counter(tuple(r) for r in got) == linked(rows_of(spark, sf_small))


def test_near_duplicates_of_edges(spark):
    got = simhash.near_duplicates(docs_of(spark, EDGES)).collect()
    assert collections.Counter(tuple(r) for r in got) == linked(EDGES)
    assert simhash.near_duplicates(docs_of(spark, EDGES).limit(0)).count() == 0


def test_pairs_within_three_bits(spark):
    rng = np.random.default_rng(1)
    points = set()
    for x in rng.integers(0, 2**63, 40, dtype=np.uint64):
        for _ in range(8):
            y = int(x)
            for b in rng.choice(64, rng.integers(0, 5), replace=False):
                y ^= 1 << int(b)
            points.add(y)
    signed = np.array(sorted(points), np.uint64).view(np.int64).tolist()
    got = {(r.u, r.v) for r in simhash.near_pairs(spark.createDataFrame([(p,) for p in signed], "bits long")).collect()}
    assert got == {(min(a, b), max(a, b)) for a in signed for b in signed if a != b and ((a ^ b) & (2**64 - 1)).bit_count() <= 3}


# --- quality -------------------------------------------------------------------------------------


def base_counts(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    again = [False] * len(words)
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            again[i : i + 8] = [True] * 8
    lines, seen = 0, set()
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            lines += line in seen
            seen.add(line)
    n = len(words)
    failed = n < 20 or 100 * sum(again) > 30 * n
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), lines, sum(again), failed


def grams(text):
    words = [w.encode() for w in re.findall("[^\x20\x09-\x0d]+", text or "")]
    h = lambda w, seed=42: xxhash.xxh64_intdigest(w, seed)
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    one = [h(w) for w in words]
    return [signed(x) % quality.BUCKETS for x in one] + [signed(h(w, x)) % quality.BUCKETS for x, w in zip(one, words[1:])]


def test_quality_of_all_documents(spark, sf_check):
    rows = rows_of(spark, sf_check)
    good = {d for d, q, t in rows_of(spark, sf_check, "labels", ("doc_id", "quality", "toxic")) if q == 1 and not t}
    raw, trusted = np.zeros(quality.BUCKETS), np.zeros(quality.BUCKETS)
    of = {d: grams(t) for d, t in rows}
    for d, g in of.items():
        np.add.at(raw, g, 1)
        if d in good:
            np.add.at(trusted, g, 1)
    exact = np.log((trusted + quality.PRIOR) / (raw * trusted.sum() / raw.sum() + quality.PRIOR)) * quality.SCALE
    ratio = np.where(exact >= 0, np.floor(exact + 0.5), np.ceil(exact - 0.5))
    texts = dict(rows)
    for r in QUERIES["op10_quality_rules"](spark, sf_check).collect():
        want = base_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want
        score = ratio[of[r.doc_id]].mean() if of[r.doc_id] else 0
        assert abs(r.score - score) < 1e-6 and r.kept == (not want[5] and score >= quality.THRESHOLD * quality.SCALE)


def test_quality_of_edges(spark):
    rows = EDGES + [(30, "a b c d e f g h i " * 5), (31, "x y\n\n x y\nx y\r\nx y" + " z" * 30), (32, "one two # $ < >\x0b" * 20)]
    labels = spark.createDataFrame([(8, 1, None), (None, 1, 0), (8, 1, 0), (30, 0, 0)], "doc_id long, quality int, toxic int").withColumn("good", F.lit(2))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for known in (labels, labels.limit(0)):
        got = quality.judge_quality(frame, known).collect()
        assert len(got) == len(rows)
        for r in got:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base_counts(r.text)
    assert quality.judge_quality(frame.limit(0), labels).count() == 0
    assert quality.judge_quality(frame, labels).where("kept or not kept").count() == len(rows)


def test_quality_counts_grams_in_compiled_code(spark):
    text = "\x20a\x0bb\u00a0c\r\nd \u2003 e\x85f\x1c \t\x00 g\f"
    frame = spark.createDataFrame([(1, text), (2, "\n "), (3, ""), (4, None)], "doc_id long, text string")
    for r in frame.select("text", quality.words_of(F.col("text")).alias("words")).collect():
        assert r.words == re.findall("[^\x20\x09-\x0d]+", r.text or "")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    plan = quality.fit_ratios(frame, labels)._jdf.queryExecution().optimizedPlan().toString()
    made = [line for line in plan.splitlines() if "Generate explode" in line]
    assert made and not [line for line in made if "lambdafunction" in line]
    assert "regexp_extract_all" not in plan


# --- personal data -------------------------------------------------------------------------------


def test_surrogates_keep_type_and_format(spark):
    rows = [
        (1, "Mail bo.42@mail8.example.com or BO.42@mail8.EXAMPLE.com; +1 (988) 555-2485 and +1-988-555-2485."),
        (2, "card 4041894974608795, 4041-8949-7460-8795; no card 4041894974608796, ip 70.123.182.155. v2.0.1 1.2.3.4.5 999.1.1.1"),
        (3, "Dear Mr. John Smith, Mrs Smith and Frau Müller met Señora García. Dr Петров (SSN 123-45-6789)."),
        (None, None), (4, ""), (5, "clean text 12 3.4 idiot"), (1, "Mail bo.42@mail8.example.com"), (6, "x@y.zz " * 3000), (None, "ip 10.0.0.1"),
    ]
    frame = docs_of(spark, rows).withColumn("n_replaced", F.lit("x"))
    got = pii.replace_personal_data(frame, "k").collect()
    assert len(got) == len(rows) and sum(not r.text for r in got) == 2
    texts = collections.defaultdict(list)
    for r in got:
        texts[r.doc_id].append(r.text)
    assert texts[5] == ["clean text 12 3.4 idiot"]
    shape = lambda s: re.sub("[a-z]", "a", re.sub(r"\d", "9", s.lower()))
    long = max(texts[1], key=len)
    assert shape(long) == shape(rows[0][1])
    mails = re.findall(r"\S+@[\w.]+\w", long)
    assert mails[0] == mails[1] != "bo.42@mail8.example.com" and min(texts[1], key=len) == "Mail " + mails[0]
    phones = re.findall(r"\+1[\d ()-]+\d", long)
    assert re.sub(r"\D", "", phones[0]) == re.sub(r"\D", "", phones[1]) != "19885552485"
    cards = re.findall(r"\d{4}-?\d{4}-?\d{4}-?\d{4}", texts[2][0])
    assert cards[0] == cards[1].replace("-", "") != "4041894974608795" and cards[2] == "4041894974608796" and cards[0][0] == "4"
    assert texts[2][0].endswith(". v2.0.1 1.2.3.4.5 999.1.1.1") and "70.123.182.155" not in texts[2][0]
    name = re.search(r"Mr\. (\w+o) (\w+), Mrs (\w+) and", texts[3][0])
    assert name[2] == name[3] != "Smith" and re.search(r"Dr [А-я]+ \(SSN \d{3}-\d{2}-\d{4}\)", texts[3][0]) and "Петров" not in texts[3][0]
    again = pii.replace_personal_data(frame, "k").collect()
    assert collections.Counter(map(tuple, again)) == collections.Counter(map(tuple, got))
    assert collections.Counter(map(tuple, pii.replace_personal_data(frame, "other").collect())) != collections.Counter(map(tuple, got))
    assert pii.replace_personal_data(frame.limit(0), "k").count() == 0


def test_phones_of_all_country_codes(spark):
    codes = {"+33 1 42 68 53 00": 2, "+34 612 345 678": 2, "+49 30 123 456": 2, "+351 912 345 678": 3, "+7 901 234-56-78": 1, "+1 988 555 24 85": None}
    got = {r.doc_id: r for r in pii.replace_personal_data(docs_of(spark, [(i, f"call {x} now") for i, x in enumerate(codes)]), "k").collect()}
    for i, (phone, kept) in enumerate(codes.items()):
        if kept is None:
            assert (got[i].text, got[i].n_replaced) == (f"call {phone} now", 0)
            continue
        assert got[i].n_replaced == 1 and phone not in got[i].text and got[i].text.startswith("call " + phone[: kept + 1])
        assert re.sub(r"\d", "9", got[i].text) == re.sub(r"\d", "9", f"call {phone} now")


def test_each_kind_of_entity_has_a_hint(spark):
    samples = {
        pii.EMAIL: ["a@b.cd"], pii.PHONE: ["+33 1 42 68 53 00", "+7 90 12 34", "+1 (988) 555-2485"], pii.CARD: ["4041894974608795", "4041 8949 7460 8"],
        pii.SSN: ["123-45-6789"], pii.IP: ["1.2.3.4"], pii.PERSON: [f"{t} Abc" for t in f"{pii.FEMALE}|{pii.MALE}|{pii.NEUTRAL}".split("|")],
    }
    assert "|".join(samples) == pii.ENTITY
    for kind, texts in samples.items():
        frame = spark.createDataFrame([(t,) for t in texts], "t string")
        assert frame.where(F.col("t").rlike(f"^(?:{kind})$") & F.col("t").rlike(pii.HINT)).count() == len(texts)


def test_later_mentions_of_a_name_get_its_surrogate(spark):
    rows = [
        (1, "Dr. Maria Lopez spoke. Maria Lopez left, Lopez said; LOPEZ, Lopezia and lopez."), (2, "Lopez said"),
        (3, "Mr. J. Smith, Mr\tSmith and Mr.  Smith; J. Smith"), (4, "Dr. Maria Lopez and Mrs. Maria Lopez"),
    ]
    got = {r.doc_id: r for r in pii.replace_personal_data(docs_of(spark, rows), "k").collect()}
    found = re.fullmatch(r"Dr\. (\w+) (\w+) spoke\. (\w+) (\w+) left, (\w+) said; (\w+), Lopezia and lopez\.", got[1].text)
    assert found[1] == found[3] != "Maria" and found[2] == found[4] == found[5] == found[6].capitalize() != "Lopez" and found[6].isupper()
    assert got[1].n_replaced == 6 and got[2].text == "Lopez said"
    found = re.fullmatch(r"Mr\. (\w)\. (\w+), Mr\t(\w+) and Mr\.  (\w+); (\w)\. (\w+)", got[3].text)
    assert found[2] == found[3] == found[4] == found[6] != "Smith" and found[1] == found[5]
    found = re.fullmatch(r"Dr\. (\w+a) (\w+) and Mrs\. (\w+) (\w+)", got[4].text)
    assert found[1] == found[3] != "Maria" and found[2] == found[4]


def test_surrogates_stay_distinct_when_they_run_out(spark):
    """All addresses of a small range: candidates clash with each other and with entities."""
    entities = spark.createDataFrame([("ip", f"{a}.{b}.1.1") for a in range(10) for b in range(10)], "kind string, norm string")
    got = pii.draw_surrogates(entities, "k").collect()
    assert len(got) == 100 == len({r.surrogate for r in got}) and not {r.norm for r in got} & {r.surrogate for r in got}


def test_surrogates_of_all_documents(spark, sf_check):
    find = re.compile(r"[\w.]+@[\w.]+\w|\+1 \(\d{3}\) \d{3}-\d{4}|(?<![\w.])\d+\.\d+\.\d+\.\d+(?!\w|\.\d)")
    before = dict(rows_of(spark, sf_check))
    after = {r.doc_id: r.text for r in QUERIES["op5_pii_surrogates"](spark, sf_check).collect()}
    assert set(after) == set(before)
    given = {}
    for doc, text in before.items():
        for x, y in zip(find.findall(text), find.findall(after[doc]), strict=True):
            assert given.setdefault(x, y) == y
    assert len(set(given.values())) == len(given) and not set(given) & set(given.values())
