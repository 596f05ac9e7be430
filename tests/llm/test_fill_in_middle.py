"""Fill-in-middle against plain Python over code points."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from logspark.llm.fill_in_middle import CharIndex, fill_in_middle, restored_text, token_starts
from logspark.llm.queries import QUERIES, SQL
from compare import assert_same


def plain(doc_id, text):
    text = text or ""
    tokens = re.findall("[A-Za-z]+|[^A-Za-z]", text, re.S)
    n = len(tokens)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    before, middle, after = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    spm = h4 % 100 < 20
    out = f"<S>{after}<P>{before}<M>{middle}" if spm else f"<P>{before}<S>{after}<M>{middle}"
    return doc_id, n, "spm" if spm else "psm", len(before), len(middle), out


def rows_of(spark, rows, ddl="doc_id long, text string"):
    made = fill_in_middle(spark.createDataFrame(rows, ddl))
    return made.select("*", restored_text().alias("restored")).collect()


TEXTS = [
    None, "", "a", "é", "<", "<P", "x<P>y", "<S><M>", "word word", "日本語 text 𝄞 and ünï", "  \n\t ", "a<b<c<d" * 20,
    "ab1cd" * 300, "éa" * 500, "𝄞" * 700, "P>S>M><P <S <M ",
]


def test_edge_texts_equal_plain_python(spark):
    rows = [(i * 31 + j, t) for j in range(60) for i, t in enumerate(TEXTS)] + [(None, "some text here"), (-5, "a b c")]
    got = rows_of(spark, rows + rows[:7])
    want = sorted(map(repr, (plain(*r) for r in rows + rows[:7])))
    assert sorted(repr(tuple(r)[:6]) for r in got) == want
    texts = sorted((r[1] or "") for r in rows + rows[:7])
    assert sorted(r.restored for r in got) == texts
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_very_long_text_empty_table_and_clashing_columns(spark):
    long = "Wörter und words 12, " * 200_000
    rows = [(i, long, i, "x") for i in range(3)]
    got = rows_of(spark, rows, "doc_id long, text string, n long, output string")
    assert sorted(tuple(r)[:6] for r in got) == sorted(plain(i, long) for i in range(3))
    assert all(r.restored == long for r in got)
    assert rows_of(spark, []) == []


def test_whole_documents_against_sql(spark, sf_check):
    assert_same(QUERIES["op13_fill_in_middle"](spark, sf_check), sf_check, SQL["op13_fill_in_middle"])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=5))
def test_index_and_tokens(texts):
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    places = np.cumsum([0, *map(len, raw)])
    index = CharIndex(data)
    joined = "".join(texts)
    chars = np.arange(len(joined) + 1)
    sizes = np.array([0, *(len(c.encode("utf-8", "surrogatepass")) for c in joined)]).cumsum()
    assert index.bytes(chars).tolist() == sizes.tolist()
    assert index.chars(sizes).tolist() == chars.tolist()
    want, base = [], 0
    for t in texts:
        want += [base + m.start() for m in re.finditer("[A-Za-z]+|[^A-Za-z]", t, re.S)]
        base += len(t)
    assert token_starts(data, places, index).tolist() == want


def test_sentinels_must_be_told_apart():
    with pytest.raises(ValueError):
        fill_in_middle(None, sentinels=("<P>", "<P>", "<M>"))
    with pytest.raises(ValueError):
        fill_in_middle(None, sentinels=("<<P>", "<S>", "<M>"))
