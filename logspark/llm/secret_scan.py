"""Secrets in documents: keyword automaton, anchored expressions at its hits, embedded checksums.

One Aho-Corasick pass over a text finds the places of all keywords; a kind's expression is tried at
those places only, anchored, from left to right, and never inside an earlier match of its kind.
Hexadecimal runs have no keyword; every place where such a run begins is their hit.

Kinds of the contract: ``assign``, ``access``, ``hex``. The method adds kinds whose tokens carry
their own check, so a hit that fails it is no secret:

* ``ghtoken`` and ``npmtoken``: a prefix and 36 base-62 characters, the last six of which are the
  CRC-32 of the thirty before;
* ``jwt``: three base64url parts, of which the first two decode to JSON objects and the first names ``alg``;
* ``pemkey``: a private key block, closed by the label that opens it, with a base64 body that decodes, after header lines if there are any.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from logspark.llm.common import only
from logspark.llm.words import text_slices

BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def base62_crc32(text: str) -> str:
    """CRC-32 of a token's random part as six base-62 digits."""
    n, out = zlib.crc32(text.encode()), ""
    for _ in range(6):
        n, digit = divmod(n, 62)
        out = BASE62[digit] + out
    return out


def _crc_holds(m: re.Match) -> bool:
    return base62_crc32(m[1][:30]) == m[1][30:]


def _decoded(part: str) -> bytes:
    return base64.urlsafe_b64decode(part + "=" * (-len(part) % 4))


def _jwt_holds(m: re.Match) -> bool:
    try:
        head, body = (json.loads(_decoded(p)) for p in m[0].split(".")[:2])
    except (ValueError, RecursionError):
        return False
    return isinstance(head, dict) and isinstance(body, dict) and "alg" in head


def _pem_holds(m: re.Match) -> bool:
    try:
        return len(base64.b64decode("".join(m[2].split()), validate=True)) >= 32
    except binascii.Error:
        return False


@dataclass(frozen=True)
class Kind:
    """``keywords`` in lower case where ``folded``; ``holds`` decides on a match."""

    name: str
    keywords: tuple[str, ...]
    pattern: re.Pattern
    holds: Callable[[re.Match], bool]
    folded: bool = False
    #: What a match begins with; where one fails, no other can begin inside the same run.
    run: re.Pattern | None = None


KINDS = (
    Kind(
        "assign", ("password", "passwd", "secret", "token", "apikey", "api_key"),
        re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
        lambda m: m.end(1) - m.start(1) >= 6, folded=True,
    ),
    Kind("access", ("AKIA",), re.compile(r"AKIA[A-Z0-9]+"), lambda m: m.end() - m.start() >= 20),
    Kind("hex", (), re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}"), lambda m: True),
    Kind("ghtoken", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), re.compile(r"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])"), _crc_holds),
    Kind("npmtoken", ("npm_",), re.compile(r"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])"), _crc_holds),
    Kind("jwt", ("eyJ",), re.compile(r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"), _jwt_holds, run=re.compile("[A-Za-z0-9_-]+")),
    Kind(
        "pemkey", ("-----BEGIN ",),
        re.compile(r"-----BEGIN ((?:[A-Z]+ )?PRIVATE KEY)-----\s(?:[A-Z][A-Za-z-]*: [^\n]*\n)*([A-Za-z0-9+/=\s]+)-----END \1-----"), _pem_holds,
    ),
)
BASE = ("assign", "access", "hex")


@lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    """Keywords of all kinds, lower-cased; each with its kinds and length."""
    by_word: dict[str, list[int]] = {}
    for k, kind in enumerate(KINDS):
        for word in kind.keywords:
            by_word.setdefault(word.lower(), []).append(k)
    automaton = ahocorasick.Automaton()
    for word, kinds in by_word.items():
        automaton.add_word(word, (len(word), tuple(kinds)))
    automaton.make_automaton()
    return automaton


def find_secrets(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind as listed; null or empty: none."""
    if not text:
        return []
    # Only A-Z are folded, so places stay the same.
    folded = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    hits: dict[int, list[int]] = {}
    for last, (length, kinds) in _automaton().iter(folded):
        for k in kinds:
            hits.setdefault(k, []).append(last - length + 1)
    found = []
    for k, kind in enumerate(KINDS):
        if not kind.keywords:
            found += [(m.start(), k, m.end()) for m in kind.pattern.finditer(text) if kind.holds(m)]
            continue
        free = 0
        for at in sorted(hits.get(k, ())):
            if at < free:
                continue
            if m := kind.pattern.match(text, at):
                free = m.end()
                if kind.holds(m):
                    found.append((at, k, free))
            elif kind.run and (m := kind.run.match(text, at)):
                free = m.end()
    return [(KINDS[k].name, a, b) for a, k, b in sorted(found)]


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        spans = [find_secrets(t.as_py()) for t in batch.column("text")]
        base = [[s for s in of if s[0] in BASE] for of in spans]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id")]
            + [pa.array([sum(s[0] == kind for s in of) for of in base], pa.int64()) for kind in BASE]
            + [pa.array([hashlib.sha256(_joined(of).encode()).hexdigest() for of in base], pa.string()),
               pa.array([_joined(of) for of in spans], pa.string())],
            names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
        )


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Per document the spans of its secrets as ``kind:start:end``, and counts and a digest of the contract's kinds.

    No row meets another one: there is no shuffle, and repeated rows are scanned each. A null or
    empty text has no spans. Extra columns are dropped.
    """
    return only(docs, doc_id="long", text="string").mapInArrow(
        _scan, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )
