"""Secret scans: Aho-Corasick finds keywords, regular expressions are tried at hits only,
and checksums inside the found values are verified."""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import only

#: Kinds in the order that ties of a start follow. The first three are the base kinds.
KINDS = ("assign", "access", "hex", "github", "npm", "pypi", "jwt", "pem")

#: Patterns of public token formats (fixed values). Each is matched at a hit of one of
#: its keywords, which is where it must begin.
ANCHORED = {
    "assign": (("password", "passwd", "secret", "token", "apikey", "api_key"), re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")),
    "access": (("akia",), re.compile(r"AKIA[A-Z0-9]+")),
    "github": (("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), re.compile(r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])")),
    "npm": (("npm_",), re.compile(r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])")),
    "pypi": (("pypi-",), re.compile(r"pypi-[A-Za-z0-9_-]{50,}")),
    "jwt": (("eyj",), re.compile(r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")),
    "pem": (("-----begin ",), re.compile(r"-----BEGIN ([A-Z ]*PRIVATE KEY)-----([A-Za-z0-9+/=\s]+)-----END \1-----")),
}
#: No keyword stands in a run of hexadecimal digits; runs are found directly.
HEX = re.compile(r"[0-9a-f]{32,}")
BASE62 = {c: i for i, c in enumerate("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")}


def _unpadded(text: str) -> bytes:
    return base64.b64decode(text.replace("-", "+").replace("_", "/") + "=" * (-len(text) % 4), validate=True)


def _crc62(value: str) -> bool:
    """The last six characters are the CRC-32 of the random part in base 62."""
    number = 0
    for c in value[-6:]:
        number = number * 62 + BASE62[c]
    return number == zlib.crc32(value[4:-6].encode())


def _jwt(m: re.Match) -> bool:
    try:
        head = json.loads(_unpadded(m[0].split(".")[0]))
    except (ValueError, binascii.Error):
        return False
    return isinstance(head, dict) and "alg" in head


def _pypi(m: re.Match) -> bool:
    """A version 2 macaroon: its first packets name the site."""
    try:
        body = m[0][5:]
        raw = _unpadded(body[: len(body) // 4 * 4])
    except (ValueError, binascii.Error):
        return False
    return raw[:1] == b"\x02" and b"pypi.org" in raw[:16]


def _pem(m: re.Match) -> bool:
    """The length in the DER header is the length of the body."""
    try:
        raw = base64.b64decode("".join(m[2].split()), validate=True)
    except (ValueError, binascii.Error):
        return False
    if len(raw) < 4 or raw[0] != 0x30:
        return False
    if raw[1] < 0x80:
        return len(raw) == raw[1] + 2
    n = raw[1] & 0x7F
    return 0 < n < 5 and len(raw) == int.from_bytes(raw[2 : 2 + n]) + 2 + n


VALID = {
    "assign": lambda m: len(m[1]) >= 8,
    "access": lambda m: len(m[0]) >= 16,
    "github": lambda m: _crc62(m[0]),
    "npm": lambda m: _crc62(m[0]),
    "pypi": _pypi,
    "jwt": _jwt,
    "pem": _pem,
}


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, (words, _) in ANCHORED.items():
        for word in words:
            found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


AUTOMATON = _automaton()


def spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind's place in KINDS, end) of every secret of a text, in order.

    Matches of a kind are the leftmost that don't overlap, as ``finditer`` gives them:
    each can only begin at a hit, so trying the hits in order finds the same ones. A
    match that fails its test still covers its characters.
    """
    if not text:
        return []
    out = [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    # A-Z only, so that places don't move
    low = text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    hits = sorted((end + 1 - n, kind) for end, (kind, n) in AUTOMATON.iter(low))
    past: dict[str, int] = {}
    for at, kind in hits:
        if at >= past.get(kind, 0) and (m := ANCHORED[kind][1].match(text, at)):
            past[kind] = m.end()
            if VALID[kind](m):
                out.append((at, KINDS.index(kind), m.end()))
    return sorted(out)


SCHEMA = "doc_id bigint, start bigint, end bigint, kind string"


def _joined(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [spans(t) for t in batch.column(1).to_pylist()]
        base = [[x for x in row if x[1] < 3] for row in rows]
        count = lambda k: pa.array([sum(x[1] == k for x in row) for row in base], pa.int64())
        digest = [hashlib.sha256(_joined(row).encode()).hexdigest() for row in base]
        yield pa.RecordBatch.from_arrays([batch.column(0), count(0), count(1), count(2), pa.array(digest, pa.string()), pa.array(map(_joined, rows), pa.string())], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(i, a, b, KINDS[k]) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for a, k, b in spans(t)]
        ids, starts, ends, kinds = zip(*rows, strict=True) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64()), pa.array(kinds, pa.string())], ["doc_id", "start", "end", "kind"])


def secret_spans(docs: DataFrame) -> DataFrame:
    """One row per secret: doc_id, start, end (code points, end exclusive), kind.

    Null and empty texts have none; repeated rows give repeated spans; an empty table
    gives an empty table; other columns are ignored. One narrow pass, no shuffle.
    """
    return only(docs, doc_id="bigint", text="string").mapInArrow(_spans, SCHEMA)


def secret_summary(docs: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, the digest of base spans, all spans."""
    return only(docs, doc_id="bigint", text="string").mapInArrow(_summaries, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")
