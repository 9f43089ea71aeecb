"""Secret scanning: an Aho-Corasick keyword prefilter, regular expressions anchored at its hits, embedded checksums.

Null and empty texts have no spans. A text is scanned whole, whatever its length. Repeated rows give repeated
results, and columns besides id and text play no part in scan_rows(); scan() keeps them unless they clash with the
result column, which it replaces.
"""

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
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteweave.llm.common import pieces, schema_with, table

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "github", "npm", "jwt", "pem", "google", "stripe", "slack")
SPAN = "array<struct<kind:string,start:int,end:int>>"

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_HEX_PROBE = re.compile(r"[0-9a-f]{2,}")
_HEXDIGITS = frozenset("0123456789abcdef")
#: A run of 24 hex digits covers two probes in a row at this stride.
_STRIDE = 12
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def _crc62(value: str) -> str:
    n, out = zlib.crc32(value.encode()), ""
    while n:
        n, d = divmod(n, 62)
        out = _BASE62[d] + out
    return out.rjust(6, "0")


def _checked(match: re.Match) -> bool:
    """The last six characters are the base-62 CRC-32 of the thirty before them."""
    return _crc62(match[1][:-6]) == match[1][-6:]


def _jwt(match: re.Match) -> bool:
    """The first part is base64url JSON that names an algorithm."""
    try:
        return "alg" in json.loads(base64.urlsafe_b64decode(match[1] + "=" * (-len(match[1]) % 4)))
    except (ValueError, TypeError, binascii.Error):
        return False


def _always(match: re.Match) -> bool:
    return True


#: kind -> keywords (lower case), pattern anchored at a keyword, test of a match. A failing match is dropped after it has taken its characters.
RULES = {
    "assign": (("password", "passwd", "secret", "token", "apikey", "api_key"), _ASSIGN, lambda m: len(m[2]) >= 6),
    "access": (("akia",), _ACCESS, lambda m: m.end() - m.start() >= 20),
    "github": (("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), re.compile(r"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])"), _checked),
    "npm": (("npm_",), re.compile(r"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])"), _checked),
    "jwt": (("eyj",), re.compile(r"(eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"), _jwt),
    "pem": (("-----begin",), re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]*PRIVATE KEY-----"), _always),
    "google": (("aiza",), re.compile(r"AIza[A-Za-z0-9_-]{35}(?![A-Za-z0-9_-])"), _always),
    "stripe": (("sk_live_", "rk_live_"), re.compile(r"[sr]k_live_[A-Za-z0-9]{20,}"), _always),
    "slack": (("xoxb-", "xoxp-", "xoxa-", "xoxs-"), re.compile(r"xox[bpas]-[A-Za-z0-9-]{10,}"), _always),
}


#: Kinds whose failed match tells that no later start in this run matches: what must follow the run isn't there.
_RUNS = {"jwt": re.compile(r"[A-Za-z0-9_-]*")}


def automaton() -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for kind, (words, _, _) in RULES.items():
        for word in words:
            out.add_word(word, (kind, len(word)))
    out.make_automaton()
    return out


def _lowered(text: str) -> str:
    """Lower case with every character at its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if c.isascii() else c for c in text)


def _hex_runs(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for probe in _HEX_PROBE.finditer(text[_STRIDE - 1 :: _STRIDE]):
        at = _STRIDE - 1 + _STRIDE * probe.start()
        while at < _STRIDE * (probe.end() + 1) and at < len(text):
            if at >= done and text[at] in _HEXDIGITS:
                start = at
                while start > done and text[start - 1] in _HEXDIGITS:
                    start -= 1
                done = _HEX.match(text, start).end()
                if done - start >= 24:
                    yield start, done
            at += _STRIDE


def find(text: str, auto: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """All spans of a text as (kind, start, end) in code points, by start, then by the order of KINDS."""
    ends: dict[str, int] = {}
    failed: dict[str, int] = {}  # up to here no match of the kind begins: the run that it needs has been read in vain
    out = []
    hits = sorted((end + 1 - size, kind) for end, (kind, size) in auto.iter(_lowered(text)))
    for start, kind in hits:
        if start >= ends.get(kind, 0) and start >= failed.get(kind, 0):
            _, pattern, good = RULES[kind]
            if m := pattern.match(text, start):
                ends[kind] = m.end()
                if good(m):
                    out.append((kind, start, m.end()))
            elif kind in _RUNS:
                failed[kind] = _RUNS[kind].match(text, start).end()
    out.extend(("hex", s, e) for s, e in _hex_runs(text))
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def scan(df: DataFrame, text: str = "text", into: str = "secrets") -> DataFrame:
    """df with a column of the spans found in its text column."""
    keep = [c for c in df.columns if c != into]
    schema = schema_with(df.select(*keep), **{into: SPAN})
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = automaton()
        for batch in pieces(batches, text, 8 << 20):
            spans = [[{"kind": k, "start": s, "end": e} for k, s, e in find(t or "", auto)] for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spans, kind)], names=[*keep, into])

    return df.select(*keep).mapInArrow(run, schema)


def join_spans(spans: str, kinds: tuple[str, ...] | None = None):
    """kind:start:end, comma-joined; only the kinds named, if any are."""
    col = F.col(spans) if kinds is None else F.filter(spans, lambda x: x["kind"].isin(*kinds))
    return F.array_join(F.transform(col, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs).drop("text")
    n = lambda kind: F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *(n(k) for k in BASE), F.sha2(join_spans("secrets", BASE).cast("binary"), 256).alias("base_sha256"), join_spans("secrets").alias("spans"))


def brute_force(text: str) -> tuple[list[tuple[str, int, int]], str]:
    """The base spans by plain regular expressions over the whole text, for tests."""
    text = text or ""
    out = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text) if len(m[0]) >= 24]
    out.sort(key=lambda x: (x[1], BASE.index(x[0])))
    return out, hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in out).encode()).hexdigest()
