"""Secret scans with structural confirmation.

Base kinds (``assign``, ``access``, ``hex``) are patterns. Beyond them, runs that could be encoded
keys are decoded from base64 or hex and reported only if their structure holds: DER keys, plain or
encrypted, whose nested lengths add up, key files sealed by header lines that name the cipher and hold
whole cipher blocks, OpenSSH key files whose length-prefixed fields do, and signed tokens whose
header and claims are JSON objects and whose header names an algorithm.

A row is handled on its own, so nothing is shuffled and no key can be hot. Null text counts as
empty and has no spans; very long texts are scanned whole; repeated rows give the same result. An
empty table gives no rows.
Spans count code points, with exclusive ends. Other columns pass through untouched (columns named
like an output are replaced).
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: the kinds in their order, and the patterns of the base ones
KINDS = ("assign", "access", "hex", "signed_token", "pem_key", "der_key", "ssh_key")
N_BASE = 3
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_WORDS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

# line ends may be written out as \n or \r, as in quoted strings
PEM = re.compile(
    r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----((?:(?:\s|\\[nr])+(?:Proc-Type|DEK-Info):[^\r\n\\]*)*)((?:[A-Za-z0-9+/=\s]|\\[nr])+)-----END \1-----")
CIPHER = re.compile(r"DEK-Info:\x20*[A-Z0-9]+(?:-[A-Z0-9]+)*,(?:[0-9A-Fa-f]{2}){8,}\s*(?:\\[nr])?")
#: The first two letters are those of an opening brace.
TOKEN = re.compile(r"(?<![\w.-])e[w-z0-9_-][\w-]+\.[\w-]+\.[\w-]*(?![\w-])", re.A)
ENCODED = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{40,}={0,2}")
LONG_HEX = re.compile(r"(?<![0-9A-Za-z])(?:[0-9a-fA-F]{2}){32,}(?![0-9A-Za-z])")

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """Spans of the three base kinds; each kind's matches are leftmost and do not overlap."""
    found: list[Span] = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


# ---- structure

def _decode(run: str) -> bytes | None:
    run = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(run) % 4 == 1:
        return None
    try:
        return base64.b64decode(run + "=" * (-len(run) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, first, last) of the DER element at ``at``, if its length fits before ``end``."""
    if at + 2 > end:
        return None
    tag, n, at = data[at], data[at + 1], at + 2
    if n & 0x80:
        k = n & 0x7F
        if not 1 <= k <= 4 or at + k > end:
            return None
        n, at = int.from_bytes(data[at : at + k], "big"), at + k
        if n < 0x80:
            return None
    return (tag, at, at + n) if at + n <= end else None


def _elements(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """All elements between ``at`` and ``end``; None unless they fill it exactly."""
    out = []
    while at < end:
        if (e := _element(data, at, end)) is None:
            return None
        out.append(e)
        at = e[2]
    return out


_INTEGER, _OCTETS, _OBJECT, _SEQUENCE = 0x02, 0x04, 0x06, 0x30


def is_der_key(data: bytes) -> bool:
    """A private key in one of the usual encodings, all nested lengths adding up."""
    outer = _element(data, 0, len(data))
    if outer is None or outer[0] != _SEQUENCE or outer[2] != len(data):
        return False
    parts = _elements(data, outer[1], outer[2])
    if parts and [t for t, _, _ in parts] == [_SEQUENCE, _OCTETS]:  # encrypted: a scheme with its parameters, then the wrapped key
        scheme = _elements(data, parts[0][1], parts[0][2])
        return scheme is not None and [t for t, _, _ in scheme] == [_OBJECT, _SEQUENCE] and parts[1][2] - parts[1][1] >= 32
    if not parts or parts[0][0] != _INTEGER or parts[0][2] - parts[0][1] != 1:
        return False
    tags = [t for t, _, _ in parts]
    if len(parts) >= 9 and tags[:9] == [_INTEGER] * 9:
        return True  # nine integers: modulus, exponents, primes
    if len(parts) >= 3 and tags[1:3] == [_SEQUENCE, _OCTETS]:
        inner = _elements(data, parts[1][1], parts[1][2])
        return bool(inner) and inner[0][0] == _OBJECT  # algorithm, then the wrapped key
    if len(parts) >= 2 and tags[1] == _OCTETS:
        return parts[1][2] - parts[1][1] in (28, 32, 48, 66)  # a curve's scalar
    return len(parts) >= 5 and tags[:5] == [_INTEGER] * 5 and len(parts) <= 6  # parameters and two keys


_SSH = b"openssh-key-v1\0"  # fixed value: the format's magic


def is_ssh_key(data: bytes) -> bool:
    """Cipher, derivation, options, key count, public key and private block, by their lengths."""
    if not data.startswith(_SSH):
        return False
    at = len(_SSH)
    for field in range(6):
        if at + 4 > len(data):
            return False
        n, at = int.from_bytes(data[at : at + 4], "big"), at + 4
        if field == 3:
            if not 1 <= n <= 64:
                return False
        else:
            at += n
    return at <= len(data)


def is_signed_token(run: str) -> bool:
    """Header and claims are JSON objects; the header names an algorithm."""
    parts = run.split(".")
    if len(parts) != 3:
        return False
    try:
        head, claims = (json.loads(_decode(p) or b"") for p in parts[:2])
    except (ValueError, RecursionError):
        return False
    if not (isinstance(head, dict) and isinstance(claims, dict) and isinstance(head.get("alg"), str)):
        return False
    return parts[2] == "" if head["alg"].lower() == "none" else len(_decode(parts[2]) or b"") >= 32


def _key_kind(data: bytes | None) -> str | None:
    if data and data[0] == _SEQUENCE and is_der_key(data):
        return "der_key"
    return "ssh_key" if data and is_ssh_key(data) else None


def structural_spans(text: str) -> list[Span]:
    """Spans of candidates whose structure is confirmed."""
    found: list[Span] = []
    if "-----BEGIN" in text:
        for m in PEM.finditer(text):
            body = _decode("".join(re.sub(r"\\[nr]", " ", m[3]).split()))
            sealed = body and "ENCRYPTED" in m[2] and CIPHER.search(m[2]) and len(body) >= 32 and len(body) % 8 == 0  # whole cipher blocks
            if sealed or _key_kind(body):
                found.append((m.start(), m.end(), "pem_key"))
    covered = [(a, b) for a, b, _ in found]
    found += [(m.start(), m.end(), "signed_token") for m in TOKEN.finditer(text) if is_signed_token(m[0])]
    for m in ENCODED.finditer(text):
        if not any(a <= m.start() < b for a, b in covered) and (kind := _key_kind(_decode(m[0]))):
            found.append((m.start(), m.end(), kind))
    for m in LONG_HEX.finditer(text):
        if kind := _key_kind(bytes.fromhex(m[0])):
            found.append((m.start(), m.end(), kind))
    return found


_RANK = {kind: i for i, kind in enumerate(KINDS)}


def spans(text: str | None) -> list[Span]:
    """All spans, by start, then kind."""
    text = text or ""
    return sorted(base_spans(text) + structural_spans(text), key=lambda s: (s[0], _RANK[s[2]], s[1]))


def redact(text: str | None) -> str | None:
    """``text`` with every span (overlapping ones together) replaced by a mark.

    The mark names the kind of the longest span; of equally long ones a confirmed structure's, then the first.
    """
    if not text:
        return text
    out, at, best = [], 0, None
    for start, end, kind in spans(text):
        if start >= at:
            out += [f"[{best[2]}]"] if best else []
            out.append(text[at:start])
            best = None
        weight = (end - start, _RANK[kind] >= N_BASE)
        if best is None or weight > best[:2]:
            best = (*weight, kind)
        at = max(at, end)
    return "".join([*out, f"[{best[2]}]", text[at:]]) if best else text


# ---- over tables

_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))


def scanned(docs: DataFrame, text: str = "text", out: str = "secrets") -> DataFrame:
    """Add ``out``: the text's spans as an array of ``(start, end, kind)``."""

    @F.arrow_udf("array<struct<start:int,end:int,kind:string>>")
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([[dict(zip(("start", "end", "kind"), s)) for s in spans(t.as_py())] for t in batch], _SPANS)

    return docs.withColumn(out, scan(F.col(text)))


def redacted(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """``docs`` with secrets replaced; ``length``, where there is such a column, follows the text."""

    @F.arrow_udf("string")
    def replace(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([redact(t.as_py()) for t in batch], pa.string())

    clean = docs.withColumn(text, replace(F.col(text)))
    if length not in docs.columns:
        return clean
    return clean.withColumn(length, F.length(text).cast(docs.schema[length].dataType)).select(docs.columns)
