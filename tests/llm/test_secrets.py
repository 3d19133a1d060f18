import base64
import hashlib
import json
import re

from pyspark.sql import functions as F

from dialogprep.llm import secrets
from tests.llm.cases import documents, empty, texts


def base(text):
    """The three base kinds, as plainly as they are stated."""
    out = []
    for kind, pattern, group, least in (
        ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
        ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20), ("hex", re.compile("[0-9a-f]+"), 0, 24),
    ):
        out += [(m.start(), m.end(), kind) for m in pattern.finditer(text) if len(m[group]) >= least]
    return out


def der(*parts, tag=0x30):
    body = b"".join(parts)
    n = bytes([len(body)]) if len(body) < 128 else bytes([0x82]) + len(body).to_bytes(2, "big")
    return bytes([tag]) + n + body


def integer(n, value=1):
    return der(value.to_bytes(n, "big"), tag=2)


RSA = der(integer(1, 0), *[integer(40, 2**200 + k) for k in range(8)])
WRAPPED = der(integer(1, 0), der(der(b"\x2a\x86\x48", tag=6)), der(RSA, tag=4))
CURVE = der(integer(1, 1), der(b"\x07" * 32, tag=4))


def token(head, claims, signature=b"s" * 32):
    cut = lambda b: base64.urlsafe_b64encode(b).decode().rstrip("=")
    return ".".join([cut(json.dumps(head).encode()), cut(json.dumps(claims).encode()), cut(signature)])


def test_base_spans_equal_plain_patterns():
    cases = [t or "" for _, t, *_ in texts()] + [
        "secret: token: abcdefgh", "TOKEN='abc.def-1' password=12345 passwd = \"1234567\"", "api_key:xyzxyz APIKEY=abcdef", "ſecret=abcdef toKen=abcdef toKen=abcdef",
        "AKIA" + "A" * 16 + " AKIA" + "A" * 15 + " xAKIAAKIA" + "9" * 20, "é" * 5 + "0123456789abcdef01234567", "a" * 23 + "g" + "a" * 24, "token=token=abc", "İtoken=abcdefg",
    ]
    for text in cases:
        assert sorted(secrets.base_spans(text)) == sorted(base(text)), text


def test_structures():
    for key in (RSA, WRAPPED, CURVE):
        assert secrets.is_der_key(key) and not secrets.is_der_key(key[:-1]) and not secrets.is_der_key(key + b"\0")
    assert not secrets.is_der_key(b"") and not secrets.is_der_key(der(integer(1, 0)))
    field = lambda b: len(b).to_bytes(4, "big") + b
    ssh = b"openssh-key-v1\0" + field(b"none") * 2 + field(b"") + (1).to_bytes(4, "big") + field(b"p" * 51) + field(b"q" * 100)
    assert secrets.is_ssh_key(ssh) and not secrets.is_ssh_key(ssh[:-5])
    assert secrets.is_signed_token(token({"alg": "HS256"}, {"sub": 1}))
    assert not secrets.is_signed_token(token({"typ": "JWT"}, {"sub": 1})) and not secrets.is_signed_token("eyJx.eyJy.zz")
    assert not secrets.is_signed_token(token({"alg": "HS256"}, {"sub": 1}, b"short"))


def test_spans_of_encoded_keys():
    b64 = base64.b64encode(WRAPPED).decode()
    pem = "-----BEGIN PRIVATE KEY-----\n" + "\n".join(b64[i : i + 64] for i in range(0, len(b64), 64)) + "\n-----END PRIVATE KEY-----"
    jwt = token({"alg": "RS256"}, {"a": "b"})
    text = f"😀 see {pem} and {jwt}, also {base64.b64encode(RSA).decode()} or {RSA.hex().upper()} but not {'Q' * 80} nor {'ABab' * 20}"
    kinds = {(text[a:b], k) for a, b, k in secrets.structural_spans(text)}
    assert kinds == {(pem, "pem_key"), (jwt, "signed_token"), (base64.b64encode(RSA).decode(), "der_key"), (RSA.hex().upper(), "der_key")}
    assert secrets.redact(text).startswith("😀 see [pem_key] and [signed_token], also [der_key] or [der_key] but not QQ")


SEALED = der(der(der(b"\x2a\x86\x48", tag=6), der(der(b"\x2a\x86", tag=6))), der(b"\x55" * 64, tag=4))


def test_sealed_keys_and_loose_tokens():
    assert secrets.is_der_key(SEALED) and not secrets.is_der_key(SEALED[:-1])
    info = der(der(der(b"\x2a\x86\x48", tag=6), der(tag=5)), der(b"\x55" * 32, tag=4))  # a digest, not a key
    assert not secrets.is_der_key(info)
    b64 = base64.b64encode(b"\x91" * 64).decode()
    old = f"-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,{'0A' * 16}\n\n{b64}\n-----END RSA PRIVATE KEY-----"
    assert secrets.redact(f"a {old} b") == "a [pem_key] b"
    assert secrets.structural_spans(old.replace("DEK-Info", "Other")) == []
    quoted = "-----BEGIN ENCRYPTED PRIVATE KEY-----\\n" + base64.b64encode(SEALED).decode() + "\\n-----END ENCRYPTED PRIVATE KEY-----"
    assert secrets.redact(f'key = "{quoted}"') == 'key = "[pem_key]"'
    loose = token({"alg": "HS256"}, {"a": 1}).split(".")
    loose[0] = base64.urlsafe_b64encode(b'{ "alg" : "HS256" }').decode().rstrip("=")
    assert not loose[0].startswith("eyJ") and secrets.redact("x " + ".".join(loose)) == "x [signed_token]"


def test_base_kinds_by_plain_patterns_over_tables(spark):
    """The query's counts and base spans, from the given table and plain patterns alone."""
    from dialogprep.llm import queries

    sf = "/root/testdata/sf0.001"
    order = ("assign", "access", "hex")
    got = {r.doc_id: r for r in queries.QUERIES["op7_secret_scans"](spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        found = sorted(base(r.text or ""), key=lambda s: (s[0], order.index(s[2])))
        g = got[r.doc_id]
        assert [g.n_assign, g.n_access, g.n_hex] == [sum(s[2] == k for s in found) for k in order]
        assert g.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in found).encode()).hexdigest()


def test_over_tables(spark):
    rows = texts() + [(50, 'key token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" end', "en", "s")]
    got = secrets.scanned(documents(spark, rows, clash=["secrets"])).collect()
    assert len(got) == len(rows)
    for r in got:
        assert [(s.start, s.end, s.kind) for s in r.secrets] == secrets.spans(r.text)
    clean = secrets.redacted(documents(spark, rows).withColumn("n_chars", F.col("doc_id"))).collect()
    by = {r.doc_id: r for r in clean}
    assert by[50].text == 'key [assign]" end' and by[50].n_chars == 17
    assert {r.doc_id: r.text for r in clean if r.doc_id not in (50, 5)} == {i: t for i, t, *_ in rows if i not in (50, 5)}
    assert secrets.redacted(empty(spark)).count() == 0
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
