"""Secret scan with structural confirmation.

Three plain patterns (`assign`, `access`, `hex`) are reported as they match. The other kinds are reported
only once their structure holds: base64 or hex candidates are decoded, and what comes out must be a private
key whose nested lengths add up exactly (DER as in PKCS#1, PKCS#8 with the key inside it, or SEC 1, or the OpenSSH
container), or a signed token whose header and claims are JSON and whose header names an algorithm. Armoured keys may
have escaped line breaks, as in JSON, or be encrypted with the cipher named in their headers. Base64 is also joined over
lines, and a key glued to other letters of its alphabet is cut out by the length that its first bytes give.

Each text is scanned whole and by itself, so the work is one pass over the table without a shuffle.

Defined results: a null or empty text has no spans, repeated rows are scanned one by one, an empty table
gives an empty result, and other columns of the input are ignored. Spans count code points, the end is
exclusive; spans of different kinds may overlap.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import table

KINDS = ("assign", "access", "hex", "pem", "token", "key64", "keyhex")
BASE = KINDS[:3]

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
PEM = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----((?:[A-Za-z0-9+/=\s:,]|-(?!----)|\\[nrt])+)-----END \1-----")
BREAK = re.compile(r"\\[nrt]|\s")
CIPHER = re.compile(r"Proc-Type:\s*4,ENCRYPTED(?:\s|\\[nr])+DEK-Info:\s*[A-Z0-9-]+,([0-9A-Fa-f]+)(?:\s|\\[nr])+")
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])(e[wy][A-Za-z0-9_-]+)\.(e[wy3][A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
KEY64 = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
KEYHEX = re.compile(r"[0-9a-fA-F]{64,}")
LINES = re.compile(r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40,}+(?:(?:\r?\n|\\n)[A-Za-z0-9+/]++)++={0,2}")
#: How a DER sequence may begin in base64 and in hex.
SEQ64 = re.compile(r"(?=M[A-Za-z0-9+/_-]{11})")
SEQHEX = re.compile(r"(?=30[0-9a-f]{16})", re.IGNORECASE)

#: How OpenSSH marks its own private key files.
OPENSSH = b"openssh-key-v1\0"
#: Object identifiers of the algorithms whose keys are sequences of their own: rsaEncryption and ecPublicKey.
RSA, EC = bytes.fromhex("2a864886f70d010101"), bytes.fromhex("2a8648ce3d0201")


def unbase64(text: str) -> bytes | None:
    """Standard or URL-safe base64 with or without padding; None where it isn't base64."""
    body = text.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """(tag, content) of DER values that fill data exactly; None where lengths don't add up."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, length, at = data[at], data[at + 1], at + 2
        if length & 0x80:
            n = length & 0x7F
            if not 1 <= n <= 4 or at + n > len(data) or data[at] == 0:
                return None
            length, at = int.from_bytes(data[at : at + n], "big"), at + n
            if length < 0x80:
                return None
        if at + length > len(data):
            return None
        out.append((tag, data[at : at + length]))
        at += length
    return out


def is_der_key(data: bytes) -> bool:
    """A PKCS#1, SEC 1, DSA or PKCS#8 private key, or an encrypted PKCS#8 one."""
    outer = der_items(data)
    if not outer or len(outer) != 1 or outer[0][0] != 0x30:
        return False
    items = der_items(outer[0][1])
    if not items:
        return False
    tags = [t for t, _ in items]
    if tags[0] == 0x02 and len(items[0][1]) == 1 and items[0][1][0] <= 1:
        if len(tags) in (6, 9) and set(tags) == {0x02}:
            return True
        if tags[1] == 0x04 and len(items[1][1]) >= 16:
            return all(t in (0xA0, 0xA1) and der_items(c) for t, c in items[2:])
        if len(tags) >= 3 and tags[1] == 0x30 and tags[2] == 0x04:
            algorithm, inner = der_items(items[1][1]), der_items(items[2][1])
            if not algorithm or algorithm[0][0] != 0x06 or not inner:
                return False
            return is_der_key(items[2][1]) if algorithm[0][1] in (RSA, EC) else True
    if tags == [0x30, 0x04]:
        algorithm = der_items(items[0][1])
        return bool(algorithm) and algorithm[0][0] == 0x06 and len(items[1][1]) >= 32
    return False


def is_openssh_key(data: bytes) -> bool:
    """The container's strings, each led by its length, fill it exactly, and it holds a key at least."""
    if not data.startswith(OPENSSH):
        return False
    at, n_keys, seen = len(OPENSSH), None, 0
    while at < len(data):
        if at + 4 > len(data):
            return False
        value, at = int.from_bytes(data[at : at + 4], "big"), at + 4
        if seen == 3:  # cipher, key derivation and its options come first, then the number of keys
            n_keys = value
        elif at + value > len(data):
            return False
        else:
            at += value
        seen += 1
    return bool(n_keys) and seen == 5 + n_keys


def is_key(data: bytes | None) -> bool:
    return bool(data) and (is_der_key(data) or is_openssh_key(data))


def is_armoured(body: str) -> bool:
    """What stands between the lines of an armour: a key, or blocks of the cipher that its headers name."""
    head = CIPHER.search(body)
    data = unbase64(BREAK.sub("", body[head.end() :] if head else body))
    if head is None:
        return is_key(data)
    size = len(head[1]) // 2
    return bool(data) and len(head[1]) % 2 == 0 and size in (8, 16) and len(data) % size == 0


def sequence_size(first: bytes) -> int | None:
    """Bytes of the DER sequence that begins so, if a version number or another sequence leads it; else None."""
    if len(first) < 9 or first[0] != 0x30:
        return None
    n = first[1] & 0x7F if first[1] & 0x80 else 0
    if n > 2 or first[1] == 0x80:
        return None
    body = first[2 + n :]
    if not (body[0] == 0x30 or body[0] == 0x02 and body[1] == 1 and body[2] <= 1):
        return None
    return 2 + n + (int.from_bytes(first[2 : 2 + n], "big") if n else first[1])


def keys_within(run: str, starts: re.Pattern, decode, first: int, per: tuple[int, int]) -> list[tuple[int, int]]:
    """(start, end) of keys inside a run of letters: each start is read as far as its own length says, left to right."""
    out, at = [], 0
    for m in starts.finditer(run):
        k = m.start()
        size = sequence_size(decode(run[k : k + first]) or b"") if k >= at else None
        if size is None:
            continue
        letters = -(-size * per[0] // per[1])
        data = decode(run[k : k + letters]) if k + letters <= len(run) else None
        if data and is_der_key(data[:size]):
            at = k + letters
            out.append((k, at))
    return out


def unhex(text: str) -> bytes | None:
    return bytes.fromhex(text) if len(text) % 2 == 0 else None


def keys64(run: str) -> list[tuple[int, int]]:
    return [(0, len(run))] if is_key(unbase64(run)) else keys_within(run, SEQ64, unbase64, 12, (4, 3))


def keyshex(run: str) -> list[tuple[int, int]]:
    return [(0, len(run))] if is_key(unhex(run)) else keys_within(run, SEQHEX, unhex, 18, (2, 1))


def is_token(head: str, claims: str) -> bool:
    try:
        header, body = (json.loads(unbase64(x) or b"") for x in (head, claims))
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str) and isinstance(body, dict)


def scan(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind as listed."""
    if not text:
        return []
    found: list[tuple[str, int, int]] = []
    low = text.lower()
    if "passw" in low or "secret" in low or "token" in low or "api" in low:
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    if "PRIVATE KEY-----" in text:
        for m in PEM.finditer(text):
            if is_armoured(m[2]):
                found.append(("pem", *m.span()))
    if ".e" in text:
        found += [("token", *m.span()) for m in TOKEN.finditer(text) if is_token(m[1], m[2])]
    runs = [(m.start(), m[0]) for m in KEY64.finditer(text)]
    found += [("key64", at + i, at + j) for at, run in runs for i, j in keys64(run)]
    if runs:
        taken = [f[1:] for f in found if f[0] in ("pem", "key64")]
        for m in LINES.finditer(text):
            if not any(i < m.end() and m.start() < j for i, j in taken) and is_key(unbase64(BREAK.sub("", m[0]))):
                found.append(("key64", *m.span()))
    found += [("keyhex", m.start() + i, m.start() + j) for m in KEYHEX.finditer(text) for i, j in keyshex(m[0])]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def secrets(docs: DataFrame) -> DataFrame:
    """doc_id and all spans found in its text, as an array of (kind, start, end)."""

    def work(batches):
        for batch in batches:
            found = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in scan(t)] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(_SPAN))], names=["doc_id", "spans"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>")


def op6(spark, sf_dir: str) -> DataFrame:
    named = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    out = secrets(table(spark, sf_dir, "documents"))
    return out.select("doc_id", *[count(k) for k in BASE], F.sha2(named(base), 256).alias("base_sha256"), named(F.col("spans")).alias("spans"))
