"""Secret scan: patterns propose, decoded structure confirms."""

from __future__ import annotations

import base64
import binascii
import json
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.llm.frames import free_name, without

#: Kinds in the order in which equal starts are listed.
KINDS = ["assign", "access", "hex", "jwt", "pem", "der", "hexder", "sshkey"]

# The base patterns; letters of the names stand in either case (ASCII only).
_NAMES = ("password", "passwd", "secret", "token", "api_?key")


def _either_case(name: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in name)


_ASSIGN = re.compile(rf"""(?:{"|".join(map(_either_case, _NAMES))})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_HAS_NAME = re.compile("|".join(map(_either_case, _NAMES)))
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")

# From the first header start of a run of token characters; nothing is tried twice, so a long run without a
# token costs one pass.
_JWT = re.compile(r"(?<![A-Za-z0-9_-])(?:(?!eyJ)[A-Za-z0-9_-])*+(eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]*+)")
# Line ends may be escaped, as in JSON; header lines may stand above the body.
_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----(?:\s|\\{1,4}[nrt])*+"
                  r"((?:[A-Za-z][A-Za-z-]{0,40}:[^\n\r\\]{1,200}(?:\s|\\{1,4}[nrt])++){0,8})"
                  r"((?:[A-Za-z0-9+/=\s]|\\{1,4}[nrt/])++)-----END \1-----")
_ESCAPED = re.compile(r"\\+(?:[nrt]|(/))")
_DEK = re.compile(r"DEK-Info:\x20*([A-Za-z0-9-]+),([0-9A-Fa-f]{16,32})(?![0-9A-Fa-f])")
_BASE64 = re.compile(r"(?:(?<![A-Za-z0-9+/_-])|(?<=\\[nrt]))M[A-Za-z0-9+/]{38,}={0,2}")
_URL_BASE64 = re.compile(r"(?:(?<![A-Za-z0-9+/_-])|(?<=\\[nrt]))M[A-Za-z0-9_-]{38,}={0,2}")
_HEX_DER = re.compile(r"(?<![0-9A-Fa-f])30[0-9A-Fa-f]{62,}")
_SSH = re.compile(r"(?<![A-Za-z0-9+/])b3BlbnNzaC1rZXktdjE[A-Za-z0-9+/]{20,}={0,2}")


def _unbase64(s: str) -> bytes | None:
    s = re.sub(r"\s+", "", s).replace("-", "+").replace("_", "/").rstrip("=")
    try:
        return base64.b64decode(s + "=" * (-len(s) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """The (tag, content) items of DER bytes, or None if lengths do not nest exactly."""
    out, i = [], 0
    while i < len(data):
        if i + 2 > len(data):
            return None
        tag, size, i = data[i], data[i + 1], i + 2
        if size & 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or i + n > len(data):
                return None
            size, i = int.from_bytes(data[i:i + n], "big"), i + n
            if size < 0x80:
                return None
        if i + size > len(data):
            return None
        out.append((tag, data[i:i + size]))
        i += size
    return out


def is_private_key(data: bytes | None) -> bool:
    """DER of an RSA, DSA, EC or PKCS#8 private key: one SEQUENCE over everything that starts with a
    version number and holds the numbers or strings that such a key has."""
    if not data or data[0] != 0x30:
        return False
    top = der_items(data)
    if not top or len(top) != 1:
        return False
    parts = der_items(top[0][1])
    if not parts or parts[0][0] != 0x02 or len(parts[0][1]) != 1 or parts[0][1][0] > 1:
        return False
    tags = [t for t, _ in parts]
    if len(parts) >= 9 and tags[:9] == [0x02] * 9:  # RSA: version and eight numbers
        return len(parts[1][1]) >= 32
    if tags == [0x02] * 6:  # DSA: version, p, q, g, public and private number
        p, q, x = (len(parts[i][1]) for i in (1, 2, 5))
        return parts[0][1] == b"\0" and p >= 64 and 20 <= q <= 65 and 0 < x <= q
    if len(parts) >= 3 and tags[1] == 0x30 and tags[2] == 0x04:  # PKCS#8: algorithm, key bytes
        algorithm = der_items(parts[1][1])
        return bool(algorithm) and algorithm[0][0] == 0x06 and len(parts[2][1]) >= 16
    return len(parts) >= 2 and tags[1] == 0x04 and 16 <= len(parts[1][1]) <= 80  # EC


def is_encrypted_body(headers: str, data: bytes | None) -> bool:
    """The body of a traditional encrypted PEM: its headers name a cipher and an initial vector, and
    the bytes fill whole blocks of the vector's size."""
    dek = _DEK.search(headers)
    if not dek or "ENCRYPTED" not in headers or not data or len(data) < 32:
        return False
    return "CBC" not in dek[1].upper() or 2 * len(data) % len(dek[2]) == 0


def is_jwt(s: str) -> bool:
    """A signed token: a JSON header naming an algorithm, and a JSON payload."""
    head, body, _ = s.split(".")
    try:
        header, claims = json.loads(_unbase64(head) or b"x"), json.loads(_unbase64(body) or b"x")
    except (ValueError, UnicodeDecodeError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str) and isinstance(claims, dict)


def is_ssh_key(data: bytes | None) -> bool:
    """An OpenSSH private key: its magic, then the nested lengths of cipher, kdf and options."""
    magic = b"openssh-key-v1\0"
    if not data or not data.startswith(magic):
        return False
    i = len(magic)
    for _ in range(3):
        if i + 4 > len(data):
            return False
        size = int.from_bytes(data[i:i + 4], "big")
        i += 4 + size
        if size > 255 or i > len(data):
            return False
    return i + 4 <= len(data)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base kinds (code points, end exclusive)."""
    out = []
    if _HAS_NAME.search(text):
        out += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 8]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return out


def confirmed_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans whose decoded bytes have the structure of a key or signed token."""
    out = []
    if "eyJ" in text:
        out += [("jwt", *m.span(1)) for m in _JWT.finditer(text) if is_jwt(m[1])]
    if "-----BEGIN " in text:
        for m in _PEM.finditer(text):
            data = _unbase64(_ESCAPED.sub(lambda e: e[1] or "", m[3]))
            if is_private_key(data) or is_ssh_key(data) or is_encrypted_body(m[2], data) or ("ENCRYPTED" in m[1] and data and der_items(data)):
                out.append(("pem", *m.span()))
    inside = [s[1:] for s in out]
    fresh = lambda m: all(m.end() <= a or m.start() >= b for a, b in inside)
    der = {m.span() for pattern in (_BASE64, _URL_BASE64) for m in pattern.finditer(text)
           if fresh(m) and is_private_key(_unbase64(m[0]))}
    out += [("der", *span) for span in sorted(der)]
    if "30" in text:
        out += [("hexder", *m.span()) for m in _HEX_DER.finditer(text)
                if len(m[0]) % 2 == 0 and is_private_key(bytes.fromhex(m[0]))]
    if "b3BlbnNzaC1rZXktdjE" in text:
        out += [("sshkey", *m.span()) for m in _SSH.finditer(text) if fresh(m) and is_ssh_key(_unbase64(m[0]))]
    return out


def _scan(col: pa.Array) -> pa.Array:
    spans = []
    for text in col.to_pylist():
        found = base_spans(text) + confirmed_spans(text) if text else []
        spans.append([{"kind": k, "start": a, "end": b}
                      for k, a, b in sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))])
    return pa.array(spans, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))


def spans_column(text: Column) -> Column:
    return F.arrow_udf(_scan, "array<struct<kind:string, start:int, end:int>>")(text)


def scan_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``secrets``: the spans (kind, start, end; code points, end exclusive) of every text.

    Base kinds are found by pattern: ``assign`` (a name such as password or token
    with a value of 8 characters or more), ``access`` (AKIA identifiers of 16 or
    more) and ``hex`` (runs of 32 or more).  Further spans are reported only if
    their decoded bytes parse: ``pem``, ``der`` and ``hexder`` (private keys whose
    nested DER lengths fit), ``sshkey`` and ``jwt`` (JSON header with an algorithm
    and JSON claims).  Spans may overlap and are ordered by start, then kind.
    One map over the rows, without a shuffle.

    * null or empty text: no spans
    * repeated rows: each row by itself; empty table: empty result
    * a column of ``docs`` named ``secrets`` is replaced
    """
    name = free_name(docs, "_secrets")
    out = docs.withColumn(name, spans_column(docs[f"`{text_col}`"]))
    return out.select(*without(out.drop(name), ["secrets"]), F.col(name).alias("secrets"))


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every reported span replaced by ``mark`` (overlapping spans by one mark)."""

    @F.arrow_udf("string")
    def cut(col: pa.Array) -> pa.Array:
        out = []
        for text in col.to_pylist():
            at, parts = 0, []
            for _, a, b in sorted(base_spans(text) + confirmed_spans(text), key=lambda s: s[1:]) if text else []:
                if b <= at:
                    continue
                if a >= at:
                    parts += [text[at:a], mark]
                at = b
            out.append(None if text is None else "".join(parts) + text[at:])
        return pa.array(out, pa.string())

    return docs.withColumn(text_col, cut(docs[f"`{text_col}`"]))
