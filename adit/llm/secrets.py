r"""Secrets in texts: patterns, and candidates confirmed by their structure.

Patterns find assignments of passwords and tokens, access key ids and long hexadecimal runs. Beyond
them, candidates are decoded and parsed, and reported only where the structure holds all through:

* ``key``: a PEM block, or a run of base64 or hexadecimal digits, whose bytes are a private key: DER
  whose nested lengths fill their containers exactly (PKCS#1, PKCS#8 plain and encrypted, SEC1), or an
  OpenSSH key (magic, then length-prefixed fields that end where the bytes end).
* ``jwt``: three base64url segments of which the first decodes to a JSON object with ``alg`` and the
  second to a JSON object, with a signature as long as that algorithm makes it; or five with ``alg``
  and ``enc`` (the encrypted form).
* ``encoded``: a run of base64 or hexadecimal digits that decodes to text in which an assignment, access
  key id, private key or signed token stands (looked for to ``DEPTH`` layers of encoding).

Public keys and certificates parse as well but are not secrets, and are left out. A run of digits is
decoded whole; white space ends it, except in PEM blocks. Work is one walk over each text in Python, on
batches within tasks: no rows move, and a lost task is redone alone.

Defined results: a null or empty text has no spans; repeated rows give equal rows; an empty table gives an
empty result; a match that fails its kind's test is dropped and not retried.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adit.llm.common import map_rows, table, text_of


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))
_WITHIN = ("passw", "secret", "token", "api")  # one of these is in every name
#: kind: pattern, the group whose length counts, and its least length
BASE: dict[str, tuple[re.Pattern[str], int, int]] = {
    "assign": (re.compile(rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 8),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    "hex": (re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}"), 0, 32),  # a shorter run fails whole, so runs begin at their first digit
}
STRUCTURAL = ("key", "jwt", "encoded")
DEPTH = 3
_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----([^-]*)-----END \1-----")
_TOKEN = re.compile(r"(?<![A-Za-z0-9_.-])[A-Za-z0-9_-]{8,}(?:\.[A-Za-z0-9_-]*){2,}(?![A-Za-z0-9_-])")
_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
_HEX = re.compile(r"(?:[0-9a-f]{2})+|(?:[0-9A-F]{2})+")
#: Bytes of a signature by algorithm (RFC 7518, RFC 8037); RSA's depend on the key, 128 at least.
_SIGNATURE = {"HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES384": 96, "ES512": 132, "EDDSA": 64, "NONE": 0}
_RSA = ("RS256", "RS384", "RS512", "PS256", "PS384", "PS512")
_SEQUENCE, _INTEGER, _OCTETS, _OBJECT = 0x30, 0x02, 0x04, 0x06


def base_spans(text: str) -> Iterator[tuple[int, int, int, str]]:
    """start, place of the kind, end, kind of what the patterns find."""
    lowered = text.lower()
    for order, (kind, (pattern, group, least)) in enumerate(BASE.items()):
        if kind == "assign" and not any(part in lowered for part in _WITHIN):
            continue  # spares most texts the dearest pattern
        for m in pattern.finditer(text):
            if len(m[group]) >= least:
                yield m.start(), order, m.end(), kind


def decoded(run: str) -> Iterator[bytes]:
    """What a run of digits may stand for: hexadecimal if it is whole bytes of one case, and base64."""
    if _HEX.fullmatch(run):
        yield bytes.fromhex(run)
    body = run.rstrip("=")
    if len(body) % 4 != 1 and len(run) - len(body) in (0, -len(body) % 4):
        try:
            yield base64.b64decode(body.replace("-", "+").replace("_", "/") + "=" * (-len(body) % 4), validate=True)
        except binascii.Error:
            return


def _elements(data: bytes) -> list[tuple[int, bytes]] | None:
    """The DER elements that fill ``data`` exactly, or None."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size >= 0x80:
            n = size - 0x80
            if not 1 <= n <= 4 or at + n > len(data):
                return None
            size, at = int.from_bytes(data[at : at + n], "big"), at + n
            if size < 0x80 or size >> (8 * (n - 1)) == 0:  # DER takes the shortest form
                return None
        if at + size > len(data):
            return None
        out.append((tag, data[at : at + size]))
        at += size
    return out


def _inside(data: bytes, tag: int = _SEQUENCE) -> list[tuple[int, bytes]]:
    """The elements of the one element that ``data`` is, if it has this tag."""
    whole = _elements(data)
    return (_elements(whole[0][1]) or []) if whole and len(whole) == 1 and whole[0][0] == tag else []


def is_der_key(data: bytes) -> bool:
    """Whether the bytes are one private key in DER."""
    if len(data) < 16 or data[0] != _SEQUENCE:
        return False
    parts = _inside(data)
    tags = [tag for tag, _ in parts]
    if tags[:9] == [_INTEGER] * 9 and parts[0][1] in (b"\0", b"\1"):  # PKCS#1: version, modulus, seven numbers more
        return len(parts) == 9 or parts[0][1] == b"\1"
    if tags[:3] == [_INTEGER, _SEQUENCE, _OCTETS] and parts[0][1] in (b"\0", b"\1"):  # PKCS#8: version, algorithm, key
        algorithm = _elements(parts[1][1])
        return bool(algorithm) and algorithm[0][0] == _OBJECT and _elements(parts[2][1]) is not None
    if tags[:2] == [_INTEGER, _OCTETS] and parts[0][1] == b"\1":  # SEC1: version 1, the number, then curve and point tagged
        return len(parts[1][1]) >= 16 and all(tag in (0xA0, 0xA1) and _elements(value) is not None for tag, value in parts[2:])
    if tags == [_SEQUENCE, _OCTETS]:  # PKCS#8 encrypted: algorithm with parameters, data
        algorithm = _elements(parts[0][1])
        return bool(algorithm) and [tag for tag, _ in algorithm] == [_OBJECT, _SEQUENCE] and len(parts[1][1]) >= 32
    return False


def is_openssh_key(data: bytes) -> bool:
    """Whether the bytes are a private key in OpenSSH's form."""
    magic, at, fields = b"openssh-key-v1\0", 15, []
    if not data.startswith(magic):
        return False

    def field() -> bytes | None:
        nonlocal at
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data):
            return None
        at += 4 + size
        return data[at - size : at]

    fields = [field() for _ in range(3)]  # cipher, key derivation, its options
    if None in fields or at + 4 > len(data):
        return False
    count, at = int.from_bytes(data[at : at + 4], "big"), at + 4
    return 1 <= count <= 16 and all(field() for _ in range(count)) and bool(field()) and at == len(data)


def _object(segment: str) -> dict | None:
    """The JSON object that a base64url segment holds."""
    try:
        found = json.loads(base64.b64decode(segment.replace("-", "+").replace("_", "/") + "=" * (-len(segment) % 4), validate=True))
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def is_token(run: str) -> bool:
    """Whether dotted segments are a signed or an encrypted token."""
    segments = run.split(".")
    if len(segments) not in (3, 5):
        return False
    header = _object(segments[0])
    algorithm = (header or {}).get("alg")
    if not isinstance(algorithm, str):
        return False
    if len(segments) == 5:
        return isinstance(header.get("enc"), str) and all(segments[2:])
    size = len(segments[2]) * 3 // 4
    known = _SIGNATURE.get(algorithm.upper())
    fits = size == known if known is not None else size >= 128 if algorithm.upper() in _RSA else size > 0
    return fits and _object(segments[1]) is not None


def structural_spans(text: str, depth: int = DEPTH) -> Iterator[tuple[int, int, int, str]]:
    """start, place of the kind, end, kind of what is confirmed by its structure; spans do not overlap."""
    at = lambda m, kind: (m.start(), len(BASE) + STRUCTURAL.index(kind), m.end(), kind)
    found = []
    if "PRIVATE KEY-----" in text:
        for m in _PEM.finditer(text):
            body = re.sub(r"\s+", "", re.sub(r"^\s*(?:[A-Za-z-]+: .*\n)+", "", m[2]))
            if "ENCRYPTED" in m[2] or any(is_der_key(data) or is_openssh_key(data) for data in decoded(body)):
                found.append(at(m, "key"))
    found += [at(m, "jwt") for m in _TOKEN.finditer(text) if is_token(m[0])]
    found.sort()
    taken = [(start, end) for start, _, end, _ in found]
    yield from found
    k = 0
    for m in _RUN.finditer(text):
        while k < len(taken) and taken[k][1] <= m.start():
            k += 1
        if k < len(taken) and taken[k][0] < m.end():
            continue  # part of what is reported already
        kind = _kind_of_run(m[0], depth)
        if kind:
            yield at(m, kind)


def _kind_of_run(run: str, depth: int) -> str | None:
    for data in decoded(run):
        if is_der_key(data) or is_openssh_key(data):
            return "key"
        if depth and data.isascii() and (inner := data.decode()).isprintable() | ("\n" in inner):
            if any(kind != "hex" for *_, kind in base_spans(inner)) or next(structural_spans(inner, depth - 1), None):
                return "encoded"
    return None


def secrets_of(text: str | None, depth: int = DEPTH) -> list[tuple[int, int, str]]:
    """All spans (start, end, kind) of a text, by start, then kind as listed."""
    text = text or ""
    return [(start, end, kind) for start, _, end, kind in sorted([*base_spans(text), *structural_spans(text, depth)])]


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH) -> DataFrame:
    """``doc_id, kinds, starts, ends`` of every row: its spans by start, then kind as listed."""

    def make() -> Callable[[list[list]], list[list]]:
        def work(columns: list[list]) -> list[list]:
            found = [secrets_of(text, depth) for text in columns[1]]
            return [columns[0], *[[[span[k] for span in spans] for spans in found] for k in (2, 0, 1)]]

        return work

    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    return map_rows(rows, "doc_id long, kinds array<string>, starts array<int>, ends array<int>", make)


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets(table(spark, sf_dir, "documents"))
    spans = F.arrays_zip("kinds", "starts", "ends")
    listed = lambda of: F.array_join(F.transform(of, lambda s: F.concat_ws(":", s["kinds"], s["starts"].cast("string"), s["ends"].cast("string"))), ",")
    base = F.filter(spans, lambda s: s["kinds"].isin(*BASE))
    count = lambda kind: F.size(F.filter("kinds", lambda k: k == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(spans).alias("spans"),
        *[count(kind).alias(f"n_{kind}") for kind in STRUCTURAL],
    )
