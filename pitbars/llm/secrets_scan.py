"""Secrets in texts: assignments, access keys and hex runs, and encodings confirmed by structure.

Candidates in base64 or hex are decoded and reported only if the bytes parse: a private key as nested
DER lengths that add up exactly (PKCS#1, PKCS#8, SEC 1), an OpenSSH key as its magic with nested
lengths, an encrypted key by its scheme (PKCS#8) or headers (PEM), a signed token as a JSON header that names an algorithm followed by a JSON payload.
Bare keys may be wrapped; their span ends where the nested lengths say, whatever follows.

Kinds, in this order: assign, access, hex (patterns alone); jwt, pem, der, ssh (confirmed).
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitbars.llm.common import appended, numbered, place, tidied

KINDS = ("assign", "access", "hex", "jwt", "pem", "der", "ssh")
BASE = 3

# The patterns and least lengths of the base kinds.
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE, LEAST_ACCESS = 6, 20

WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
JWT = re.compile(r"(?<![\w.-])(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----((?:(?!-----)[A-Za-z0-9+/=\s\\:,-])+)-----END \1-----")
#: Headers of an encrypted PEM block, and any header line.
SEALED = re.compile(r"\s*Proc-Type:\s*4,\s*ENCRYPTED\s+DEK-Info:\s*[A-Z0-9-]+,\s*[0-9A-Fa-f]+\s")
HEADER = re.compile(r"^[A-Za-z-]+:.*$", re.MULTILINE)
#: Where a key may begin. A DER sequence starts with 0x30 and a length: M and a letter up to P in base64.
DER = re.compile(r"(?<![A-Za-z0-9+/_-])M[A-P][A-Za-z0-9+/_-]{30}")
HEX_DER = re.compile(r"(?<![0-9a-f])30[0-9A-Fa-f]{22}")
SSH = re.compile(r"(?<![A-Za-z0-9+/])b3BlbnNzaC1rZXktdjEA[A-Za-z0-9+/\s\\]")
BREAK = re.compile(r"\s|\\[nr]")
#: Digits that may be wrapped.
RUN_64 = re.compile(r"[A-Za-z0-9+/_-]+(?:(?:\s|\\[nr])+[A-Za-z0-9+/_-]+)*")
RUN_SSH = re.compile(r"[A-Za-z0-9+/]+(?:(?:\s|\\[nr])+[A-Za-z0-9+/]+)*")
RUN_HEX = re.compile(r"[0-9A-Fa-f]+(?:(?:\s|\\[nr])+[0-9A-Fa-f]+)*")
#: More elements on one level than any private key has.
MOST = 32


def debase(text: str) -> bytes | None:
    """Bytes of base64, plain or for URLs, with or without padding; None if it is none."""
    text = re.sub(r"\s|\\n|\\r", "", text).rstrip("=").translate(str.maketrans("-_", "+/"))
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True) if len(text) % 4 != 1 else None
    except binascii.Error:
        return None


def elements(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tags and contents of the DER elements that make up `data` exactly, or None; None beyond MOST of them."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data) or len(out) == MOST:
            return None
        tag, n = data[at], data[at + 1]
        at += 2
        if n & 0x80:
            width = n & 0x7F
            if not 1 <= width <= 4 or at + width > len(data):
                return None
            n = int.from_bytes(data[at : at + width], "big")
            if n < 0x80 or n >> (8 * (width - 1)) == 0:
                return None  # not the shortest form
            at += width
        if at + n > len(data):
            return None
        out.append((tag, data[at : at + n]))
        at += n
    return out


INTEGER, OCTETS, OBJECT, SEQUENCE = 0x02, 0x04, 0x06, 0x30
#: Encryption by password: PKCS#5 and PKCS#12.
SCHEMES = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))


def der_size(data: bytes) -> int | None:
    """Number of bytes of the DER element that `data` starts with, by its length."""
    if len(data) < 2 or data[1] < 0x80:
        return 2 + data[1] if len(data) > 1 else None
    width = data[1] & 0x7F
    return 2 + width + int.from_bytes(data[2 : 2 + width], "big") if 1 <= width <= 4 <= len(data) - width + 2 else None


def private_key(data: bytes | None) -> bool:
    """Whether the bytes are one DER private key; every nested length has to fit."""
    outer = elements(data or b"")
    if not outer or len(outer) != 1 or outer[0][0] != SEQUENCE:
        return False
    inner = elements(outer[0][1])
    if inner and [t for t, _ in inner] == [SEQUENCE, OCTETS] and inner[1][1]:  # PKCS#8, encrypted
        scheme = elements(inner[0][1])
        return bool(scheme) and scheme[0][0] == OBJECT and bytes(scheme[0][1][:16]).startswith(SCHEMES)
    if not inner or inner[0][0] != INTEGER or len(inner) < 2:
        return False
    tags, version = [t for t, _ in inner], inner[0][1]
    if version == b"\0" and len(inner) >= 9 and all(t == INTEGER and c for t, c in inner[:9]):
        return True  # PKCS#1
    if version == b"\0" and len(inner) >= 6 and len(inner) == 6 and all(t == INTEGER and c for t, c in inner):
        return True  # DSA
    if version in (b"\0", b"\1") and tags[1:3] == [SEQUENCE, OCTETS]:  # PKCS#8
        kind = elements(inner[1][1])
        return bool(kind) and kind[0][0] == OBJECT and bool(inner[2][1])
    if version == b"\1" and tags[1] == OCTETS and inner[1][1]:  # SEC 1
        return all(t in (0xA0, 0xA1) and elements(c) for t, c in inner[2:])
    return False


def openssh_key(data: bytes | None) -> bool:
    """Whether the bytes are an OpenSSH private key: magic, then strings whose lengths fit."""
    return bool(data) and openssh_size(data) == len(data)


def openssh_size(data: bytes) -> int | None:
    """Number of bytes of the OpenSSH private key that `data` starts with, None if it is none."""
    magic = b"openssh-key-v1\0"
    if bytes(data[: len(magic)]) != magic:
        return None
    at = len(magic)

    def string() -> bytes | None:
        nonlocal at
        n = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + n > len(data):
            return None
        at += 4 + n
        return data[at - n : at]

    names = [string() for _ in range(3)]  # cipher, key derivation, its options
    if None in names or not names[0] or at + 4 > len(data):
        return None
    keys = int.from_bytes(data[at : at + 4], "big")
    at += 4
    return at if 1 <= keys <= 64 and all(string() for _ in range(keys)) and string() else None


def sealed(body: str) -> bool:
    """Whether a PEM body is encrypted as its headers say: whole blocks of a cipher."""
    head = SEALED.match(body)
    data = debase(body[head.end() :]) if head else None
    return bool(data) and len(data) % 8 == 0


class Run:
    """A run of digits of `bits` bits, decoded once for each place within a group of digits at which a
    key can begin, so that any number of beginnings reads it without another copy."""

    def __init__(self, text: str, start: int, end: int, bits: int):
        kept, at = [], start
        for m in BREAK.finditer(text, start, end):
            kept.append(np.arange(at, m.start()))
            at = m.end()
        self.places = np.concatenate([*kept, np.arange(at, end)])
        self.digits, self.bits, self.decoded = BREAK.sub("", text[start:end]), bits, {}

    def read(self, place: int) -> tuple[int, memoryview]:
        """Number of the digit at a place of the text, and the bytes from there on."""
        digit = int(np.searchsorted(self.places, place))
        group = 2 if self.bits == 4 else 4
        phase = digit % group
        if phase not in self.decoded:
            digits = self.digits[phase:]
            if self.bits == 4:
                data = bytes.fromhex(digits[: len(digits) // 2 * 2])
            else:
                data = debase(digits[:-1] if len(digits) % 4 == 1 else digits) or b""
            self.decoded[phase] = memoryview(data)
        return digit, self.decoded[phase][(digit - phase) // group * (group * self.bits // 8) :]


def bare_keys(text: str, pattern: re.Pattern, runs: re.Pattern, size_of, fits, bits: int) -> list[tuple[int, int]]:
    """(start, end) of keys in runs of digits of `bits` bits that may be wrapped; `size_of` tells from
    the bytes how long a key is, `fits` whether these bytes are one. Linear in the text: a run is
    decoded once, and a beginning costs no more than the elements it names."""
    out, at, upto, run = [], 0, 0, None
    while m := pattern.search(text, at):
        at = m.start() + 1
        if m.start() >= upto:
            # The run that the beginning lies in; what comes before it in its run is of no use.
            span = runs.match(text, m.start())
            upto, run = span.end(), Run(text, m.start(), span.end(), bits)
        digit, data = run.read(m.start())
        size = size_of(data)
        if size and size <= len(data) and fits(data[:size]):
            end = int(run.places[digit - (-size * 8 // bits) - 1]) + 1
            for _ in range(-size % 3 if bits == 6 else 0):
                end += text.startswith("=", end)
            out.append((m.start(), end))
            at = end
    return out


def signed_token(header: str, payload: str) -> bool:
    """Whether the parts are a JSON header that names an algorithm, and a JSON object."""
    try:
        head, body = (json.loads(debase(p) or b"") for p in (header, payload))
    except (ValueError, RecursionError):
        return False
    return isinstance(head, dict) and isinstance(head.get("alg"), str) and isinstance(body, dict)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns alone."""
    out = []
    lowered = text.lower()
    if any(w in lowered for w in WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def confirmed_spans(text: str, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what the structure confirms; `found` has the hex runs."""
    out = []
    if "eyJ" in text:
        out += [(m.start(), 3, m.end()) for m in JWT.finditer(text) if signed_token(m[1], m[2])]
    if "PRIVATE KEY-----" in text:
        for m in PEM.finditer(text):
            body = re.sub(r"\\[nr]", "\n", m[2])
            data = debase(HEADER.sub("", body))
            if private_key(data) or openssh_key(data) or sealed(body):
                out.append((m.start(), 4, m.end()))
    out += [(i, 5, j) for i, j in bare_keys(text, DER, RUN_64, der_size, private_key, 6)]
    out += [(i, 5, j) for i, j in bare_keys(text, HEX_DER, RUN_HEX, der_size, private_key, 4)]
    if "b3BlbnNzaC1rZXktdjEA" in text:
        out += [(i, 6, j) for i, j in bare_keys(text, SSH, RUN_SSH, openssh_size, openssh_key, 6)]
    return out


def _scanned(at: int):
    """Batches with the spans of their column `at` as a last column."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t in batch.column(at).to_pylist():
                base = base_spans(t) if t else []
                found = sorted(base + confirmed_spans(t, base)) if t else []
                out.append([{"kind": KINDS[k], "start": s, "end": e, "base": k < BASE} for s, k, e in found])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, kind)], [*batch.schema.names, "spans"])

    return run


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row with one more column `spans`: an array of (kind, start, end, base), by start and kind,
    in code points, end exclusive.

    A null or empty text has none. Rows stay as they are; a column named spans gives way to the new one.
    """
    flat, at, names = numbered(docs), place(docs, text), docs.columns
    spans = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("base", T.BooleanType())]))
    done = flat.mapInArrow(tidied(_scanned(at)), appended(flat, T.StructField("spans", spans)))
    return done.select(*(F.col(f"c{i}").alias(n) for i, n in enumerate(names) if n.lower() != "spans"), "spans")


def report(docs: DataFrame) -> DataFrame:
    """Counts and digests of the spans of every document."""
    found = scan(docs.select("doc_id", "text"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def counted(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["base"])
    counts = [counted(kind) for kind in KINDS[:BASE]]
    return found.select(
        "doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_confirmed")
    )


def redact(docs: DataFrame) -> DataFrame:
    """`docs`, all columns as they are, with every span in the text replaced by [kind]; spans that
    overlap become one, named after the first. n_chars, where it is there, follows the text.

    Spans are found and replaced in one Python worker, so a task never holds two."""
    flat, at, names = numbered(docs), place(docs, "text"), docs.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _scanned(at)(batches):
            columns, spans = batch.columns[:-1], batch.columns[-1].to_pylist()
            texts = columns[at].to_pylist()
            columns[at] = pa.array([replaced(t, s) if s else t for t, s in zip(texts, spans)], columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1])

    done = flat.mapInArrow(tidied(run), flat.schema)
    counted = [i for i, n in enumerate(names) if n == "n_chars"]
    for i in counted:
        n = F.length(f"c{at}").cast(flat.schema[i].dataType)
        done = done.withColumn(f"c{i}", F.coalesce(n, F.col(f"c{i}")))
    return done.toDF(*names)


def replaced(text: str, spans: list[dict]) -> str:
    out, at, begun = [], 0, -1
    for s in sorted(spans, key=lambda s: (s["start"], KINDS.index(s["kind"]))):
        if s["start"] >= at and s["start"] > begun:
            out += [text[at : s["start"]], f"[{s['kind']}]"]
            begun = s["start"]
        at = max(at, s["end"])
    return "".join(out) + text[at:]
