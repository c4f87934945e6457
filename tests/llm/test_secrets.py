import base64
import hashlib
import json
import re
import time

from pitbars.llm import secrets_scan as ss

SCHEMA = "doc_id long, text string, lang string, n_chars long"


def der(tag, *parts):
    body = b"".join(parts)
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x81, n]) if n < 256 else bytes([0x82]) + n.to_bytes(2, "big")
    return bytes([tag]) + size + body


RSA = der(0x30, der(2, b"\0"), *(der(2, bytes([1 + i]) * 60) for i in range(8)))
P8 = der(0x30, der(2, b"\0"), der(0x30, der(6, b"\x2b\x65\x70")), der(4, der(4, b"k" * 32)))
EC = der(0x30, der(2, b"\1"), der(4, b"e" * 32), der(0xA0, der(6, b"\x2a\x86\x48")))


def string(x):
    return len(x).to_bytes(4, "big") + x


SSH = b"openssh-key-v1\0" + string(b"none") + string(b"none") + string(b"") + (1).to_bytes(4, "big") + string(b"pub" * 9) + string(b"priv" * 20)


def b64(x, url=False):
    return (base64.urlsafe_b64encode(x).rstrip(b"=") if url else base64.b64encode(x)).decode()


JWT = ".".join([b64(json.dumps({"alg": "HS256", "typ": "JWT"}).encode(), True), b64(b'{"sub":"1"}', True), "c2ln"])
NO_JWT = ".".join([b64(b'{"typ": "JWT"}', True), b64(b'{"sub":"1"}', True), "c2ln"])


def kinds(text):
    base = ss.base_spans(text)
    return [(ss.KINDS[k], text[s:e]) for s, k, e in sorted(base + ss.confirmed_spans(text, base))]


def test_structures():
    for data in (RSA, P8, EC):
        assert ss.private_key(data) and not ss.private_key(data[:-1]) and not ss.private_key(data + b"\0")
        assert kinds(f"é {b64(data)} x") == [("der", b64(data))]
        assert kinds(f"{data.hex()}") == [("hex", data.hex()), ("der", data.hex())]
        pem = f"-----BEGIN PRIVATE KEY-----\n{b64(data)}\n-----END PRIVATE KEY-----"
        assert ("pem", pem) in kinds("a\n" + pem)
    assert ss.openssh_key(SSH) and not ss.openssh_key(SSH[:-1]) and kinds(b64(SSH)) == [("ssh", b64(SSH))]
    assert kinds(f"x {JWT}, y") == [("jwt", JWT)] and kinds(NO_JWT) == []
    assert kinds("M" + "A" * 60) == [] and kinds("-----BEGIN PRIVATE KEY-----\nabcd\n-----END PRIVATE KEY-----") == []


def brute(text):
    """Straight from the definition of the base kinds."""
    out = []
    for m in re.finditer(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    for kind, pattern, least in ((1, "AKIA[A-Z0-9]+", 20), (2, "[0-9a-f]+", 24)):
        out += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if m.end() - m.start() >= least]
    return sorted(out)


def test_report_and_redaction(spark, sf):
    texts = [None, "", "é😀 Password = 'abcdef' TOKEN:x1 api-key=abcdefg apikey: \"abc.def=\"", "AKIA" + "Z" * 16 + " AKIAX", "f" * 24 + "0" * 30, "toKen=secret=abcdefgh", JWT, "x" * 200000 + " secret: 123456"]
    rows = [(i, t, "en", len(t or "")) for i, t in enumerate(texts)] + [(2, texts[2], None, None), (None, "passwd=123456", "de", 13)]
    docs = spark.createDataFrame(rows, SCHEMA).unionByName(spark.read.parquet(f"{sf}/documents.parquet").selectExpr("doc_id + 1000 as doc_id", "text", "lang", "n_chars"))
    docs = docs.selectExpr("*", "1 as spans", "2 as KIND")
    want = sorted((str(r.doc_id), r.text or "") for r in docs.collect())
    got = ss.report(docs).collect()
    assert len(got) == len(want)
    by = {}
    for i, t in want:
        base = brute(t)
        digest = hashlib.sha256(",".join(f"{ss.KINDS[k]}:{s}:{e}" for s, k, e in base).encode()).hexdigest()
        by.setdefault(i, []).append((*(sum(k == x for _, k, _ in base) for x in range(3)), digest))
    for r in got:
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) in by[str(r.doc_id)]
    clean = {r.doc_id: r for r in ss.redact(docs.where("doc_id < 8 or doc_id is null")).collect() if r.doc_id not in (2,)}
    assert clean[None].text == "[assign]" and clean[None].n_chars == 8 and clean[6].text == "[jwt]" and clean[5].text == "[assign]"
    assert ss.report(docs.limit(0)).count() == 0 and ss.redact(docs.limit(0)).columns == docs.columns


def test_long_hostile_texts_take_linear_time():
    key = b64(RSA)
    for part in ("30" + "aa" * 20 + " ", "MA" + "b" * 30 + " ", "MIIB" + "b" * 30 + "\n", "MIQA" + "A" * 30 + " ", b64(b"openssh-key-v1\0") + "AAAA ", "A30" * 8, "30848000" + "02" * 20 + " ", "eyJ" + "x" * 20 + "."):
        text = part * (1_000_000 // len(part)) + "; " + key
        start = time.perf_counter()
        found = kinds(text)
        assert time.perf_counter() - start < 8, part[:8]
        assert ("der", key) in found


def wrapped(text, end="\n"):
    return end.join(text[i : i + 64] for i in range(0, len(text), 64))


def test_wrapped_unterminated_upper_case_and_encrypted_keys():
    for data in (RSA, P8, EC):
        for key in (wrapped(b64(data)), wrapped(b64(data), "\\n"), wrapped(b64(data), "\r\n")):
            assert kinds(f"a {key}\nplain words follow") == [("der", key)]
        assert ("der", data.hex().upper()) in kinds(data.hex().upper())
        assert ("der", wrapped(data.hex().upper())) in kinds(wrapped(data.hex().upper()) + "\nplain")
    for tail in (b"", b"1", b"22"):
        key = SSH[: -len(string(b"priv" * 20))] + string(b"priv" * 20 + tail)
        assert kinds(f"{wrapped(b64(key))}\nplain words follow") == [("ssh", wrapped(b64(key)))]
    scheme = der(0x30, der(6, bytes.fromhex("2a864886f70d01050d")), der(0x30, der(4, b"salt")))
    digest = der(0x30, der(6, bytes.fromhex("608648016503040201")), der(5))
    assert ss.private_key(der(0x30, scheme, der(4, b"x" * 48))) and not ss.private_key(der(0x30, digest, der(4, b"x" * 32)))
    head = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0123456789ABCDEF0123456789ABCDEF\n\n"
    pem = "-----BEGIN RSA PRIVATE KEY-----\n" + head + wrapped(b64(b"\x07" * 160)) + "\n-----END RSA PRIVATE KEY-----"
    assert kinds(f"a {pem} b") == [("pem", pem)] and kinds(pem.replace("4,ENCRYPTED", "4,CLEAR")) == []


def test_redaction_takes_one_python_worker(spark):
    docs = spark.createDataFrame([(1, "password = abcdef1"), (2, None), (3, "")], "doc_id long, text string")
    done = ss.redact(docs)
    assert done._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert {r["doc_id"]: r["text"] for r in done.collect()} == {1: "[assign]", 2: None, 3: ""}
