import base64
import json
import random
import re
import time

from pyspark.sql import functions as F

from statlake.llm.secrets import KINDS, TOKEN, base_only, count_of, find_secrets, span_text, spans_of

LETTER = lambda word: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)
WORDS = "|".join(LETTER(w) for w in ("password", "passwd", "secret", "token"))
ASSIGN = re.compile(
    f"({WORDS}|{LETTER('api')}_?{LETTER('key')})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)


def brute(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in sorted(found)]


def packed(value):
    raw = value if isinstance(value, bytes) else json.dumps(value).encode()
    return base64.urlsafe_b64encode(raw).decode().rstrip("=")


def der(tag, *parts):
    body = b"".join(parts)
    size = bytes([len(body)]) if len(body) < 128 else bytes([0x82]) + len(body).to_bytes(2, "big")
    return bytes([tag]) + size + body


def text_of(*fields):
    return b"".join(len(f).to_bytes(4, "big") + f for f in fields)


JWT = f"{packed({'alg': 'HS256'})}.{packed({'sub': '1'})}.{packed(b'0123456789abcdef')}"
NUMBERS = [der(2, bytes([1 + k]) * 60) for k in range(8)]
RSA = der(0x30, der(2, b"\0"), *NUMBERS)
WRAPPED = der(0x30, der(2, b"\0"), der(0x30, der(6, b"\x2b\x65\x70")), der(4, der(4, b"k" * 32)))
SSH = b"openssh-key-v1\0" + text_of(b"none", b"none", b"") + (1).to_bytes(4, "big") + text_of(b"p" * 51, b"q" * 136)


def test_base_spans_against_patterns():
    rng = random.Random(6)
    bits = ["password", "PassWD", "api_key", "apikey", "token", "secret", "=", ":", " ", '"', "'", "AKIA", "A1B2C3D4"]
    bits += ["E5F6G7H8", "0123456789abcdef", "deadbeef", "ſecret", "toKen", "é", "😀", "/+_.", "\n", "x" * 9, "  "]
    for _ in range(20_000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(14)))
        assert [s for s in spans_of(text) if s["kind"] in KINDS[:3]] == brute(text)


def test_structure_decides():
    plain = base64.b64encode(RSA).decode()
    lines = "\n".join(plain[i : i + 64] for i in range(0, len(plain), 64))
    good = [JWT, plain, packed(WRAPPED), base64.b64encode(SSH).decode(), RSA.hex()]
    good.append(f"-----BEGIN RSA PRIVATE KEY-----\n{lines}\n-----END RSA PRIVATE KEY-----")
    for secret in good:
        for before in ("see ", "é\n"):
            found = [s for s in spans_of(f"{before}{secret} end") if s["kind"] in KINDS[3:]]
            assert {"start": len(before), "end": len(before) + len(secret), "kind": found[-1]["kind"]} in found
    cut = base64.b64encode(RSA[:-3]).decode()
    bad = [f"{packed({'typ': 'x'})}.{packed({'sub': '1'})}.abc", packed(b"k" * 90), cut, SSH[:-9].hex(), "A" * 900]
    bad += [f"{packed(b'[1, 2, 3, 4]')}.{packed(b'[1, 2, 3, 4]')}.", RSA[:-1].hex(), "a.b" * 999]
    assert not [s for secret in bad for s in spans_of(f"see {secret} end") if s["kind"] in KINDS[3:]]


def test_table(spark):
    long = "pass the token to " * 100_000 + f"token={JWT}"
    rows = [(1, None, 1), (2, "", 1), (3, long, 1), (4, "secret: '12345678'", 1), (4, "secret: '12345678'", 1)]
    frame = spark.createDataFrame(rows, "doc_id int, text string, spans int")
    made = find_secrets(frame)
    got = made.select("doc_id", span_text(F.col("spans")).alias("s"), count_of(F.col("spans"), "assign").alias("n"),
                      span_text(base_only(F.col("spans"))).alias("b")).collect()
    at = len(long) - len(JWT)
    want = {1: "", 2: "", 3: f"assign:{at - 6}:{len(long)},jwt:{at}:{len(long)}", 4: "assign:0:17"}
    assert all(r.s == want[r.doc_id] for r in got) and [r.n for r in got] == [0, 0, 1, 1, 1]
    assert got[2].b == want[3].split(",")[0]
    assert find_secrets(frame.limit(0)).count() == 0


def test_token_behind_a_dotted_prefix():
    for prefix in ("session_token.", "authorization.", "first_part.second_part.third_part."):
        found = [s for s in spans_of(f"{prefix}{JWT} end") if s["kind"] == "jwt"]
        assert found == [{"kind": "jwt", "start": len(prefix), "end": len(prefix) + len(JWT)}]


def test_long_runs_take_linear_time():
    token = ".".join([packed({"alg": "HS256"}), packed({"sub": "x"}), "c2ln"])
    run = "Ab1_" * (1 << 18)
    for text in (run, run + ".", run + "." + run, "abcdefgh." * (1 << 17), "." * (1 << 20), run + " " + token):
        started = time.perf_counter()
        kinds = [s["kind"] for s in spans_of(text)]
        assert time.perf_counter() - started < 2
        assert kinds == (["jwt"] if text.endswith(token) else [])


def test_tokens_as_by_trying_every_place():
    """The signed tokens of runs put together from parts, against a search that may start anywhere."""
    plain = re.compile(rb"[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*")
    rng = random.Random(8)
    parts = [".", "..", "short", "longenough", "a+b", "=", "/", packed({"alg": "none"}), packed({"sub": "someone"}), "_-"]
    for _ in range(4000):
        data = "".join(rng.choices(parts, k=rng.randrange(1, 14))).encode()
        at = 0
        while True:
            want, got = plain.search(data, at), TOKEN.search(data, at)
            assert (want and want.span()) == (got and got.span())
            if not want:
                break
            at = data.index(b".", want.start()) + 1 if rng.random() < 0.7 else want.end()
