import hashlib
import math
import random
import re
import string
from collections import Counter

import edges
from roamgrid.llm import secret_entropy as S

PLAIN = (("assign", re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 8),
         ("access", re.compile("AKIA[A-Z0-9]+"), 16), ("hex", re.compile("[0-9a-f]+"), 32))


def plain_base(text):
    out = []
    for k, (name, pattern, least) in enumerate(PLAIN):
        out += [(m.start(), k, m.end()) for m in pattern.finditer(text) if len(m[2] if name == "assign" else m[0]) >= least]
    return sorted(out)


def plain_windows(run, bits):
    covered = set()
    for i in range(len(run) - S.WINDOW + 1):
        w = run[i:i + S.WINDOW]
        entropy = -sum(c / S.WINDOW * math.log2(c / S.WINDOW) for c in Counter(w).values())
        if entropy >= bits - 1e-6 and sum(c.isdigit() for c in w) >= 2 and sum(c.isalpha() for c in w) >= 2:
            covered |= set(range(i, i + S.WINDOW))
    return covered


def texts(seed, n=400):
    rng = random.Random(seed)
    pieces = ["token", "TOKEN", "paſſword", "secret", "api_key", "ApiKey", "passwd", "=", ":", " ", "  ", '"', "'", "AKIA", "AKIAQ7", "é", "K", "\n",
              "abcd", "0f", "deadbeef", "9", "Z", "/", ".", "x" * 30]
    for _ in range(n):
        yield "".join(rng.choice(pieces) if rng.random() < 0.8 else "".join(rng.choices(string.hexdigits[:16], k=rng.randrange(1, 40)))
                      for _ in range(rng.randrange(1, 40)))


def key(rng, alphabet, n=32):
    return "".join(rng.choices(alphabet, k=n))


def test_base_spans_are_those_of_the_plain_patterns():
    for text in texts(1):
        assert S.base_spans(text) == plain_base(text), text


def test_windows_are_those_of_the_definition():
    rng = random.Random(2)
    for i in range(200):
        run = key(rng, string.ascii_letters[: rng.randrange(3, 52)] + "0123456789", rng.randrange(20, 120))
        for bits in (3.0, 3.5, 3.75):
            got = {i for s, e in S.random_windows(run, bits) for i in range(s, e)}
            assert got == plain_windows(run, bits)


def test_random_keys_are_found_and_words_are_left():
    rng = random.Random(3)
    for alphabet in (string.ascii_letters + string.digits, string.ascii_lowercase + string.digits):
        hits = sum(bool(S.added_spans(f"the key is {key(rng, alphabet)} here", [])) for _ in range(200))
        assert hits >= 190
    for text in ("Donaudampfschifffahrtsgesellschaftskapitaen", "someVeryLongCamelCaseIdentifierName", "1234567890" * 5, "=" * 60, "-" * 80,
                 "src/main/java/org/sample/library/Version2", "a" * 10_000, "aaaa1111bbbb2222" * 20):
        assert S.added_spans(text, []) == []


def test_allow_list_and_overlap_with_base_spans():
    rng = random.Random(4)
    secret = key(rng, string.ascii_letters + string.digits, 40)
    assert S.added_spans(secret, []) and S.added_spans(f"see {secret} end", [])[0][1] == 3
    assert not S.added_spans(f"integrity: {secret}", [])
    assert not S.added_spans(f"id 123e4567-e89b-12d3-a456-426614174000", [])
    assert not S.added_spans("EXAMPLE" + secret[:12] + "example9f3Qz", [])
    text = f"token = {secret} and {secret}"
    base = S.base_spans(text)
    assert len(base) == 1 and len(S.added_spans(text, base)) == 1


def test_scan(spark):
    rng = random.Random(5)
    secret = key(rng, string.ascii_letters + string.digits, 40)
    rows = edges.document_rows() + [(20, f"é token: '{secret}' AKIA{'Q7' * 8} {'0f' * 20} {secret}", "en", "a", 0, 0.5, "k", "c"),
                                    (20, f"é token: '{secret}' AKIA{'Q7' * 8} {'0f' * 20} {secret}", "en", "a", 0, 0.5, "k", "c")]
    docs = edges.documents(spark, rows)
    got = edges.by_id(S.scan(docs))
    assert sum(map(len, got.values())) == len(rows)
    r = got[20][0]
    assert got[20][1] == r and (r["n_assign"], r["n_access"], r["n_hex"], r["n_entropy"]) == (1, 1, 1, 1)
    assert r["spans"].startswith("assign:2:") and r["spans"].split(",")[-1].startswith("entropy:")
    base = ",".join(x for x in r["spans"].split(",") if not x.startswith("entropy"))
    assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
    assert got[4][0]["base_sha256"] == hashlib.sha256(b"").hexdigest() and got[4][0]["spans"] == ""
    assert S.scan(edges.documents(spark, [])).count() == 0
