import hashlib
import math
import random
import re
import zlib

import pytest

from compare import connect, differences
from roamgrid.llm import prefix_trie as P
from roamgrid.llm import queries


def plain_trie(rows):
    """The trie built turn by turn from rebuilt conversations, as the contract words it."""
    stored = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            stored.setdefault(conv, []).append((turn is not None, turn or 0, role or "", hashlib.sha256(
                f"{len(role or '')}:{role or ''}:{text or ''}".encode()).hexdigest(), text or ""))
    turns = {c: [(r, t) for *_, r, _, t in sorted(v)] for c, v in stored.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(math.fmod(c, 20))  # the remainder of SQL has the sign of the id
        rebuilt[c] = tuple(turns.get(base, [])[:h] + own[h:])
    members = {}
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    out = []
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        leaf = [p for p in below if not any(q[:-1] == p for q in below if q)]
        ends = ",".join(str(c) for c in sorted(convs) if rebuilt[c] == path)
        saved = sum((len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in below if p)
        out.append((min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs),
                    sum(len(p) == len(path) + 1 for p in below), len(leaf), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(spark, rows):
    return spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, depth int")


def awkward_rows():
    rng = random.Random(1)
    texts = ["Same start.", "Two words", "", None, " \n", "é è", "x " * 500, "Other"]
    rows = [(c, t, rng.choice(["user", "assistant", None, ""]), rng.choice(texts)) for c in range(-45, 85) for t in range(rng.randrange(1, 5))
            if c % 20 != 0 or c % 40 == 0]
    rows += [(c, t, "user", f"shared {t}") for c in (101, 102, 103, 104, 105) for t in range(4)]
    rows += [(200, None, "a", "b"), (200, None, "ab", ""), (200, None, "a", "b"), (None, 1, "user", "no id"), (9_000_000_000_000, 3, "user", "far")]
    # One word against role and text that read alike when put together.
    rows += [(301, 0, "u", "ser x"), (302, 0, "user", " x"), (303, 0, "use", "r x")]
    return rows + [(c, t, "user", f"long {t}") for c in (400, 401, 402, 407) for t in range(100 + c % 3)]


@pytest.mark.parametrize("block", [1024, 7])
def test_trie_is_that_of_the_contract(spark, block):
    rows = awkward_rows()
    got = sorted(map(tuple, P.prefix_trie(conversations(spark, rows), block=block).collect()), key=str)
    assert got == plain_trie(rows)


def test_values_of_prefixes_combine(spark):
    rows = [(1, t, "user", f"t{t}") for t in range(2100)] + [(2, t, "user", f"t{t}") for t in range(2100)]
    found = P.fingerprinted(P.stored_turns(conversations(spark, rows))).collect()
    for lane in range(4):
        prime, base, value = P.PRIMES[lane], P.BASES[lane], 0
        for r in sorted((r for r in found if r["conv_id"] == 1), key=lambda r: r["at"]):
            code = int(r["print"].hex()[8 * lane: 8 * lane + 8], 16)
            value = (value + code * pow(base, r["at"], prime)) % prime
            assert r["s"][lane] == value


def test_no_rows(spark):
    assert P.prefix_trie(conversations(spark, [(None, 1, "user", "x")])).count() == 0


def test_sql(spark):
    sf, name = "/root/testdata/sf0.01", "op11_prefix_trie"
    assert differences(queries.QUERIES[name](spark, sf), connect(sf), queries.ORACLES[name]) is None
