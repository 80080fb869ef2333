import hashlib
import heapq
import random
import re

import pytest

from compare import connect, differences
from roamgrid.llm import queries
from roamgrid.llm import repair_dawg as R

ROLES = {"u": "user", "a": "assistant"}


def plain_repair(letters):
    """Uniform-cost search over edits: every edit of every turn, and up to three insertions of either role at any place."""
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, audit, at, roles = heapq.heappop(heap)
        if at == len(letters) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit
        if (audit, at, roles) in seen or not re.fullmatch("(s?(ua)*u?)?", roles):
            continue
        seen.add((audit, at, roles))
        for role in "ua":
            heapq.heappush(heap, (cost + 2, audit + "I", at, roles + role))
        if at < len(letters):
            x = letters[at]
            heapq.heappush(heap, (cost + 3, audit + "D", at + 1, roles))
            if x != "x":
                heapq.heappush(heap, (cost + x.isupper(), audit + "K", at + 1, roles + x.lower()))
                for role in "ua":
                    heapq.heappush(heap, (cost + 2 + x.isupper(), audit + "R", at + 1, roles + role))


def signature(rng, n):
    return "".join(rng.choice("uuuaaasoxUAS") for _ in range(n))


def test_edits_are_the_cheapest_and_least():
    rng = random.Random(1)
    for _ in range(150):
        letters = signature(rng, rng.randrange(0, 6))
        assert R.best_edits(letters) == plain_repair(letters), letters


def test_common_suffixes_share_their_nodes():
    rng = random.Random(2)
    letters = sorted({signature(rng, rng.randrange(1, 12)) for _ in range(300)}, key=lambda x: x[::-1])
    path = R.Suffixes(R.Automaton())
    for x in letters:
        path.insert(x, R.END)
        audit, state = path.audit(0)
        assert (path.cost(0), audit + R._CLOSE[state]) == R.best_edits(x)
    # One node for each different suffix, however many signatures end in it.
    assert path.made == len({x[i:] for x in letters for i in range(len(x))}) and len(path.automaton) < 150


def plain_damage(rows):
    import zlib
    for conv, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(key.encode()) % 20
        if kind:
            new = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            yield from [(conv, turn, "user" if kind == 4 else role, new)] * (2 if kind == 3 else 1)


def plain_report(rows):
    """Each conversation in plain Python, as the contract words it."""
    out = {conv: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for conv, *_ in rows}
    by = {}
    for row in plain_damage(rows):
        by.setdefault(row[0], []).append(row[1:])
    for conv, turns in by.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
        known = {t for t, *_ in turns if t is not None}
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        letters, seen, faults, inverse = "", set(), [0, 0, 0], []
        for _, role, text in turns:
            body = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else None
            seen.add((role, text))
            initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
            if fault is not None:
                faults[fault] += 1
            letters += "x" if fault in (0, 1) else initial.upper() if fault == 2 else initial
        initials = [role[:1] for _, role, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = R.best_edits(letters)
        left, lines = iter(turns), []
        total = len(audit) - audit.count("D")
        for edit in audit:
            role, text = ("", "") if edit == "I" else next(left)[1:]
            if edit != "D":
                made = "user" if (len(lines) + total) % 2 == 0 else "assistant"
                lines.append(f"{role if edit == 'K' else made}:{text}")
        out[conv] = (gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, conv string")


def awkward_rows():
    rng = random.Random(3)
    texts = ["One.", "Two", "", " \n", None, "Three! \t", "é?", "Word. more", "One."]
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant"]
    rows = [(c, t, rng.choice(roles), rng.choice(texts)) for c in range(40) for t in range(rng.randrange(0, 9))]
    rows += [(100, None, "user", "Null turn."), (100, None, "assistant", "Second null."), (100, 5, "user", "z" * 30_000), (100, 9, "user", None),
             (None, 1, "user", "No id."), (None, 2, "assistant", "No id"), (101, 1, "user", "Tie."), (101, 1, "user", "Tie."), (101, 1, "assistant", "Tie.")]
    return rows + [(200, t, "user" if t % 3 else "assistant", f"Long {t % 50}." if t % 7 else f"cut {t}") for t in range(700)]


@pytest.mark.parametrize("segment", [1024, 8])
def test_report_is_that_of_the_contract(spark, segment):
    rows = awkward_rows()
    expected = plain_report(rows)
    got = R.damage_and_repair(conversations(spark, rows), segment).collect()
    assert len(got) == len(expected)
    for r in got:
        assert tuple(r)[1:] == expected[r["conv_id"]], r["conv_id"]


def test_empty_table_and_repaired_turns(spark):
    assert R.damage_and_repair(conversations(spark, []).limit(0)).count() == 0
    rows = [(1, 0, "assistant", "Hi."), (1, 1, "user", "Q?"), (1, 2, "user", "Q?"), (1, 3, "assistant", "A")]
    turns = R.Repair(conversations(spark, rows)).turns.orderBy("out").collect()
    assert [(r["role"], r["text"]) for r in turns] == [
        ("user", ""), ("assistant", "Hi."), ("user", "Q?"), ("assistant", "A")]


def test_sql(spark):
    sf = "/root/testdata/sf0.01"
    name = "op12_repair_dawg"
    assert differences(queries.QUERIES[name](spark, sf), connect(sf), queries.ORACLES[name]) is None
