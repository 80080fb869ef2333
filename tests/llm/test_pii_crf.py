import itertools
import random
import re
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from edges import by_id, documents, many  # noqa: E402
from roamgrid.llm import pii_crf  # noqa: E402


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1])) % 10 == 0


def plain(text):
    """The patterns as they are written down."""
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for kind, pattern in ((2, r"[0-9]([\x20-]?[0-9])+"), (3, r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits) if kind == 2 else 9 <= len(digits) <= 15:
                out.append((kind, *m.span()))
    return out


def test_patterns_on_random_texts():
    rng = random.Random(3)
    parts = ["1", "2", "0", ".", "@", "a", "-", "+", " ", "(", ")", "25", "4111111111111111", "b.c", "%", "é", "\n"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        assert pii_crf.base_spans(text) == plain(text), text


def test_long_runs_take_linear_time():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "@" * 100_000, "+1" * 50_000):
        assert pii_crf.base_spans(text) == ([(1, i, i + 7) for i in range(0, 200_000, 8)] if text[:2] == "1." else [])


@pytest.fixture(scope="module")
def model():
    rng, windows = random.Random(1), []
    for i in range(120):
        text = f"call +1 ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)} or write ann.{i}@mail{i % 7}.example.com now"
        words, tags = pii_crf._tagged(text)
        windows += [(words, tags), *pii_crf._variants(words, tags), (["nothing", "here", "to", "see"], [0, 0, 0, 0])]
    return pii_crf.fit(windows)


def test_decoding_is_exact(model):
    rng = np.random.default_rng(0)
    for _ in range(40):
        codes = rng.integers(0, len(model.shapes), 4)
        ways = list(itertools.product(range(len(pii_crf.TAGS)), repeat=4))
        pad = np.concatenate([[-1], codes, [-1]])
        scores = model.own[codes] + model.before[pad[:4]] + model.after[pad[2:]]

        def value(tags):
            path = (0, *tags, 0)
            return sum(scores[i, t] for i, t in enumerate(tags)) + sum(model.steps[a, b] for a, b in zip(path, path[1:]))

        # Outside the text counts as a neighbour that is outside; every text is decoded between borders.
        best = max(ways, key=value)
        got = model.decode(np.concatenate([[-1], codes, [-1]]))[1:-1]
        assert value(tuple(got)) == pytest.approx(value(best))


def test_field_finds_what_the_patterns_miss(model):
    finder = pii_crf.Finder(model)
    (_, phone), (_, none), (base, _) = finder.find(["ring (523) 555-1055 today", "just some words", "a@b.example"])
    assert phone == [(3, 5, 19)] and none == [] and base == [(0, 0, 11)]
    assert pii_crf.masked("ring (523) 555-1055 today", phone) == "ring <phone> today"


def test_spans_and_mask_of_awkward_rows(spark, model):
    docs = documents(spark)
    got = by_id(pii_crf.spans(docs, model))
    assert [got[12][0][f"n_{k}"] for k in pii_crf.KINDS] == [1, 1, 1, 1]
    assert got[4][0]["spans"] == "" and got[11][0] == got[11][1]
    masked = pii_crf.mask(docs, model)
    assert masked.columns == docs.columns and masked.count() == docs.count()
    texts = by_id(masked)
    assert texts[12][0]["text"] == "mail <email> and <phone>, <ip> é <card>" and texts[4][0]["text"] is None
    assert texts[5][0]["text"] == "" and texts[9][0]["text"] == by_id(docs)[9][0]["text"]


def test_empty_and_unlabelled_tables(spark):
    empty = documents(spark, [])
    assert pii_crf.spans(empty, pii_crf.train(empty)).count() == 0
    quiet = many(spark, ["no data here"] * 5)
    assert pii_crf.spans(quiet, pii_crf.train(quiet)).filter("spans <> ''").count() == 0


def test_spelled_out_addresses_without_digits(spark):
    texts = [f"call +1 ({100 + i}) 555-{1000 + i} or write ann.{i}@mail{i % 7}.example.com now" for i in range(40)]
    new = {"write jane.doe [at] mail.example.com today": "write <email> today", "ann (at) example.org": "<email>",
           "ask ann (at) example.org, or o'neil [AT] my-host.example.org.": "ask <email>, or <email>.",
           "he was (at) home today": "he was (at) home today", "see foo (or) bar.com": "see foo (or) bar.com"}
    docs = many(spark, texts + list(new))
    field = pii_crf.train(docs)
    got, texts = by_id(pii_crf.spans(docs, field)), by_id(pii_crf.mask(docs, field))
    for i, (text, masked) in enumerate(new.items(), 40):
        assert texts[i][0]["text"] == masked
        assert got[i][0]["added"] == masked.count("<email>") and got[i][0]["n_email"] == 0
    assert got[40][0]["spans"] == "email:6:36" and got[41][0]["spans"] == "email:0:20"
