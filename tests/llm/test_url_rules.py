import itertools
import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
from conftest import plan_of  # noqa: E402
from roamgrid.llm import url_rules  # noqa: E402


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    for cut in "?#":
        rest = rest.split(cut, 1)[0]
    host, slash, path = rest.partition("/")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), slash + path


def listed(host, path):
    fits = [(len(h) + len(p), h + p, v) for h, p, v in url_rules.LISTED if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


URLS = ["http://a.example.net/en/1", "https://EXAMPLE.net/x", "http://example.net", "http://net/", "http://example.com/de/3?x=/de/", "http://xnet/",
        "http://b.example.org/fr/9#top", "org/fr/", "ftp://É.org/fr/ü", "http://example.com?q=1/de/", "http://h#a/b", "://", "", None, "http://",
        "a://b://c/d", "http://example.com/DE/", "http://sub.example.net/en", "http://x.net/?a=b&c", "http://a-b.casino-win.example.com//x//?=&&"]


def test_parts_and_listed_rules(spark):
    rows = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    got = {r["page_id"]: r for r in url_rules.parsed(rows).collect()}
    for i, url in enumerate(URLS):
        host, path = parts(url)
        assert (got[i]["host"], got[i]["path"]) == (host, path), url
        assert (got[i]["rule"], got[i]["listed"]) == listed(host, path), url
    assert got[URLS.index("org/fr/")]["tokens"] == [] and got[URLS.index(None)]["tokens"] == []
    assert "word:b" in got[URLS.index("http://b.example.org/fr/9#top")]["tokens"]
    assert {"word:casino", "word:b", "host:a-b", "site:example.com", "path:x"} <= set(got[len(URLS) - 1]["tokens"])


@pytest.fixture(scope="module")
def baskets():
    rng = random.Random(1)
    out = []
    for _ in range(400):
        own = {t for t in "abcdefg" if rng.random() < 0.4}
        bad = {"a", "b"} <= own or ("c" in own and rng.random() < 0.5) or {"d", "e", "f", "g"} <= own
        out.append((sorted(own), bad))
    return out


def mined(baskets, support, confidence, most=7):
    least, found = max(url_rules.MIN_ROWS, -(-support * len(baskets) // 1)), {}
    for n in range(1, most + 1):
        for combo in itertools.combinations("abcdefg", n):
            rows = [bad for own, bad in baskets if set(combo) <= set(own)]
            if sum(rows) >= least and sum(rows) >= confidence * len(rows):
                found[combo] = (sum(rows), sum(rows) / len(rows))
    return {c: v for c, v in found.items()
            if not any(p in found and found[p][1] >= v[1] for n in range(1, len(c)) for p in itertools.combinations(c, n))}


@pytest.mark.parametrize("support,confidence", [(0.02, 0.8), (0.05, 0.5)])
def test_mined_rules_against_all_combinations(spark, baskets, support, confidence):
    rows = spark.createDataFrame([(own, bad) for own, bad in baskets if own], "tokens array<string>, bad boolean")
    got = {tuple(r["rule_tokens"]): (r["support"], pytest.approx(r["confidence"])) for r in url_rules.mine(rows, support, confidence).collect()}
    assert got == mined([b for b in baskets if b[0]], support, confidence)
    if support < 0.05:
        assert ("d", "e", "f", "g") in got  # no bound on the tokens of a rule


def test_matching_through_the_index(spark, baskets):
    rules = mined(baskets, 0.02, 0.5)
    frame = spark.createDataFrame([(list(c), s, f) for c, (s, f) in rules.items()], "rule_tokens array<string>, support long, confidence double")
    pages = spark.createDataFrame([(i, own) for i, (own, _) in enumerate(baskets)], "page_id long, tokens array<string>")
    want = {i: max(f for c, (_, f) in rules.items() if set(c) <= set(own)) for i, (own, _) in enumerate(baskets)
            if any(set(c) <= set(own) for c in rules)}
    assert {r["page_id"]: r["confidence"] for r in url_rules.match(pages, frame).collect()} == pytest.approx(want)


def test_judge(spark):
    urls = [(i, f"http://{'www' if i % 2 else 'm'}.{'casino-win' if i % 4 == 0 else 'plain'}.example.com/en/{i}", "x") for i in range(80)]
    urls += [(1000 + i, u, "x") for i, u in enumerate(URLS)] + [(None, "http://casino-win.example.com/en/1", "x"), (3, urls[3][1], "x")]
    pages = spark.createDataFrame(urls, "page_id long, url string, verdict string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 80, 3) if i % 4] + [(None, 0, 0), (2, None, None)], "doc_id long, quality int, toxic int")
    rows = url_rules.judge(pages, url_rules.page_labels(pages, labels)).collect()
    assert len(rows) == len(urls)
    for r in rows:
        if r["page_id"] is not None and r["page_id"] < 80:
            assert r["verdict"] == ("block" if r["page_id"] % 4 == 0 else "allow")
        elif r["page_id"] is not None and r["rule"]:
            assert r["verdict"] == listed(r["host"], r["path"])[1]
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert url_rules.judge(pages.limit(0), url_rules.page_labels(pages.limit(0), none)).count() == 0
    plain = pages.filter("url not like '%casino%'")
    assert plain.count() == url_rules.judge(plain, url_rules.page_labels(plain, none)).count()


def test_words_of_every_label_count(spark):
    urls = [(i, f"http://{'casino' if i % 4 == 0 else 'plain'}.example.com/en/{i}") for i in range(80)]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(1, 80, 4)], "doc_id long, quality int, toxic int")
    rows = url_rules.judge(pages, url_rules.page_labels(pages, labels)).collect()
    assert {r["page_id"] for r in rows if r["verdict"] == "block"} == set(range(0, 80, 4))


def test_no_table_that_grows_is_broadcast(spark, baskets, monkeypatch):
    urls = [(i, f"http://{'casino' if i % 4 == 0 else 'plain'}.example.com/en/{i}") for i in range(80)]
    pages, seen = spark.createDataFrame(urls, "page_id long, url string"), []
    labels = spark.createDataFrame([(i, 1, 0) for i in range(1, 80, 4)], "doc_id long, quality int, toxic int")
    mine = url_rules.mine
    monkeypatch.setattr(url_rules, "mine", lambda labelled, **options: (seen.append(plan_of(labelled)), mine(labelled, **options))[1])
    url_rules.judge(pages, url_rules.page_labels(pages, labels))
    assert "Broadcast" not in seen[0]
    frame = spark.createDataFrame([(["a", "b"], 9, 0.9), (["c"], 9, 0.8)], "rule_tokens array<string>, support long, confidence double")
    rows = spark.createDataFrame([(i, own) for i, (own, _) in enumerate(baskets)], "page_id long, tokens array<string>")
    got = []
    for bound in (50_000, 1):
        monkeypatch.setattr(url_rules, "_BROADCAST_RULES", bound)
        hits = url_rules.match(rows, frame)
        got.append(sorted(map(tuple, hits.collect())))
        assert ("BroadcastExchange" in plan_of(hits)) == (bound > 1)
    assert got[0] == got[1] and got[0]
