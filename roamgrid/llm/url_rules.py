"""URL filters: a rule list, and association rules mined from labelled URLs for the URLs that no listed rule fits.

A URL is a set of tokens: its scheme, its site, the words of the host labels before that and the hyphenated labels themselves, its path
segments (numbers as ``#``) and its query keys. FP-growth mines the token combinations of the labelled URLs; a combination of any size is a
rule if enough labelled URLs have it (support), enough of those are bad (confidence), and it is better than each rule inside it. Rules are
found through an inverted index: a rule is listed under its rarest token, a URL looks up its tokens there, and the
other tokens of the rule are then compared. All steps are DataFrame and SQL functions.

Joins of tables that grow are hinted to be sort-merge joins: Spark judges a written table by its compressed size, in which URLs and
tokens are many times smaller than in a broadcast.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roamgrid.session import broadcast_if_small, materialize

MIN_SUPPORT = 0.002
MIN_ROWS = 8
MIN_CONFIDENCE = 0.8
# Words in a host label that mark a URL as bad when labels are made.
SEED_WORDS = ("ads", "adult", "bets", "casino", "gambling", "malware", "phishing", "pills", "porn", "spam", "warez", "xxx")
# Fixed values of the rule list: host ending, path prefix, verdict.
LISTED = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
_BAD = "label:bad"
# Rules up to which the index is broadcast to the pages.
_BROADCAST_RULES = 50_000


def host_of(url: Column) -> Column:
    rest = F.substring_index(F.substring(url, F.instr(url, "://") + 3, F.length(url)), "#", 1)
    host = F.substring_index(F.substring_index(rest, "?", 1), "/", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.instr(url, "://") > 0, lower).otherwise("")


def path_of(url: Column) -> Column:
    rest = F.substring_index(F.substring_index(F.substring(url, F.instr(url, "://") + 3, F.length(url)), "#", 1), "?", 1)
    slash = F.instr(rest, "/")
    path = F.when(slash > 0, F.substring(rest, slash, F.length(rest))).otherwise("")
    return F.when(F.instr(url, "://") > 0, path).otherwise("")


def listed_rule(host: Column, path: Column, rules=LISTED) -> tuple[Column, Column]:
    """The longest rule that fits a host (itself or a subdomain) and the start of a path, as ``host`` + ``path``, and its verdict."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for ending, prefix, said in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):
        fits = ((host == ending) | host.endswith("." + ending)) & path.startswith(prefix)
        rule, verdict = F.when(fits, ending + prefix).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def _labels(host: Column) -> Column:
    """The labels of a host before its site, which is the last two."""
    names = F.filter(F.split(host, r"\."), lambda x: x != "")
    return F.slice(names, F.lit(1), F.greatest(F.lit(0), F.size(names) - 2))


def host_words(host: Column) -> Column:
    """The words of the labels of a host before its site, split at hyphens."""
    return F.filter(F.flatten(F.transform(_labels(host), lambda x: F.split(x, "-"))), lambda x: x != "")


def tokens(url: Column, host: Column, path: Column) -> Column:
    """The distinct tokens of a URL; none for a null one."""
    names = F.filter(F.split(host, r"\."), lambda x: x != "")
    cut = F.greatest(F.lit(0), F.size(names) - 2)
    site = F.array(F.concat(F.lit("site:"), F.concat_ws(".", F.slice(names, cut + 1, F.lit(2)))))
    labels = F.transform(F.filter(_labels(host), lambda x: x.contains("-")), lambda x: F.concat(F.lit("host:"), x))
    parts = F.transform(host_words(host), lambda x: F.concat(F.lit("word:"), x))
    segments = F.filter(F.split(path, "/"), lambda x: x != "")
    shaped = F.transform(segments, lambda x: F.concat(F.lit("path:"), F.regexp_replace(x, "[0-9]+", "#")))
    query = F.when(F.instr(url, "?") > 0, F.regexp_extract(url, r"\?([^#]*)", 1)).otherwise("")
    keys = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""),
                       lambda x: F.concat(F.lit("query:"), F.substring_index(x, "=", 1)))
    anchor = F.when(F.instr(url, "#") > 0, F.array(F.lit("anchor"))).otherwise(F.array().cast("array<string>"))
    scheme = F.array(F.concat(F.lit("scheme:"), F.lower(F.substring_index(url, "://", 1))))
    whole = F.array_distinct(F.concat(scheme, site, labels, parts, shaped, keys, anchor))
    return F.when((F.instr(url, "://") > 0) & (host != ""), whole).otherwise(F.array().cast("array<string>"))


def parsed(pages: DataFrame) -> DataFrame:
    """``page_id, host, path, rule, listed, tokens`` of every page; a null URL and one without ``://`` have empty parts."""
    url = F.col("url").cast("string")
    rows = pages.select("page_id", host_of(url).alias("h"), path_of(url).alias("p"), url.alias("url")).select(
        "page_id", F.coalesce("h", F.lit("")).alias("host"), F.coalesce("p", F.lit("")).alias("path"), "url")
    rule, verdict = listed_rule(F.col("host"), F.col("path"))
    return rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("listed"),
                       F.coalesce(tokens(F.col("url"), F.col("host"), F.col("path")), F.array().cast("array<string>")).alias("tokens"))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``rule_tokens, support, confidence`` of the rules "these tokens, hence bad" from ``tokens`` and ``bad`` (boolean) rows.

    The support of a rule is the number of bad rows with its tokens, at least ``min_support`` of all rows and ``MIN_ROWS``. A rule that
    contains a rule of at least its confidence is pruned.
    """
    rows = labelled.filter("size(tokens) > 0 and bad is not null")
    baskets = rows.select(F.when(F.col("bad"), F.array_append("tokens", F.lit(_BAD))).otherwise(F.col("tokens")).alias("items"))
    total = baskets.count()
    schema = "rule_tokens array<string>, support long, confidence double"
    if not total:
        return labelled.sparkSession.createDataFrame([], schema)
    least = max(MIN_ROWS, math.ceil(min_support * total))
    if least > total:
        return labelled.sparkSession.createDataFrame([], schema)
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, (least - 0.5) / total), minConfidence=min_confidence).fit(baskets)
    sets = materialize(model.freqItemsets.select(
        F.array_sort("items").alias("items"), F.col("freq").cast("long").alias("freq")), "itemsets")
    bad = sets.filter(F.array_contains("items", _BAD) & (F.size("items") > 1)).select(
        F.array_remove("items", _BAD).alias("rule_tokens"), F.col("freq").alias("support"))
    every = sets.filter(~F.array_contains("items", _BAD)).select(F.col("items").alias("rule_tokens"), F.col("freq").alias("seen"))
    rules = bad.join(every.hint("merge"), "rule_tokens").select("rule_tokens", "support", (F.col("support") / F.col("seen")).alias("confidence")).filter(
        F.col("confidence") >= min_confidence)
    rules = materialize(rules, "rules")
    # Rules inside a rule are found like rules inside a URL: by their rarest token.
    inside = _indexed(rules, rules.select(F.explode("rule_tokens").alias("token"))).select(
        "token", F.col("rule_tokens").alias("part"), F.col("confidence").alias("part_confidence"))
    asked = rules.select("rule_tokens", "confidence", F.explode("rule_tokens").alias("token"))
    worse = asked.join(inside.hint("merge"), "token").filter((F.size("part") < F.size("rule_tokens")) & (F.col("part_confidence") >= F.col("confidence"))
                                               & (F.size(F.array_except("part", "rule_tokens")) == 0))
    return rules.join(worse.select("rule_tokens").distinct().hint("merge"), "rule_tokens", "left_anti")


def _indexed(rules: DataFrame, found: DataFrame) -> DataFrame:
    """``token, rule_tokens, confidence``: every rule under the token of it that is rarest among the ``token`` rows of ``found``."""
    weights = found.groupBy("token").count()
    listed = materialize(rules.select(F.monotonically_increasing_id().alias("id"), "rule_tokens", "confidence"), "index")
    rarest = listed.select("id", F.explode("rule_tokens").alias("token")).join(weights.hint("merge"), "token").groupBy("id").agg(
        F.min(F.struct("count", "token")).alias("first"))
    return listed.join(rarest.hint("merge"), "id").select(F.col("first.token").alias("token"), "rule_tokens", "confidence")


def match(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """``page_id, confidence``: the best confidence of the rules whose tokens a page has, for pages with one."""
    index = materialize(_indexed(rules, rows.select(F.explode("tokens").alias("token"))), "rule_index")
    index, small = broadcast_if_small(index, _BROADCAST_RULES)
    asked = rows.select("page_id", "tokens", F.explode("tokens").alias("token"))
    hits = asked.join(index if small else index.hint("merge"), "token").filter(F.size(F.array_except("rule_tokens", "tokens")) == 0)
    return hits.groupBy("page_id").agg(F.max("confidence").alias("confidence"))


def judge(pages: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``page_id, host, path, rule, verdict, confidence`` of every page of ``page_id, url``.

    ``labels`` (``page_id, bad``) are the rows to learn from. A listed rule decides first. A page without one is blocked if a mined rule
    matches, and allowed otherwise. Null and malformed URLs have empty parts and no tokens, and are allowed. Repeated rows get equal
    results. Extra columns are ignored.
    """
    rows = materialize(parsed(pages), "urls")
    flags = labels.filter("page_id is not null").groupBy("page_id").agg(F.max("bad").alias("bad"))
    rules = mine(rows.join(flags.hint("merge"), "page_id").select("tokens", "bad"), **options)
    open_rows = rows.filter("listed is null and page_id is not null").dropDuplicates(["page_id", "tokens"])
    hits = match(open_rows.select(F.struct("page_id", "tokens").alias("page_id"), "tokens"), rules).select(
        "page_id.page_id", "page_id.tokens", "confidence")
    joined = rows.join(hits.withColumnsRenamed({"page_id": "_p", "tokens": "_t"}),
                       (F.col("page_id") == F.col("_p")) & (F.col("tokens") == F.col("_t")) & F.col("listed").isNull(), "left")
    verdict = F.coalesce("listed", F.when(F.col("confidence").isNotNull(), "block").otherwise("allow"))
    return joined.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "confidence")


def page_labels(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``page_id, bad`` from two sources: the given labels of the same number (bad: low quality or toxic), and the pages whose host
    has a word of ``SEED_WORDS``, which are bad."""
    given = labels.select(F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    words = host_words(host_of(F.col("url").cast("string")))
    seeds = pages.filter(F.arrays_overlap(words, F.array(*map(F.lit, SEED_WORDS)))).select("page_id", F.lit(True).alias("bad"))
    return given.unionByName(seeds)
