"""Secrets: fixed patterns, and strings whose sliding-window Shannon entropy is that of random keys.

A candidate is a run of at least ``WINDOW`` characters of base64 text. Its class is the narrowest alphabet that holds it, and every class
has a bound of its own, since random hexadecimal text has less entropy than random base64 text. The counts of characters in the
window are kept while it slides: a step changes two counts, so a candidate costs time linear in its length. Entropies are compared as
integer sums, so no error adds up over a long run. Windows above the bound are joined to spans; spans on the allow-list are dropped.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roamgrid.llm.shared import slices

KINDS = ("assign", "access", "hex", "entropy")
BASE_KINDS = KINDS[:3]
WINDOW = 20

# The base patterns.
_ASSIGN = re.compile(r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
_KEYWORDS = ("passw", "secret", "token", "api")

_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % WINDOW)
# Classes from narrow to wide: the characters, and the least entropy of a window in bits a character. Random windows of 20
# characters have 3.4, 3.8 and 4.0 bits on average; text without digits is no key, whatever its entropy.
CLASSES = (("hex", re.compile(r"[0-9a-f]+|[0-9A-F]+"), 3.0), ("one_case", re.compile(r"[0-9a-z]+|[0-9A-Z]+"), 3.5),
           ("mixed", re.compile(r"[A-Za-z0-9+/_=-]+"), 3.75))
LEAST_DIGITS, LEAST_LETTERS = 2, 2

# Strings that look random and are no secrets, by form, by a word they hold, by the label before them.
ALLOWED_FORMS = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
ALLOWED_WORDS = re.compile(r"example|sample|dummy|placeholder|changeme|redacted|0123456789|abcdef|xxxx", re.IGNORECASE)
ALLOWED_LABELS = re.compile(r"(?:sha-?(?:1|224|256|384|512)|md5|crc32|checksum|commit|etag|integrity|uuid)[\"']?\x20?[:=-]\x20?[\"']?\Z", re.IGNORECASE)
_LABEL_LENGTH = 24

# The sum over characters of n * log2(n) in millionths, by n; entropy is log2(window) less this sum over the window.
_PART = [0] + [round(n * math.log2(n) * 1e6) for n in range(1, WINDOW + 1)]


def _most(bits: float) -> int:
    """The largest sum of parts that a window of at least ``bits`` a character may have."""
    return math.floor((math.log2(WINDOW) - bits) * WINDOW * 1e6)


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the fixed patterns, by start and kind; offsets in code points, end exclusive."""
    if not text:
        return []
    spans = []
    folded = text.lower()
    if any(k in folded for k in _KEYWORDS):
        spans += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(spans)


def random_windows(run: str, bits: float) -> list[tuple[int, int]]:
    """The spans of ``run`` that are covered by windows of at least ``bits`` entropy with digits and letters."""
    most, counts, total, digits, letters = _most(bits), {}, 0, 0, 0
    found: list[tuple[int, int]] = []
    for at, new in enumerate(run):
        n = counts.get(new, 0)
        counts[new] = n + 1
        if at >= WINDOW:
            old = run[at - WINDOW]
            m = counts[old]
            counts[old] = m - 1
            if old != new:
                total += _PART[n + 1] - _PART[n] + _PART[m - 1] - _PART[m]
            digits -= old.isdigit()
            letters -= old.isalpha()
        else:
            total += _PART[n + 1] - _PART[n]
        digits += new.isdigit()
        letters += new.isalpha()
        if at >= WINDOW - 1 and total <= most and digits >= LEAST_DIGITS and letters >= LEAST_LETTERS:
            start = at - WINDOW + 1
            if found and start <= found[-1][1]:
                found[-1] = (found[-1][0], at + 1)
            else:
                found.append((start, at + 1))
    return found


def allowed(text: str, start: int, end: int) -> bool:
    """Whether the allow-list suppresses a span: its form, a word in it, or the label before it."""
    piece = text[start:end]
    return bool(ALLOWED_FORMS.search(piece) or ALLOWED_WORDS.search(piece)
                or ALLOWED_LABELS.search(text, max(0, start - _LABEL_LENGTH), start))


def added_spans(text: str | None, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of kind ``entropy`` by start, none of which overlaps one of ``base`` (which is sorted)."""
    out, at = [], 0
    for m in _CANDIDATE.finditer(text or ""):
        run = m[0]
        if sum(map(str.isdigit, run)) < LEAST_DIGITS:
            continue
        bits = next(least for _, form, least in CLASSES if form.fullmatch(run))
        for start, end in random_windows(run, bits):
            start, end = m.start() + start, m.start() + end
            # Base spans of different kinds may nest, so those that end early are only passed while none after them could reach.
            while at < len(base) and base[at][2] <= start:
                at += 1
            if not any(s < end and start < e for s, _, e in _reaching(base, at, end)) and not allowed(text, start, end):
                out.append((start, 3, end))
    return out


def _reaching(base: list[tuple[int, int, int]], at: int, end: int) -> Iterator[tuple[int, int, int]]:
    while at < len(base) and base[at][0] < end:
        yield base[at]
        at += 1


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, n_entropy, base_sha256, spans`` of every row.

    Counts and digest are of the pattern matches, ``spans`` holds the added ones too. A null or empty text has none. Repeated rows
    get equal results, ids may be null, and extra columns of the input are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts: list[list[int]] = [[] for _ in KINDS]
            digests, spans = [], []
            for text in batch.column("text").to_pylist():
                base = base_spans(text)
                every = sorted(base + added_spans(text, base))
                for k, column in enumerate(counts):
                    column.append(sum(kind == k for _, kind, _ in every))
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined(every))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()),
                 pa.array(spans, pa.string())], names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {counts}, base_sha256 string, spans string")
