"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes that adds what they miss.

The labelled table is small: windows of words around the pattern matches of at most ``max_docs`` documents, tagged by the patterns,
plus the same windows written in ways the patterns do not cover (a phone number without its country code, a
spelled-out e-mail address, a card number with dots). The field is fitted with forward-backward in numpy. Decoding is
exact Viterbi: a word whose score for "outside" is ahead by more than any change of transitions could win back is
outside in the best path, so such words cut a text into short runs, and runs of one length are decoded as one batch.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roamgrid.llm.shared import slices

KINDS = ("email", "ip", "card", "phone")
TAGS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only start where a run of digits starts, and a run is taken whole: possessive, so linear in the text.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"\S+")
_AT = re.compile(r"@|\[at\]|\(at\)", re.IGNORECASE)


def _luhn(digits: str) -> bool:
    total = 0
    for at, d in enumerate(reversed(digits)):
        value = int(d) * (1 + at % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Every ``@`` with the longest run of local characters before it; a failing one consumes nothing."""
    out, end, last = [], 0, -1
    at = text.find("@")
    while at >= 0:
        before = text[max(end, last + 1): at]
        start = max(end, last + 1) + len(before.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
            end = domain.end()
        last = at
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` of the fixed patterns, by kind and start; offsets in code points, end exclusive."""
    if not text:
        return []
    spans = [(0, s, e) for s, e in _emails(text)]
    spans += [(1, m.start(), m.end()) for m in _IP.finditer(text)
              if all(len(p := g.lstrip("0")) <= 3 and int(p or 0) <= 255 for g in m.groups())]
    for kind, pattern, least, most in ((2, _CARD, 13, 19), (3, _PHONE, 9, 15)):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if least <= len(digits) <= most and (kind == 3 or _luhn(digits)):
                spans.append((kind, m.start(), m.end()))
    return spans


def shape(word: str) -> str:
    """A run of letters becomes ``x`` and a run of digits ``0`` with its length; other characters stay."""
    return re.sub(r"[0-9]+", lambda m: f"0{min(len(m[0]), 9)}", re.sub(r"[^\W\d_]+", "x", word))


@dataclass
class Field:
    """Weights of the field: a row per known shape, for the word itself, the word before and the word after."""

    shapes: dict[str, int]
    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    steps: np.ndarray

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """The best tags of words given by their shapes; -1 stands between texts, for the border of a text, and is outside."""
        # The most that tag k between any neighbours can gain by transitions over "outside" in its place.
        gain = (self.steps[:, :, None] + self.steps[None, :, :]) - (self.steps[:, :1, None] + self.steps[None, :1, :])
        bound = gain.max(axis=(0, 2))[1:]
        open_words = np.zeros(len(codes), dtype=bool)
        # Most words are plain letters between plain letters: if that is surely outside, only the others are scored.
        plain = self.shapes.get("x", 0)
        known = self.own[plain] + self.before[plain] + self.after[plain]
        pad = np.concatenate([[-1], codes, [-1]])
        if (known[0] - known[1:] > bound).all():
            odd = pad != plain
            at = np.flatnonzero((odd[1:-1] | odd[:-2] | odd[2:]) & (codes >= 0))
        else:
            at = np.flatnonzero(codes >= 0)
        some = self.own[pad[at + 1]] + self.before[pad[at]] + self.after[pad[at + 2]]
        open_words[at] = (some[:, :1] - some[:, 1:] <= bound).any(axis=1)
        scores = np.zeros((len(codes), len(TAGS)))
        scores[at] = some
        tags = np.zeros(len(codes), dtype=np.int64)
        edges = np.diff(np.concatenate([[0], open_words.view(np.int8), [0]]))
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        # Runs are filled up with words that are surely outside, so that few lengths occur.
        sure = np.zeros((1, len(TAGS)))
        sure[0, 1:] = -1e6
        scores = np.concatenate([scores, sure])
        tags = np.concatenate([tags, [0]])
        spare = len(codes)
        size = 2 ** np.ceil(np.log2(np.maximum(ends - starts, 1))).astype(np.int64)
        for length in np.unique(size):
            own = size == length
            for part in np.array_split(np.flatnonzero(own), -(-int(own.sum()) * int(length) // 50_000)):
                at = starts[part][:, None] + np.arange(length)
                at = np.where(at < ends[part][:, None], at, spare)
                tags[at] = self._viterbi(scores[at])
        tags = tags[:spare]
        return tags

    def _viterbi(self, scores: np.ndarray) -> np.ndarray:
        """Best tags of runs ``(run, word, tag)`` whose neighbours are outside."""
        runs, length, _ = scores.shape
        best, back = scores[:, 0] + self.steps[0], np.zeros(scores.shape, dtype=np.int8)
        for t in range(1, length):
            ways = best[:, :, None] + self.steps
            back[:, t] = ways.argmax(axis=1)
            best = ways.max(axis=1) + scores[:, t]
        tags = np.zeros((runs, length), dtype=np.int64)
        tags[:, -1] = (best + self.steps[:, 0]).argmax(axis=1)
        for t in range(length - 1, 0, -1):
            tags[:, t - 1] = back[np.arange(runs), t, tags[:, t]]
        return tags


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def fit(windows: list[tuple[list[str], list[int]]], epochs: int = 60, rate: float = 0.25, l2: float = 1e-4) -> Field:
    """Maximise the conditional likelihood of the tags of ``(words, tags)`` windows; without windows all words are outside."""
    size = len(TAGS)
    shapes: dict[str, int] = {"": 0, "?0": 1}
    codes = [[shapes.setdefault(shape(w), len(shapes)) for w in words] for words, _ in windows]
    # Row 0 stands for unknown shapes without a digit, row 1 for those with one, the last one (-1) for the border of a text.
    weights = {n: np.zeros((len(shapes) + 1, size)) for n in ("own", "before", "after")} | {"steps": np.zeros((size, size))}
    if not windows:
        weights["own"][:, 0] = 40.0
        return Field(shapes, **weights)
    length = max(len(w) for w, _ in windows)
    c = np.full((len(windows), length + 2), -1)
    y, mask = np.zeros((len(windows), length), dtype=np.int64), np.zeros((len(windows), length), dtype=bool)
    for i, (own, (_, tags)) in enumerate(zip(codes, windows)):
        c[i, 1: len(own) + 1], y[i, : len(own)], mask[i, : len(own)] = own, tags, True
    one_hot = np.eye(size)[y] * mask[..., None]
    seen_steps = np.zeros((size, size))
    inner = mask[:, 1:]
    np.add.at(seen_steps, (y[:, :-1][inner], y[:, 1:][inner]), 1)
    moments = {n: (np.zeros_like(w), np.zeros_like(w)) for n, w in weights.items()}
    for epoch in range(1, epochs + 1):
        s = weights["own"][c[:, 1:-1]] + weights["before"][c[:, :-2]] + weights["after"][c[:, 2:]]
        forward, backward = np.zeros_like(s), np.zeros_like(s)
        forward[:, 0] = s[:, 0]
        for t in range(1, length):
            new = s[:, t] + _logsumexp(forward[:, t - 1, :, None] + weights["steps"], 1)
            forward[:, t] = np.where(mask[:, t, None], new, forward[:, t - 1])
        for t in range(length - 2, -1, -1):
            new = _logsumexp(weights["steps"] + (s[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(mask[:, t + 1, None], new, 0)
        total = _logsumexp(forward[:, -1], 1)
        p = np.exp(forward + backward - total[:, None, None]) * mask[..., None]
        expected = np.zeros((size, size))
        for t in range(1, length):
            ways = (forward[:, t - 1, :, None] + weights["steps"] + (s[:, t] + backward[:, t])[:, None, :]
                    - total[:, None, None])
            expected += np.exp(ways[mask[:, t]]).sum(0)
        miss = (one_hot - p) / len(windows)
        grads = {"steps": (seen_steps - expected) / len(windows)}
        for name, at in (("own", c[:, 1:-1]), ("before", c[:, :-2]), ("after", c[:, 2:])):
            grads[name] = np.zeros_like(weights[name])
            np.add.at(grads[name], at.ravel(), miss.reshape(-1, size))
        for name, w in weights.items():
            g, (first, second) = grads[name] - l2 * w, moments[name]
            first += 0.1 * (g - first)
            second += 0.01 * (g * g - second)
            w += rate * (first / (1 - 0.9**epoch)) / (np.sqrt(second / (1 - 0.99**epoch)) + 1e-8)
    # An unknown shape is surely outside without a digit; with one it is outside unless its neighbours say otherwise.
    weights["own"][:2] = 0
    weights["own"][0, 0] = 10 * sum(np.abs(w).max() for w in weights.values())
    weights["own"][1, 0] = 3.0
    return Field(shapes, **weights)


def _tagged(text: str) -> tuple[list[str], list[int]]:
    """Words and tags of a text, by its pattern matches (the earlier kind wins where two overlap)."""
    words, tags, inside = [], [], {}
    spans = sorted(base_spans(text), key=lambda x: x[1])
    for m in _WORD.finditer(text):
        while spans and spans[0][2] <= m.start():
            spans.pop(0)
        tag = 0
        if spans and spans[0][1] < m.end():
            kind = spans[0][0]
            tag = 2 + 2 * kind if inside.get(spans[0]) else 1 + 2 * kind
            inside[spans[0]] = True
        words.append(m[0])
        tags.append(tag)
    return words, tags


_NAMES = ("ann", "jane.doe", "jane_doe", "jane-doe")
_HOSTS = tuple(host + end for end in ("", ".", ",") for host in ("example.org", "mail.example.com", "my-host.example.org"))


def _variants(words: list[str], tags: list[int]) -> Iterator[tuple[list[str], list[int]]]:
    """The window in other spellings; only for whole matches inside it."""
    phone, email, card = 7, 1, 5
    for i, tag in enumerate(tags):
        follows = tags[i + 1] if i + 1 < len(tags) else 0
        if tag == phone and follows == phone + 1 and words[i].startswith("+"):
            rest = tags[i + 1:]
            yield words[:i] + words[i + 1:], tags[:i] + [phone] + rest[1:]
        if tag == email and follows == 0 and words[i].count("@") == 1:
            name, host = words[i].split("@")
            yield words[:i] + [name, "[at]", host] + words[i + 1:], tags[:i] + [1, 2, 2] + tags[i + 1:]
            yield words[:i] + [name, "(at)", host] + words[i + 1:], tags[:i] + [1, 2, 2] + tags[i + 1:]
        if tag == card and "-" in words[i]:
            yield words[:i] + [words[i].replace("-", ".")] + words[i + 1:], tags
        if tag == card and follows == card + 1:
            end = next((j for j in range(i + 1, len(tags)) if tags[j] != card + 1), len(tags))
            yield words[:i] + [".".join(words[i:end])] + words[end:], tags[:i] + [card] + tags[end:]


def _lettered(words: list[str], tags: list[int]) -> Iterator[tuple[list[str], list[int]]]:
    """The window with spelled-out addresses of letters only in place of a whole match, also alone, and with an "at" that has no host."""
    for i, tag in enumerate(tags):
        if tag == 1 and tags[i + 1: i + 2] != [2] and words[i].count("@") == 1:
            for at in ("[at]", "(at)"):
                for n, host in enumerate(_HOSTS):
                    spelled = [_NAMES[n % len(_NAMES)], at, host]
                    yield spelled, [1, 2, 2]
                    yield words[:i] + spelled + words[i + 1:], tags[:i] + [1, 2, 2] + tags[i + 1:]
                yield words[:i] + ["was", at, "home"] + words[i + 1:], tags[:i] + [0, 0, 0] + tags[i + 1:]


def _window_rows(batches: Iterator[pa.RecordBatch], around: int = 4) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = []
        for text in batch.column("text").to_pylist():
            words, tags = _tagged(text or "")
            hits = [i for i, t in enumerate(tags) if t % 2]
            spans = [(max(0, i - around), i + 2 * around) for i in hits] + [(0, 3 * around)]
            rows += [{"words": words[a:b], "tags": tags[a:b]} for a, b in spans if words]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r["words"] for r in rows], pa.list_(pa.string())),
             pa.array([r["tags"] for r in rows], pa.list_(pa.int32()))], names=["words", "tags"])


def train(docs: DataFrame, max_docs: int = 400, max_windows: int = 1500) -> Field:
    """Fit to windows of the ``max_docs`` documents with the smallest hash of id and text among those that hold a digit or ``@``.

    At most ``max_windows`` different windows are used, and their variants; windows without a match keep ordinary words outside.
    """
    text = F.col("text").cast("string").alias("text")
    hashed = docs.select(text, F.xxhash64("doc_id", text).alias("h")).filter(F.col("text").rlike("[0-9@]"))
    # The bound on the hash is found without texts; only the texts below it are read again.
    highest = hashed.select("h").distinct().orderBy("h").limit(max_docs).agg(F.max("h")).first()[0]
    sample = hashed.filter(F.col("h") <= highest if highest is not None else F.lit(False)).dropDuplicates(["h"]).select("text")
    rows = (sample.mapInArrow(_window_rows, "words array<string>, tags array<int>").distinct()
            .orderBy(F.xxhash64("words"), "words", "tags").limit(max_windows).toArrow())
    windows = list(zip(rows.column("words").to_pylist(), rows.column("tags").to_pylist()))
    # The field sees shapes only, so one window of equal shapes is enough of these.
    lettered = {(*map(shape, w), *t): (w, t) for window in windows for w, t in _lettered(*window)}
    return fit([*windows, *(v for w, t in windows for v in _variants(w, t)), *lettered.values()])


class _Codes(dict):
    """Shape codes of words, remembered up to a bound."""

    def __init__(self, shapes: dict[str, int]):
        super().__init__()
        self.shapes = shapes

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        code = self[word] = self.shapes.get(shape(word), 1 if any(c.isdigit() for c in word) else 0)
        return code


class Finder:
    """Finds spans in texts with a fitted field."""

    def __init__(self, model: Field):
        self.model, self.codes = model, _Codes(model.shapes)

    def find(self, texts: list[str | None]) -> list[tuple[list, list]]:
        """For each text the spans of the patterns and those that the field adds, which overlap no other."""
        words = [(t or "").split() for t in texts]
        codes, plain = self.codes, self.model.shapes.get("x", 0)
        total = sum(map(len, words)) + len(words)
        flat = np.empty(total, dtype=np.int64)
        at = 0
        for ws in words:
            flat[at: at + len(ws)] = [plain if w.isalpha() else codes[w] for w in ws]
            flat[at + len(ws)] = -1
            at += len(ws) + 1
        tags = self.model.decode(flat)
        out, at = [], 0
        for text, ws in zip(texts, words):
            base = base_spans(text)
            own = tags[at: at + len(ws)]
            out.append((base, self._added(text, own, base) if own.any() else []))
            at += len(ws) + 1
        return out

    @staticmethod
    def _added(text: str, tags: np.ndarray, base: list) -> list[tuple[int, int, int]]:
        found, before = [], None
        for tag, m in zip(tags.tolist(), _WORD.finditer(text)):
            if tag:
                kind = (tag - 1) // 2
                if tag % 2 == 0 and found and found[-1][0] == kind and found[-1][3]:
                    found[-1] = (kind, found[-1][1], m.end(), True)
                else:
                    # A name of unknown shape is outside for the field; it stands before the "at".
                    named = kind == 0 and before is not None and _AT.fullmatch(m[0])
                    found.append((kind, before if named else m.start(), m.end(), True))
            elif found:
                found[-1] = (*found[-1][:3], False)
            before = None if tag else m.start()
        # Punctuation around words belongs to the sentence; a span without a digit is no personal data, but for an address with an "at".
        # The decoded spans follow each other, so each is held against the pattern spans alone, joined where they overlap.
        starts, ends = [], []
        for s, e in sorted((s, e) for _, s, e in base):
            if ends and s < ends[-1]:
                ends[-1] = max(ends[-1], e)
            else:
                starts.append(s)
                ends.append(e)
        added = []
        for kind, start, end, _ in found:
            while end > start and not text[end - 1].isalnum():
                end -= 1
            while start < end and not (text[start].isalnum() or text[start] in "(+"):
                start += 1
            piece = text[start:end]
            told = any(c.isdigit() for c in piece) or (kind == 0 and _AT.search(piece))
            before = bisect_left(starts, end)
            if told and (before == 0 or ends[before - 1] <= start):
                added.append((kind, start, end))
        return added


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span replaced by its kind in angle brackets; overlapping spans are replaced as one."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda x: (x[1], -x[2])):
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind]}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def spans(docs: DataFrame, model: Field) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, added``: counts and digest of the pattern matches, all
    spans, and the number that the field adds. A null or empty text has none. Repeated rows get equal results; extra
    columns of the input are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(shared.value)
        for batch in slices(batches):
            found = finder.find(batch.column("text").to_pylist())
            counts = [pa.array([sum(x[0] == k for x in base) for base, _ in found], pa.int64()) for k in range(4)]
            digests = [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *counts, pa.array(digests, pa.string()),
                 pa.array([joined(base + added) for base, added in found], pa.string()),
                 pa.array([len(added) for _, added in found], pa.int64())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "added"])

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {counts}, base_sha256 string, spans string, added long")


def mask(docs: DataFrame, model: Field, column: str = "text") -> DataFrame:
    """The input with the personal data in ``column`` replaced by its kind; null texts stay null."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        finder = Finder(shared.value)
        for texts in batches:
            out: list[str | None] = []
            for batch in slices([pa.RecordBatch.from_arrays([pa.array(texts, pa.string(), from_pandas=True)], names=["text"])]):
                part = batch.column("text").to_pylist()
                out += [t and masked(t, base + added) for t, (base, added) in zip(part, finder.find(part))]
            yield pd.Series(out, dtype=object)

    return docs.withColumn(column, run(F.col(column)))
