"""Toxicity by a convolutional text classifier: hashed word embeddings, filters of several widths, max pooling over the whole text.

A word is the sum of two hashed embeddings, of the word without the punctuation around it and of its first letters, so an
inflected word is near its stem. A filter of width w adds one projection of each of w words in a row; projections
depend on the word alone, so they are computed once per distinct word and gathered. The pooled responses feed one sigmoid
unit. Training is in numpy; only the largest response of a filter passes its gradient on. It takes every labelled row outside fold 0:
the rows are dealt to shards of a bounded size, tasks go over their shards from a common model, and the models are averaged,
several times over. The words of a text never reach the driver. The score reads the text alone. The thresholds of the languages are calibrated beside it, on labelled rows kept out of the fit.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roamgrid.llm.minhash_dedup import _bit, _bitmaps, _is_set
from roamgrid.llm.shared import fold, slices
from roamgrid.session import materialize

WIDTHS = (1, 2, 3)
FILTERS = 8
DIMENSIONS = 16
BUCKETS = 1 << 15
STEM = 4
# Rows and words of a shard.
MAX_ROWS, MAX_WORDS = 8_000, 4_000_000
# Passes over the rows in all, and how often the models of several shards are averaged meanwhile.
EPOCHS, ROUNDS = 12, 4
BATCH, DROPOUT, MIN_TEXTS = 48, 0.3, 4
# Rows of either class that every shard has; rows of a rarer class go to several shards.
_LEAST_ROWS = 100
# Embedding rows are moved and averaged in blocks of so many.
_BLOCK = 512
# Words that are pooled at a time in training.
_PART_WORDS = 1_000_000
_NO_PRINT = np.iinfo(np.int64).max
_EDGE = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


class Buckets(dict):
    """The two embedding rows of a word, as one number, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 300_000:
            self.clear()
        bare = word.lower().strip(_EDGE) or word
        whole = xxhash.xxh32_intdigest("w" + bare) % BUCKETS
        stem = xxhash.xxh32_intdigest("s" + bare[:STEM]) % BUCKETS
        value = self[word] = whole * BUCKETS + stem
        return value


@dataclass
class Cnn:
    """``filters[k]`` projects an embedding to the ``FILTERS`` responses of one offset of one width."""

    embeddings: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    weights: np.ndarray
    intercept: float
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.5

    def pooled(self, words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray | None, np.ndarray | None]:
        """The largest response of every filter in every text, and the word where it starts (an index into all words), in training.

        Texts have at least one word. A text shorter than a filter is continued by empty words.
        """
        spare = max(WIDTHS) - 1
        ids = np.concatenate([np.concatenate([w, np.full(spare, -1)]) for w in words])
        distinct, codes = np.unique(ids, return_inverse=True)
        known = distinct[distinct >= 0]
        vectors = np.zeros((len(distinct), DIMENSIONS), dtype=np.float32)
        vectors[distinct >= 0] = self.embeddings[known // BUCKETS] + self.embeddings[known % BUCKETS]
        starts = np.cumsum([0, *(len(w) + spare for w in words[:-1])])
        ends = starts + [len(w) for w in words]
        best, where, k = [], [], 0
        for width in WIDTHS:
            response = 0
            for offset in range(width):
                projected = vectors @ self.filters[k]
                k += 1
                response = response + projected[codes[offset: len(codes) - spare + offset]]
            # Windows start at each word of the text itself; those that reach over its end see empty words.
            cuts = np.stack([starts, np.minimum(ends, len(response))], axis=1).ravel()
            inside = np.concatenate([response, np.full((1, FILTERS), -np.inf, dtype=np.float32)])
            best.append(np.maximum.reduceat(inside, cuts, axis=0)[::2])
            if self.training:
                where.append(np.stack([s + response[s:e].argmax(axis=0) for s, e in zip(starts, ends)]))
        return (np.concatenate(best, axis=1) + self.bias, np.concatenate(where, axis=1) if where else None,
                ids if where else None)

    training = False

    def score(self, words: list[np.ndarray]) -> np.ndarray:
        out = np.full(len(words), 1 / (1 + np.exp(-self.intercept)))
        filled = [i for i, w in enumerate(words) if len(w)]
        if filled:
            total = np.maximum(self.pooled([words[i] for i in filled])[0], 0) @ self.weights + self.intercept
            out[filled] = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        return out


def untrained(seed: int = 0, scale: float = 0.05) -> Cnn:
    rng = np.random.default_rng(seed)
    total = FILTERS * len(WIDTHS)
    return Cnn(rng.normal(0, scale, (BUCKETS, DIMENSIONS)).astype(np.float32),
               [rng.normal(0, 0.5, (DIMENSIONS, FILTERS)).astype(np.float32) for w in WIDTHS for _ in range(w)],
               np.zeros(total, dtype=np.float32), np.full(total, 0.3, dtype=np.float32), 0.0)


class _Adagrad:
    def __init__(self, rate: float, sums: dict | None = None):
        self.rate, self.sums = rate, {} if sums is None else sums

    def step(self, name, value: np.ndarray, grad: np.ndarray, rows: np.ndarray | None = None) -> None:
        sums = self.sums.setdefault(name, np.full(value.shape, 1e-4, dtype=np.float32))
        at = slice(None) if rows is None else rows
        sums[at] += grad * grad
        value[at] -= self.rate * grad / np.sqrt(sums[at])


def _thinned(words: np.ndarray, share: float, rng: np.random.Generator) -> np.ndarray:
    kept = words[rng.random(len(words)) >= share]
    return kept if len(kept) else words


def _least_prints(words: list[np.ndarray], prints: np.ndarray, count: int) -> np.ndarray:
    """For every embedding row the ``count`` smallest prints of the different texts that have a word of it."""
    found, held = np.full((BUCKETS, count), _NO_PRINT), np.zeros(BUCKETS, dtype=np.int64)
    for i in np.unique(prints, return_index=True)[1]:
        rows = np.unique(np.concatenate([words[i] // BUCKETS, words[i] % BUCKETS]))
        rows = rows[held[rows] < count]
        found[rows, held[rows]] = prints[i]
        held[rows] += 1
    return found


def _in_enough(prints: np.ndarray) -> np.ndarray:
    """Whether as many different texts as there are columns in one shard's table have a word of a row, from the tables of all shards."""
    ordered = np.sort(np.concatenate(list(prints), axis=1), axis=1)
    different = (np.diff(ordered, axis=1) != 0) & (ordered[:, 1:] != _NO_PRINT)
    return different.sum(axis=1) + (ordered[:, 0] != _NO_PRINT) >= prints[0].shape[1]


def _drawn(group: np.ndarray, start: int, count: int, seed: list[int]) -> np.ndarray:
    """``count`` members of a group, from the ``start``-th draw on: all of them in a random order, then again in another."""
    turns = range(start // len(group), (start + count - 1) // len(group) + 1)
    rows = np.concatenate([np.random.default_rng([*seed, turn]).permutation(group) for turn in turns])
    return rows[start % len(group):][:count]


def _pooled(model: Cnn, words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``Cnn.pooled`` in parts of ``_PART_WORDS`` words."""
    part = np.cumsum([len(w) for w in words]) // _PART_WORDS
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(words)]
    found, before = [], 0
    for start, end in zip(cuts, cuts[1:]):
        best, where, ids = model.pooled(words[start:end])
        found.append((best, where + before, ids))
        before += len(ids)
    return tuple(np.concatenate(x) for x in zip(*found))


def _passes(model: Cnn, opt: _Adagrad, words: list[np.ndarray], y: np.ndarray, learned: np.ndarray, epochs: range, seed: list[int],
            batch: int = BATCH, dropout: float = DROPOUT) -> None:
    """The given of the ``EPOCHS`` passes, in place; both classes are drawn equally often, and every row at least once in all passes."""
    groups = [np.flatnonzero((y == c) & np.array([len(w) > 0 for w in words], dtype=bool)) for c in (0, 1)]
    groups = [(c, g) for c, g in enumerate(groups) if len(g)]
    if not groups:
        return
    sizes, half = [len(g) for _, g in groups], batch // 2
    steps = max(30, 2 * min(sizes) // batch, math.ceil(max(sizes) / (half * EPOCHS)))
    rng, intercept = np.random.default_rng([*seed, epochs.start]), np.array([model.intercept], dtype=np.float32)
    draws = [_drawn(g, epochs.start * steps * half, len(epochs) * steps * half, [*seed, c]).reshape(-1, half) for c, g in groups]
    model.training = True
    for rows in np.concatenate(draws, axis=1):
        # Left-out words keep single words of a text from standing for its label.
        pooled, where, ids = _pooled(model, [_thinned(words[i], dropout, rng) for i in rows])
        active = np.maximum(pooled, 0)
        p = 1 / (1 + np.exp(-np.clip(active @ model.weights + intercept, -30, 30)))
        miss = ((p - y[rows]) / len(rows)).astype(np.float32)
        back = miss[:, None] * model.weights * (pooled > 0)
        moved_ids, moved = [], []
        k = 0
        for n, width in enumerate(WIDTHS):
            own = slice(n * FILTERS, (n + 1) * FILTERS)
            g, at = back[:, own], where[:, own]
            for offset in range(width):
                word = ids[at + offset]
                vectors = (model.embeddings[word // BUCKETS] + model.embeddings[word % BUCKETS]) * (word >= 0)[..., None]
                grad = np.einsum("nf,nfd->df", g, vectors).astype(np.float32)
                moved_ids.append(word[word >= 0])
                moved.append((g[..., None] * model.filters[k].T)[word >= 0])
                opt.step(("filter", k), model.filters[k], grad)
                k += 1
        at, g = np.concatenate(moved_ids), np.concatenate(moved)
        rows_of, inverse = np.unique(np.concatenate([at // BUCKETS, at % BUCKETS]), return_inverse=True)
        grad = np.zeros((len(rows_of), DIMENSIONS), dtype=np.float32)
        np.add.at(grad, inverse, np.concatenate([g, g]))
        opt.step("embeddings", model.embeddings, grad[learned[rows_of]], rows_of[learned[rows_of]])
        opt.step("weights", model.weights, active.T @ miss + 1e-4 * model.weights)
        opt.step("bias", model.bias, back.sum(0))
        opt.step("intercept", intercept, miss.sum(keepdims=True))
    model.training = False
    model.intercept = float(intercept[0])


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    buckets = Buckets()
    for batch in slices(batches):
        rows = [[buckets[w] for w in (t or "").split()] for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(rows, pa.list_(pa.int32()))],
                                         names=[*batch.schema.names[:-1], "words"])


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, y, lang, kept, print, words`` of every labelled document outside fold 0. Rows equal in id, label and words are one.

    Texts without a label are left out by a bitmap of the labelled ids before anything is moved, and word numbers are moved, not texts.
    """
    marks = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (fold(F.col("doc_id")) != 0)).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("y")).distinct()
    likely = _bitmaps(marks.select(F.col("doc_id").alias("node")), "likely")
    text, lang = F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    rows = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), lang, text).withColumn("h", _bit("doc_id"))
    rows = rows.join(F.broadcast(likely), F.bitmap_bucket_number("h") == F.col("bucket")).filter(_is_set("likely", F.col("h")))
    found = rows.select("doc_id", "lang", "text").mapInArrow(_word_rows, "doc_id long, lang string, words array<int>")
    one = found.withColumn("print", F.xxhash64("words")).join(marks.hint("merge"), "doc_id").groupBy("doc_id", "y", "print").agg(
        F.min("lang").alias("lang"), F.first("words").alias("words"))
    return one.withColumn("kept", F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0)


def _pack(rows: pa.Table) -> pa.Table:
    """A shard as one row: its rows by id, label and print as one value."""
    ordered = rows.sort_by([("doc_id", "ascending"), ("y", "ascending"), ("print", "ascending")]).combine_chunks()
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, ordered.schema) as writer:
        writer.write_table(ordered)
    return pa.table({"shard": ordered.column("shard").slice(0, 1).cast(pa.int32()), "data": pa.array([out.getvalue().to_pybytes()], pa.binary())})


def _unpacked(batches: Iterator[pa.RecordBatch], kept: bool) -> Iterator[tuple[int, pa.Table, list[np.ndarray]]]:
    """The number, rows and words of shards, of the rows kept out of the fit or of the others."""
    for batch in batches:
        for i in range(batch.num_rows):
            rows = pa.ipc.open_stream(batch.column("data")[i].as_py()).read_all()
            rows = rows.filter(rows.column("kept") if kept else pa.compute.invert(rows.column("kept"))).combine_chunks()
            lists = rows.column("words").combine_chunks()
            yield batch.column("shard")[i].as_py(), rows, [lists[j].values.to_numpy() for j in range(len(lists))]


_BLOCKS = "block int, shard int, data binary"


def _block_rows(shard: int, blocks: list[bytes]) -> pa.RecordBatch:
    numbers = pa.array(range(len(blocks)), pa.int32())
    return pa.RecordBatch.from_arrays([numbers, pa.array([shard] * len(blocks), pa.int32()), pa.array(blocks, pa.binary())],
                                      names=["block", "shard", "data"])


def _combined(rows: DataFrame, combine) -> list[bytes]:
    """One value per block from the values of all shards, by their number; only these reach the driver."""
    def run(group: pa.Table) -> pa.Table:
        ordered = group.sort_by("shard")
        block = ordered.column("block")[0].as_py()
        value = combine(block, [v.as_py() for v in ordered.column("data")])
        return pa.table({"block": pa.array([block], pa.int32()), "data": pa.array([value], pa.binary())})

    found = rows.groupBy("block").applyInArrow(run, "block int, data binary").toArrow().sort_by("block")
    return [v.as_py() for v in found.column("data")]


def _learned(shards: DataFrame) -> np.ndarray:
    """The embedding rows of words in at least ``MIN_TEXTS`` different texts. The others stay zero: they could only tell single texts apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows, words in _unpacked(batches, False):
            found = _least_prints(words, np.array(rows.column("print"), dtype=np.int64), MIN_TEXTS)
            yield _block_rows(shard, [found[i:i + _BLOCK].tobytes() for i in range(0, BUCKETS, _BLOCK)])

    def combine(_, values: list[bytes]) -> bytes:
        return _in_enough(np.stack([np.frombuffer(v, dtype=np.int64).reshape(_BLOCK, MIN_TEXTS) for v in values])).tobytes()

    return np.frombuffer(b"".join(_combined(shards.mapInArrow(run, _BLOCKS), combine)), dtype=bool)


def _state(model: Cnn, sums: dict) -> list[bytes]:
    """A model and what its optimiser keeps, as blocks of embedding rows and a last one for all else."""
    kept = sums.get("embeddings")
    kept = np.full_like(model.embeddings, 1e-4) if kept is None else kept
    blocks = [pickle.dumps((model.embeddings[i:i + _BLOCK], kept[i:i + _BLOCK])) for i in range(0, BUCKETS, _BLOCK)]
    rest = {"bias": model.bias, "weights": model.weights, "intercept": np.array([model.intercept], dtype=np.float32),
            **{("filter", k): v for k, v in enumerate(model.filters)}}
    return [*blocks, pickle.dumps({name: (v, sums.get(name, np.full(v.shape, 1e-4, dtype=np.float32))) for name, v in rest.items()})]


def _from_state(blocks: list[bytes]) -> tuple[Cnn, dict]:
    pairs, rest = [pickle.loads(b) for b in blocks[:-1]], pickle.loads(blocks[-1])
    model = Cnn(np.concatenate([v for v, _ in pairs]), [rest["filter", k][0].copy() for k in range(sum(WIDTHS))], rest["bias"][0].copy(),
                rest["weights"][0].copy(), float(rest["intercept"][0][0]))
    return model, {"embeddings": np.concatenate([s for _, s in pairs]), **{name: s.copy() for name, (_, s) in rest.items()}}


def _averaged(start: bytes, values: list[bytes]) -> bytes:
    """The mean of the values of a block; an embedding row is the mean over the shards that have moved it."""
    old, own = pickle.loads(start), [pickle.loads(v) for v in values]
    if isinstance(old, dict):
        mean = {name: tuple(np.mean([o[name][i] for o in own], axis=0, dtype=np.float64).astype(np.float32) for i in (0, 1)) for name in old}
        return pickle.dumps(mean)
    total, moved = [np.zeros(x.shape) for x in old], np.zeros((len(old[0]), 1))
    for pair in own:
        here = np.any([(a != b).any(axis=1) for a, b in zip(pair, old)], axis=0)[:, None]
        moved += here
        total = [t + here * x for t, x in zip(total, pair)]
    return pickle.dumps(tuple(np.where(moved > 0, t / np.maximum(moved, 1), x).astype(np.float32) for t, x in zip(total, old)))


def _fitted(shards: DataFrame, count: int, seed: int = 0, rate: float = 0.08) -> Cnn:
    """Fit to the rows of all shards. Each round starts from the common model in every shard and ends with the average of theirs."""
    context, learned = shards.sparkSession.sparkContext, _learned(shards)
    model = untrained(seed)
    model.embeddings[~learned] = 0
    blocks, rounds = _state(model, {}), 1 if count == 1 else ROUNDS
    for r in range(rounds):
        epochs, shared = range(r * EPOCHS // rounds, (r + 1) * EPOCHS // rounds), context.broadcast((blocks, learned))

        def run(batches: Iterator[pa.RecordBatch], epochs=epochs, shared=shared) -> Iterator[pa.RecordBatch]:
            for shard, rows, words in _unpacked(batches, False):
                own, sums = _from_state(shared.value[0])
                _passes(own, _Adagrad(rate, sums), words, np.array(rows.column("y"), dtype=np.float32), shared.value[1], epochs, [seed, shard])
                yield _block_rows(shard, _state(own, sums))

        blocks = _combined(shards.mapInArrow(run, _BLOCKS), lambda block, own, shared=shared: _averaged(shared.value[0][block], own))
    return _from_state(blocks)[0]


def _best_threshold(scores: np.ndarray, y: np.ndarray) -> float | None:
    """The middle of the gap at which most labels are right; None without both classes."""
    if not len(y) or y.min() == y.max():
        return None
    order = np.argsort(scores, kind="stable")
    s, labels = scores[order], y[order]
    right = np.concatenate([[0], np.cumsum(labels == 0)]) + np.concatenate([np.cumsum(labels[::-1] == 1)[::-1], [0]])
    at = np.flatnonzero(right == right.max())
    at = int(at[len(at) // 2])
    return float((s[at - 1] if at else 0.0) + (s[at] if at < len(s) else 1.0)) / 2


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_words: int = MAX_WORDS) -> Cnn:
    """Fit to ``labels.toxic`` of all documents outside fold 0, in shards of about ``max_rows`` rows and ``max_words`` words.
    Rows equal in id, label and words are one.

    A quarter of the rows, by a hash of the id, is kept out of the fit; the thresholds of the languages are set on their scores, which are
    all that reaches the driver.
    """
    rows = materialize(_labelled(docs, labels), "toxicity_rows")
    held = F.size("words") > 0
    sizes = rows.groupBy("y", "kept").agg(F.count("*").alias("rows"), F.sum(held.cast("int")).alias("held"),
                                          F.sum(F.size("words").cast("long")).alias("words")).collect()
    fitted, filled = [0, 0], [0, 0]
    for r in sizes:
        if not r["kept"]:
            fitted[r["y"]], filled[r["y"]] = r["rows"], r["held"]
    count = max(1, math.ceil(sum(r["rows"] for r in sizes) / max_rows), math.ceil(sum(r["words"] for r in sizes) / max_words))
    # A shard needs both classes: with few rows of one, these go to several shards.
    copies = [min(count, math.ceil(_LEAST_ROWS * count / max(1, n))) for n in filled]
    often = F.when(F.col("kept") | ~held, 1).when(F.col("y") == 1, copies[1]).otherwise(copies[0])
    dealt = rows.withColumn("copy", F.explode(F.sequence(F.lit(0), often - 1))).withColumn(
        "shard", F.pmod(F.pmod(F.xxhash64("doc_id", "print"), F.lit(count)) + F.col("copy"), F.lit(count)).cast("int"))
    shards = materialize(dealt.select("shard", "doc_id", "y", "lang", "kept", "print", "words").groupBy("shard").applyInArrow(
        _pack, "shard int, data binary"), "toxicity_shards")
    if all(filled):
        model = _fitted(shards, count)
    else:
        prior, model = (fitted[1] + 1) / (sum(fitted) + 2), untrained()
        model.weights[:] = 0
        model.intercept = float(np.log(prior / (1 - prior)))
    if all(fitted):
        # The fit draws both classes equally often; the score is to mean their real shares.
        real = {r["toxic"]: r["count"] for r in labels.filter(
            F.col("toxic").isin(0, 1) & (fold(F.col("doc_id")) != 0)).groupBy("toxic").count().collect()}
        model.intercept += float(np.log(real[1] / real[0]))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, own, words in _unpacked(batches, True):
            out, part, size = [np.zeros(0)], [], 0
            for w in words:
                part.append(w)
                size += len(w)
                if size > 200_000:
                    out.append(shared.value.score(part))
                    part, size = [], 0
            out.append(shared.value.score(part))
            yield pa.RecordBatch.from_arrays([*(own.column(c).combine_chunks() for c in ("doc_id", "y", "lang")), pa.array(np.concatenate(out))],
                                             names=["doc_id", "y", "lang", "score"])

    judged = shards.mapInArrow(run, "doc_id long, y int, lang string, score double").toArrow().sort_by(
        [("doc_id", "ascending"), ("y", "ascending"), ("score", "ascending")])
    y, scores = np.array(judged.column("y"), dtype=np.float32), np.array(judged.column("score"))
    langs = np.array(judged.column("lang").to_pylist(), dtype=object)
    model.threshold = _best_threshold(scores, y) or 0.5
    for name in sorted({x for x in langs if x is not None}):
        own = langs == name
        found = _best_threshold(scores[own], y[own]) if own.sum() >= 30 else None
        model.thresholds[name] = model.threshold if found is None else found
    return model


def score(docs: DataFrame, model: Cnn, name: str = "score") -> DataFrame:
    """The input with a column ``name``: the probability of label 1 from the whole text, also for null and empty texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        buckets = Buckets()
        for texts in batches:
            out, part, held = [], [], 0
            for text in texts:
                split = (text or "").split()
                part.append(np.fromiter(map(buckets.__getitem__, split), np.int64, len(split)))
                held += len(split)
                if held > 200_000:
                    out.append(shared.value.score(part))
                    part, held = [], 0
            yield pd.Series(np.concatenate([*out, shared.value.score(part)]))

    return docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != name], run(F.col("text").cast("string")).alias(name))


def judge(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, max_rows: int = MAX_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted, lang_threshold, toxic_in_lang`` of every document.

    ``predicted`` uses one threshold for all; ``toxic_in_lang`` uses the calibrated one of the document's language, or the common
    one for a null or rare language. Null and empty texts have the score of a text in which no filter responds. Repeated
    rows get equal results; extra columns are ignored; labels other than 0 and 1 are left out of the fit.
    """
    model = train(docs, labels, max_rows)
    scored = score(docs.select("doc_id", "lang", "text"), model)
    known = [x for pair in model.thresholds.items() for x in map(F.lit, pair)]
    own = F.create_map(*known)[F.col("lang")] if known else F.lit(None).cast("double")
    limit = F.coalesce(own, F.lit(float(model.threshold)))
    return scored.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score",
                         F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int").alias("predicted"),
                         limit.alias("lang_threshold"), (F.col("score") >= limit).alias("toxic_in_lang"))
