"""What several operators of this subpackage use: tables, words, shingles, small slices of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_SQL = r"[^\x20\x09-\x0D]+"
HELD_OUT_FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column) -> Column:
    """The fold of a document; rows of fold 0 are never learned from. A null id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_FOLDS, F.lit(0))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, *columns: str) -> DataFrame:
    """Labelled documents outside fold 0, at most ``max_rows`` of them: those with the smallest hash of the id.

    The chosen ids are at most ``max_rows`` rows of two numbers, so they are broadcast and the texts stay where they are.
    """
    chosen = (labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (fold(F.col("doc_id")) != 0))
              .select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_y"))
              .orderBy(F.xxhash64("_id"), "_id", "_y").limit(max_rows))
    return (docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
            .select(F.col("_id").alias("doc_id"), F.col("_y").alias("y"), *columns))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", max_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of a slice take about ``max_bytes``; one longer text makes a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(column)
        sizes = np.array(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64)
        chunk = np.cumsum(sizes) // max_bytes
        starts = np.flatnonzero(np.r_[True, chunk[1:] != chunk[:-1]])
        for start, end in zip(starts, np.r_[starts[1:], batch.num_rows]):
            yield batch.slice(int(start), int(end - start))


def long_list(arrays: list[np.ndarray]) -> pa.Array:
    """A column of lists of longs."""
    offsets = np.zeros(len(arrays) + 1, dtype=np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    values = np.concatenate(arrays) if arrays else np.zeros(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=pa.int64()))


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    limit = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def text_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, with A-Z lower-cased and every other character as it is."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingle_set(words: list[bytes], hashes: WordHashes, width: int) -> np.ndarray:
    """The distinct shingles of ``width`` words as sorted 64-bit fingerprints (as signed numbers).

    A text of fewer words has one shingle, its whole sequence; a text without words has none.
    """
    n = len(words)
    if not n:
        return np.zeros(0, dtype=np.int64)
    values = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=n)
    used, count = min(width, n), max(1, n - width + 1)
    mixed = np.full(count, used, dtype=np.uint64)
    for at in range(used):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + values[at: at + count]
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed.view(np.int64))
