"""Stored intermediate tables and the vectorised reading of text columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession

from farescope.session import shared_dir

# Bytes of text that one vectorised step looks at; a longer text is a step of its own.
BLOCK_BYTES = 4 << 20
# The same where a step makes several numbers of eight bytes for each byte of text.
SMALL_BLOCK_BYTES = 1 << 20
# Bytes of a word that are hashed eight at a time.
LONG_WORD = 64
ODD = 0x9E3779B97F4A7C15
# Rows that Spark hands to a Python worker at once where whole texts are moved.
BATCH_ROWS = 1_000
_BATCH_ROWS_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """From now on Arrow batches of the session have ``rows`` rows at most; a lower setting stands.

    Of each batch there are several copies at a time, in the executor and in the worker, beside
    what is made of it.
    """
    now = int(spark.conf.get(_BATCH_ROWS_SETTING))
    if now <= 0 or now > rows:
        spark.conf.set(_BATCH_ROWS_SETTING, rows)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written below the shared folder and read again: its lineage ends there."""
    spark = df.sparkSession
    path = shared_dir(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until no column of ``df`` is called that."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_blocks(texts, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, UTF-8 bytes, row offsets in them) for runs of rows; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True that stay within a row."""
    if not len(mask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(len(mask) + 1, bool)
    edge[offsets] = True
    first = mask.copy()
    first[1:] &= ~mask[:-1] | edge[1:-1]
    last = mask.copy()
    last[:-1] &= ~mask[1:] | edge[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


class WordHasher:
    """64-bit hashes of the words of whole blocks of text, A-Z as a-z unless ``fold`` is off.

    A word is read eight bytes at a time, each eight mixed into what came before, so that no
    sum or product of letters can cancel out; words over LONG_WORD bytes are hashed by xxh3.
    """

    def __init__(self, word_bytes: np.ndarray, fold: bool = True):
        self.is_word = word_bytes
        self.fold = np.arange(256, dtype=np.uint8)
        if fold:
            self.fold[65:91] = self.fold[97:123]
        self.masks = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)

    def words(self, data: np.ndarray, offsets: np.ndarray):
        """(starts, ends, index of each row's first word) of the words in the block."""
        starts, ends = runs(self.is_word[data], offsets)
        return starts, ends, np.searchsorted(starts, offsets)

    def folded(self, data: np.ndarray) -> np.ndarray:
        """The bytes as they are compared, with eight zeros behind them."""
        out = np.zeros(len(data) + 8, np.uint8)
        out[: len(data)] = self.fold[data]
        return out

    def hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        plain = self.folded(data)
        eights = np.ndarray((len(data) + 1,), "<u8", plain, 0, (1,))  # the eight bytes from each place
        n = ends - starts
        out = mix((eights[starts] & self.masks[np.minimum(n, 8)]) + n.astype(np.uint64) * np.uint64(ODD))
        rest = np.flatnonzero(n > 8)
        for at in range(8, LONG_WORD, 8):
            if not len(rest):
                break
            more = eights[starts[rest] + at] & self.masks[np.minimum(n[rest] - at, 8)]
            out[rest] = mix(out[rest] * np.uint64(ODD) ^ more)
            rest = rest[n[rest] > at + 8]
        for i in rest:
            out[i] = xxhash.xxh3_64_intdigest(plain[starts[i] : ends[i]])
        return out


def space_words() -> np.ndarray:
    """Which bytes belong to words that white space (0x20, 0x09-0x0D) parts."""
    table = np.ones(256, bool)
    table[0x20] = table[0x09:0x0E] = False
    return table


def plain_words() -> np.ndarray:
    """Which bytes belong to words of letters, digits and everything beyond ASCII."""
    table = np.zeros(256, bool)
    table[0x30:0x3A] = table[0x41:0x5B] = table[0x61:0x7B] = table[0x80:] = True
    return table
