"""Exact duplicates by counting quotient filters, with every match verified on the bytes.

A fingerprint is split three ways: its first bits name a block, the next ones, the quotient, a place
in the block, and only the rest, the remainder, is stored. Each partition builds a filter of its
own: for a block, the length of the run at each place, and the runs' sorted remainders with their
counts, packed. Filters of one block merge place by place: their runs are laid side by side, the
remainders of a run are sorted, and equal ones add up; nothing is lost, as block, place and
remainder are the whole fingerprint. A partition holds one entry for a fingerprint however often
it comes, so copies of one text never meet in one place. Only texts whose fingerprint has a count
above one are compared.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farescope.session import broadcast_if_small, fits_broadcast

from .common import stored

# Places of a block, as bits; a merged block has about as many fingerprints.
PLACE_BITS = 17

FILTER = "block int, places binary, lengths binary, remainders binary, counts binary"


def normalised(text: Column) -> Column:
    """The text without 0x20 and 0x09-0x0D; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


class QuotientFilter:
    """The fingerprints of one block, each counted.

    ``places`` are the quotients that occur, ``lengths`` those of their runs; the runs follow each
    other in ``remainders``, ascending within a run, and ``counts``.
    """

    def __init__(self, places: np.ndarray, lengths: np.ndarray, remainders: np.ndarray, counts: np.ndarray):
        self.places, self.lengths, self.remainders, self.counts = places, lengths, remainders, counts

    @classmethod
    def of(cls, rest: np.ndarray, counts: np.ndarray, rest_bits: int) -> QuotientFilter:
        """From fingerprints without their block's bits, ascending and different."""
        remainder_bits = rest_bits - PLACE_BITS
        quotient = (rest >> np.uint64(remainder_bits)).astype(np.uint32)
        heads = np.flatnonzero(np.append(True, quotient[1:] != quotient[:-1])) if len(rest) else np.zeros(0, np.int64)
        lengths = np.diff(np.append(heads, len(rest))).astype(np.uint32)
        return cls(quotient[heads], lengths, rest & np.uint64((1 << remainder_bits) - 1), counts)

    @classmethod
    def merged(cls, filters: list[QuotientFilter]) -> QuotientFilter:
        """Filters of one block as one; counts of equal fingerprints add up."""
        runs = np.zeros(1 << PLACE_BITS, np.int64)
        for f in filters:
            runs[f.places] += f.lengths
        remainders = np.zeros(int(runs.sum()), np.uint64)
        counts = np.zeros(len(remainders), np.int64)
        free = np.cumsum(runs) - runs  # where each run goes on
        for f in filters:
            own = f.lengths.astype(np.int64)
            within = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
            at = np.repeat(free[f.places], own) + within
            remainders[at], counts[at] = f.remainders, f.counts
            free[f.places] += own
        head = np.zeros(len(remainders) + 1, bool)
        head[(np.cumsum(runs) - runs)[runs > 0]] = True
        # Runs are short: neighbours of a run change places until none is out of order.
        for parity in itertools.count():
            left = np.flatnonzero(~head[1:-1] & (remainders[:-1] > remainders[1:])) if len(remainders) else remainders
            if not len(left):
                break
            left = left[left % 2 == parity % 2]
            for x in (remainders, counts):
                x[left], x[left + 1] = x[left + 1], x[left]
        first = np.flatnonzero(head[:-1] | np.append(True, remainders[1:] != remainders[:-1])[: len(remainders)])
        place = np.repeat(np.arange(len(runs)), runs)[first]
        total = np.add.reduceat(counts, first) if len(first) else counts
        lengths = np.bincount(place, minlength=len(runs))
        places = np.flatnonzero(lengths)
        return cls(places.astype(np.uint32), lengths[places].astype(np.uint32), remainders[first], total)

    def entries(self, rest_bits: int) -> tuple[np.ndarray, np.ndarray]:
        """(fingerprints without their block's bits, counts), ascending."""
        place = np.repeat(self.places, self.lengths).astype(np.uint64)
        return place << np.uint64(rest_bits - PLACE_BITS) | self.remainders, self.counts

    def packed(self) -> tuple[bytes, ...]:
        """The four arrays; equal bytes of neighbours side by side, compressed."""
        return tuple(_pack(x) for x in (self.places, self.lengths, self.remainders, self.counts))

    @classmethod
    def unpacked(cls, row: dict) -> QuotientFilter:
        kinds = (("places", np.uint32), ("lengths", np.uint32), ("remainders", np.uint64), ("counts", np.int64))
        return cls(*(_unpack(row[name], kind) for name, kind in kinds))


def _pack(values: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize)
    return zstandard.ZstdCompressor(level=1).compress(planes.T.tobytes())


def _unpack(data: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["block", "places", "lengths", "remainders", "counts"]
    columns = [pa.array([r[i] for r in rows], pa.binary() if i else pa.int32()) for i in range(len(names))]
    return pa.RecordBatch.from_arrays(columns, names)


def _filters(block_bits: int):
    """The filter of a partition, a row for each block."""
    rest_bits = 64 - block_bits

    def run(batches):
        prints, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            found = np.sort(np.concatenate([prints, batch.column(0).to_numpy().view(np.uint64)]))
            head = np.flatnonzero(np.append(True, found[1:] != found[:-1])) if len(found) else np.zeros(0, np.int64)
            number = np.diff(np.append(head, len(found)))
            # What was known before stands once among the new ones, for its own count.
            number[np.searchsorted(found[head], prints)] += counts - 1
            prints, counts = found[head], number
        block = (prints >> np.uint64(rest_bits)).astype(np.int64)
        cut = np.append(np.flatnonzero(np.append(True, block[1:] != block[:-1])), len(block)) if len(block) else [0]
        for i, j in zip(cut[:-1], cut[1:], strict=True):
            rest = prints[i:j] & np.uint64((1 << rest_bits) - 1)
            yield _batch([(int(block[i]), *QuotientFilter.of(rest, counts[i:j], rest_bits).packed())])

    return run


def _merge(table: pa.Table) -> pa.Table:
    """One filter for a block from those of the partitions."""
    rows = table.to_pylist()
    one = QuotientFilter.merged([QuotientFilter.unpacked(r) for r in rows])
    return pa.Table.from_batches([_batch([(rows[0]["block"], *one.packed())])])


def _block_bits(n: int) -> int:
    return max(4, math.ceil(math.log2(max(1, n) / (1 << PLACE_BITS) + 1)))


def counting_filter(prints: DataFrame) -> DataFrame:
    """The merged counting quotient filter of a column of 64-bit fingerprints, a row a block.

    The number of blocks follows the number of fingerprints, so that a block stays small.
    """
    bits = _block_bits(prints.count())
    return prints.mapInArrow(_filters(bits), FILTER).groupBy("block").applyInArrow(_merge, FILTER).withColumn("bits", F.lit(bits))


def _counts(least: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                rest_bits = 64 - row["bits"]
                rest, counts = QuotientFilter.unpacked(row).entries(rest_bits)
                prints = (np.uint64(row["block"]) << np.uint64(rest_bits) | rest)[counts >= least]
                out = [pa.array(prints.view(np.int64)), pa.array(counts[counts >= least])]
                yield pa.RecordBatch.from_arrays(out, ["fingerprint", "count"])

    return run


def filter_counts(filter_: DataFrame, least: int = 1) -> DataFrame:
    """(fingerprint, count) of the entries of a filter that count ``least`` or more."""
    return filter_.mapInArrow(_counts(least), "fingerprint bigint, count bigint")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs`` (doc_id, text).

    Texts are equal when they are identical without white space (0x20, 0x09-0x0D); null counts as
    empty, and empty texts are equal. Of equal texts, the row with the most code points in its
    text stays, then the one with the smallest doc_id (null last); of rows equal in both, one of
    them. keep_id is the doc_id of the row that stays, group_size the number of equal texts.
    Other columns are ignored; an empty table gives no rows.
    """
    text = normalised(F.col("text"))
    digests = stored(
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("raw"), text.alias("text")).select(
            "doc_id",
            F.length("raw").cast("bigint").alias("chars"),
            F.xxhash64("text").alias("fingerprint"),
            F.sha2("text", 256).alias("text_sha256"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    repeated = filter_counts(counting_filter(digests.select("fingerprint")), 2).select("fingerprint")
    repeated = stored(repeated)
    # The texts behind repeated fingerprints, one for each task that has read copies, byte by byte.
    again = docs.select(text.alias("text")).withColumn("fingerprint", F.xxhash64("text"))
    again = again.join(broadcast_if_small(repeated), "fingerprint", "left_semi")
    texts = again.groupBy("fingerprint", "text").agg(F.count(F.lit(1)).alias("group_size"))
    texts = texts.select("fingerprint", F.sha2("text", 256).alias("text_sha256"), "group_size")
    texts = stored(texts.groupBy("fingerprint", "text_sha256").agg(F.max("group_size").alias("group_size"), F.count(F.lit(1)).alias("texts")))
    if texts.where("texts > 1").take(1):
        raise ValueError("different texts share a fingerprint and a SHA-256")
    texts = texts.drop("texts")

    best = F.min(F.struct(-F.col("chars"), F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("best")
    keys = ["fingerprint", "text_sha256"]
    # Each task combines its copies of a text before any row of a group moves.
    again = digests.join(F.broadcast(repeated), "fingerprint", "left_semi") if fits_broadcast(repeated) else digests
    kept = again.groupBy(*keys).agg(best)
    groups = texts.join(kept, keys).select(*keys, "group_size", F.col("best.doc_id").alias("keep"), F.col("best.row").alias("keep_row"))
    groups = broadcast_if_small(stored(groups))  # a row for each text that repeats
    return digests.join(groups, keys, "left").select(
        "doc_id",
        F.when(F.col("keep_row").isNull(), F.col("doc_id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        (F.coalesce("keep_row", "row") == F.col("row")).alias("kept"),
        "text_sha256",
    )
