"""Repeated passages, found by fixed-block anchors and extended to maximal exact repeats.

Every document is cut into blocks of consecutive words that do not overlap; their fingerprints
are the index. A window of WINDOW words always holds a whole block, so every repeat of that
length is seen when each rolling window of a block's length probes the index. Around the probes
that hit, windows of the full length are compared; consecutive equal ones make up the maximal
repeats, and each word of a later document that one of them covers goes.

Documents are packed into shards and stored once, bucketed by shard. Only fingerprints travel:
sorted and packed, dealt by their upper bits, one entry for each different one of a shard however
often it stands there, and a bit for each comes back. So neither a passage that all documents
share nor a mass of equal documents meets in one task, and no pair of documents is ever formed.
"""

from __future__ import annotations

import itertools
import math
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farescope.session import shared_dir

from .common import ODD, WordHasher, mix, space_words, stored, text_blocks

WINDOW = 50
# Bytes of text in a shard (a longer document is a shard of its own), and windows in a bucket.
SHARD_BYTES = 4 << 20
BUCKET_WINDOWS = 1 << 21
# Bytes of packed shards that a task reads on average.
TASK_BYTES = 64 << 20

SHARD = "shard bigint, doc_ids array<bigint>, sizes array<bigint>, n_words bigint, packed binary"
PROBES = "bucket int, shard bigint, n int, prints binary, flags binary"
WINDOWS = "bucket int, shard bigint, n int, prints binary, checks binary, docs binary"
REPLY = "shard bigint, bucket int, n int, bits binary"
RESULT = "doc_id bigint, n_words bigint, n_removed bigint, removed array<struct<start:bigint,n_words:bigint>>, kept_text string"

# A null doc_id counts as larger than every other.
NO_ID = np.iinfo(np.int64).max


def _pack(values: np.ndarray) -> bytes:
    """An array of integers, equal bytes of neighbours side by side, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1)
    return zstandard.ZstdCompressor(level=1).compress(planes.T.tobytes())


def _unpack(data: bytes, n: int, dtype: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(-1, n).T).view(dtype).ravel() if n else np.zeros(0, dtype)


def _pack_bits(bits: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.packbits(bits).tobytes())


def _unpack_bits(data: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.unpackbits(raw, count=n).astype(bool)


def _rows(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}
    fields = [f.split(" ") for f in schema.split(", ")]
    columns = [pa.array([r[i] for r in rows], kinds[kind]) for i, (_, kind) in enumerate(fields)]
    return pa.RecordBatch.from_arrays(columns, [name for name, _ in fields])


_hasher = WordHasher(space_words(), fold=False)


def _shards(limit: int):
    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        ids: list = []
        texts: list[bytes] = []
        size = 0

        def row():
            raw = b"".join(texts)
            words = len(_hasher.words(np.frombuffer(raw, np.uint8), np.cumsum([0, *map(len, texts)]))[0])
            packed = zstandard.ZstdCompressor(level=3).compress(raw)
            return _rows(SHARD, [(part << 32 | number, ids, list(map(len, texts)), words, packed)])

        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for first, data, offsets in text_blocks(batch.column(1), limit):
                for k in range(len(offsets) - 1):
                    text = data[offsets[k] : offsets[k + 1]].tobytes()
                    if texts and size + len(text) > limit:
                        yield row()
                        number, ids, texts, size = number + 1, [], [], 0
                    ids.append(doc_ids[first + k])
                    texts.append(text)
                    size += len(text)
        if texts:
            yield row()

    return run


def rolled(hashes: np.ndarray, length: int) -> np.ndarray:
    """Fingerprints of all windows of ``length`` hashes; empty if there are fewer."""
    if len(hashes) < length:
        return np.zeros(0, np.uint64)
    out, width = mix(hashes), 1
    while width < length:  # out[i] covers the hashes i .. i + width - 1
        step = min(width, length - width)
        out = mix(out[:-step] * np.uint64(ODD) ^ out[step:])
        width += step
    return out


class Shard:
    """Words, fingerprints and places of the documents of one shard."""

    def __init__(self, row: dict, window: int):
        self.block = (window + 1) // 2
        self.window = window
        self.key = row["shard"]
        self.sizes = np.array(row["sizes"], np.int64)
        self.raw = zstandard.ZstdDecompressor().decompress(row["packed"])
        self.doc_ids = row["doc_ids"]
        self.ids = np.array([NO_ID if i is None else i for i in self.doc_ids], np.int64)
        self.offsets = np.append(0, np.cumsum(self.sizes))
        data = np.frombuffer(self.raw, np.uint8)
        starts, ends, self.first = _hasher.words(data, self.offsets)
        self.hashes = _hasher.hashes(data, starts, ends)

    def places(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(word position, document) of every window of ``length`` words of one document."""
        counts = np.maximum(np.diff(self.first) - length + 1, 0)
        doc = np.repeat(np.arange(len(counts)), counts)
        within = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
        return self.first[doc] + within, doc

    def probes(self):
        """(order, heads, fingerprints, position, document) of the windows of a block's length, grouped."""
        position, doc = self.places(self.block)
        prints = rolled(self.hashes, self.block)[position] if len(position) else np.zeros(0, np.uint64)
        order = np.argsort(prints)
        ranked = prints[order]
        heads = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if len(ranked) else np.zeros(0, np.int64)
        return order, heads, ranked[heads], position, doc

    def windows(self, hit: np.ndarray, probes):
        """Grouped windows of full length that hold a hit: (order, heads, prints, checks, least id, position, document)."""
        order, heads, _, position, _ = probes
        at = np.zeros(len(self.hashes) + 1, np.int64)
        sizes = np.diff(np.append(heads, len(order)))
        at[position[order[np.repeat(hit, sizes)]] + 1] = 1
        seen = np.cumsum(at)  # hits at word positions below
        place, doc = self.places(self.window)
        keep = seen[place + self.window - self.block + 1] > seen[place]
        place, doc = place[keep], doc[keep]
        prints = rolled(self.hashes, self.window)[place] if len(place) else np.zeros(0, np.uint64)
        other = rolled(self.hashes ^ np.uint64(ODD), self.window)[place] if len(place) else np.zeros(0, np.uint64)
        checks = other.astype(np.uint32)  # the lower half of a second fingerprint
        order = np.lexsort((checks, prints))
        new = np.ones(len(order), bool)
        new[1:] = (prints[order][1:] != prints[order][:-1]) | (checks[order][1:] != checks[order][:-1])
        heads = np.flatnonzero(new)
        least = np.minimum.reduceat(self.ids[doc[order]], heads) if len(heads) else np.zeros(0, np.int64)
        return order, heads, prints[order][heads], checks[order][heads], least, place, doc


def _cuts(prints: np.ndarray, bits: int) -> np.ndarray:
    """Borders of the buckets in sorted fingerprints."""
    edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(0, np.uint64)
    return np.concatenate([[0], np.searchsorted(prints, edges), [len(prints)]]).astype(np.int64)


def _probe(window: int, bits: int):
    def run(batches):
        for row in itertools.chain.from_iterable(b.to_pylist() for b in batches):
            shard = Shard(row, window)
            order, heads, prints, position, doc = shard.probes()
            if not len(heads):
                continue
            of = doc[order]
            several = np.minimum.reduceat(of, heads) != np.maximum.reduceat(of, heads)
            block = np.logical_or.reduceat(((position - shard.first[doc]) % shard.block == 0)[order], heads)
            short = (prints << np.uint64(bits) >> np.uint64(32)).astype("<u4")
            cuts, rows = _cuts(prints, bits), []
            for bucket in np.flatnonzero(np.diff(cuts)).tolist():
                i, j = cuts[bucket], cuts[bucket + 1]
                flags = _pack_bits(np.concatenate([block[i:j], several[i:j]]))
                rows.append((bucket, shard.key, j - i, _pack(np.diff(short[i:j], prepend=np.uint32(0))), flags))
                if len(rows) == 256:
                    yield _rows(PROBES, rows)
                    rows = []
            yield _rows(PROBES, rows)

    return run


def _hits(table: pa.Table) -> pa.Table:
    """For each shard's fingerprints in a bucket: is it a block somewhere, and in several documents?"""
    rows = table.to_pylist()
    sizes = np.array([r["n"] for r in rows])
    prints = np.concatenate([np.cumsum(_unpack(r["prints"], r["n"], "<u4"), dtype=np.uint32) for r in rows])
    flags = [_unpack_bits(r["flags"], 2 * r["n"]) for r in rows]
    block = np.concatenate([x[: len(x) // 2] for x in flags])
    several = np.concatenate([x[len(x) // 2 :] for x in flags])
    owner = np.repeat(np.arange(len(rows)), sizes)
    order = np.argsort(prints)
    ranked = prints[order]
    heads = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    of = owner[order]
    hit = np.minimum.reduceat(of, heads) != np.maximum.reduceat(of, heads)
    hit = (hit | np.logical_or.reduceat(several[order], heads)) & np.logical_or.reduceat(block[order], heads)
    bits = np.zeros(len(order), bool)
    bits[order] = np.repeat(hit, np.diff(np.append(heads, len(order))))
    return _replies(rows, sizes, bits)


def _replies(rows: list[dict], sizes: np.ndarray, bits: np.ndarray) -> pa.Table:
    ends = np.cumsum(sizes)
    out = [
        (r["shard"], r["bucket"], r["n"], _pack_bits(bits[j - n : j]))
        for r, n, j in zip(rows, sizes, ends, strict=True)
        if bits[j - n : j].any()
    ]
    return pa.Table.from_batches([_rows(REPLY, out)])


def _answers(replies: list[dict], prints: np.ndarray, bits: int) -> np.ndarray:
    """The bits that came back for sorted fingerprints."""
    cuts = _cuts(prints, bits)
    out = np.zeros(len(prints), bool)
    for r in replies:
        i, j = cuts[r["bucket"]], cuts[r["bucket"] + 1]
        if j - i != r["n"]:
            raise ValueError("a reply doesn't fit its shard")
        out[i:j] = _unpack_bits(r["bits"], r["n"])
    return out


def _extend(window: int, bits: int):
    def run(batches):
        for row in itertools.chain.from_iterable(b.to_pylist() for b in batches):
            shard = Shard(row, window)
            probes = shard.probes()
            _, _, prints, checks, least, _, _ = shard.windows(_answers(row["replies"], probes[2], bits), probes)
            cuts, rows = _cuts(prints, bits), []
            for bucket in np.flatnonzero(np.diff(cuts)).tolist():
                i, j = cuts[bucket], cuts[bucket + 1]
                packed = [_pack(np.diff(prints[i:j], prepend=np.uint64(0))), _pack(checks[i:j]), _pack(least[i:j])]
                rows.append((bucket, shard.key, j - i, *packed))
                if len(rows) == 256:
                    yield _rows(WINDOWS, rows)
                    rows = []
            if rows:
                yield _rows(WINDOWS, rows)

    return run


def _earlier(table: pa.Table) -> pa.Table:
    """For each shard's windows in a bucket: do they start in a smaller document than the shard's own?"""
    rows = table.to_pylist()
    sizes = np.array([r["n"] for r in rows])
    prints = np.concatenate([np.cumsum(_unpack(r["prints"], r["n"], "<u8"), dtype=np.uint64) for r in rows])
    checks = np.concatenate([_unpack(r["checks"], r["n"], "<u4") for r in rows])
    docs = np.concatenate([_unpack(r["docs"], r["n"], "<i8") for r in rows])
    order = np.lexsort((checks, prints))
    a, b = prints[order], checks[order]
    heads = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
    least = np.minimum.reduceat(docs[order], heads)
    bits = np.zeros(len(order), bool)
    bits[order] = np.repeat(least, np.diff(np.append(heads, len(order)))) < docs[order]
    return _replies(rows, sizes, bits)


def _runs_of(gone: np.ndarray) -> list[dict]:
    edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return [{"start": int(s), "n_words": int(e - s)} for s, e in zip(starts, ends, strict=True)]


def _remove(window: int, bits: int):
    names = ["doc_id", "n_words", "n_removed", "removed", "kept_text"]
    span = pa.struct([("start", pa.int64()), ("n_words", pa.int64())])
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(span), pa.large_string()]

    def run(batches):
        for row in itertools.chain.from_iterable(b.to_pylist() for b in batches):
            shard = Shard(row, window)
            gone = np.zeros(len(shard.hashes), bool)
            replies = row["replies"] or []
            if replies:
                probes = shard.probes()
                hit = _answers([r for r in replies if not r["second"]], probes[2], bits)
                order, heads, prints, _, least, place, doc = shard.windows(hit, probes)
                before = _answers([r for r in replies if r["second"]], prints, bits)
                sizes = np.diff(np.append(heads, len(order)))
                later = np.repeat(before, sizes) | (shard.ids[doc[order]] > np.repeat(least, sizes))
                marked = np.zeros(len(gone) + 1, np.int64)
                np.add.at(marked, place[order[later]], 1)
                np.add.at(marked, place[order[later]] + window, -1)
                gone = np.cumsum(marked[:-1]) > 0
            out = []
            for i, doc_id in enumerate(shard.doc_ids):
                own = gone[shard.first[i] : shard.first[i + 1]]
                words, n = shard.raw[shard.offsets[i] : shard.offsets[i + 1]].split(), int(own.sum())
                kept = itertools.compress(words, (~own).tolist()) if n else words
                out.append((doc_id, len(own), n, _runs_of(own) if n else [], b" ".join(kept).decode()))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names)

    return run


def _bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """``df`` stored in the shared folder, bucketed by ``key``: joins on it move the other side only."""
    spark, name, path = df.sparkSession, f"farescope_{uuid.uuid4().hex}", shared_dir(df.sparkSession)
    df.write.bucketBy(buckets, key).option("path", path).saveAsTable(name)
    out = spark.table(name)
    out.schema  # resolved: the name isn't needed any more, the files stay
    spark.sql(f"DROP TABLE {name}")
    return out


def remove_repeats(docs: DataFrame, window: int = WINDOW, shard_bytes: int = SHARD_BYTES, bucket_windows: int = BUCKET_WINDOWS) -> DataFrame:
    """(doc_id, n_words, n_removed, removed, kept_text) for every row of ``docs`` (doc_id, text).

    Words are what white space (0x20, 0x09-0x0D) parts, as they stand. A word goes if a window
    of ``window`` consecutive words of its text covers it whose words also follow each other in
    a document with a smaller doc_id; all windows are judged on the input. removed lists the
    maximal runs of such words (first word, number of words), kept_text the other words, joined
    by a blank. Texts of fewer words than a window lose none.

    A null text has no words. A null doc_id counts as larger than every other; rows with one
    doc_id, null or not, take nothing from each other. Other columns are ignored. An empty
    table gives no rows. Words of a window are compared by a 96-bit fingerprint.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    plain = rows.mapInArrow(_shards(shard_bytes), SHARD)
    size = rows.select(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / 2 / TASK_BYTES))
    shards = _bucketed(plain, "shard", parts)
    n_words = shards.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    bits = max(0, math.ceil(math.log2(max(1, n_words) / bucket_windows)))

    probes = shards.mapInArrow(_probe(window, bits), PROBES)
    first = stored(probes.groupBy("bucket").applyInArrow(_hits, REPLY))
    reply = F.struct("bucket", "n", "bits", "second")

    def answered(replies: DataFrame, how: str) -> DataFrame:
        # A shard's replies are some bits for each of its words.
        return shards.join(replies.groupBy("shard").agg(F.collect_list(reply).alias("replies")), "shard", how)

    first = first.withColumn("second", F.lit(False))
    windows = answered(first, "inner").mapInArrow(_extend(window, bits), WINDOWS)
    second = windows.groupBy("bucket").applyInArrow(_earlier, REPLY).withColumn("second", F.lit(True))
    return answered(first.unionByName(second), "left").mapInArrow(_remove(window, bits), RESULT)
