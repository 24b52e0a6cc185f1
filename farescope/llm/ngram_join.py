"""Near duplicates: Jaccard join of word shingles, filtered under several token orders.

Two sets with a Jaccard similarity of t share a token within the first
``n - ceil(t n) + 1`` tokens of each under *every* order of all tokens. Order 1 makes the
candidates; those that share no such token under orders 2 and 3 as well are dropped before
whole sets are compared.

All orders put rare tokens first. How often a token occurs is counted over all documents
and kept in two tables of fixed size (16 MB each); they shape the orders only, never the result.
Documents with equal sets are one node. Short lists of candidates are paired in full;
long ones (large groups of near copies, common passages) are first linked to two of their
own members, and only members that are still in different components are paired. Every
pair within a list is thus compared or already connected. Candidates are compared in blocks of
sets, so that a set is sent once for many pairs and a large group is spread over many tasks.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farescope.session import broadcast_if_small

from .common import SMALL_BLOCK_BYTES, WordHasher, free_name, mix, space_words, stored, text_blocks
from .components import components

WORDS = 5
PERCENT = 80
# Cells of the table of very common tokens, bits of the table of common ones, and how many tokens
# that may hold before its threshold rises from two sets.
CELL_BITS = 24
COMMON_BITS = 27
COMMON_TOKENS = 1 << 25
VERY_COMMON = 16
# Tokens that a task counts at once.
COUNTED_TOKENS = 1 << 21
# Bits of the table of sets that are fetched for comparison.
SET_BITS = 27
# Longest list that is paired in full at once.
SHORT_LIST = 16
# Sets on each side of a block of comparisons.
BLOCK_SETS = 128
ORDERS = 3
SEEDS = np.random.default_rng(5).integers(1, 1 << 63, 16, dtype=np.uint64)


class Shingler:
    """Distinct word shingles of texts, as sorted 64-bit hashes."""

    def __init__(self, words: int = WORDS):
        self.hasher = WordHasher(space_words())
        self.k = words
        self.factors = np.random.default_rng(7).integers(1, 1 << 63, words, dtype=np.uint64) | np.uint64(1)

    def sets(self, texts):
        """One sorted uint64 array for each text."""
        k = self.k
        for _, data, offsets in text_blocks(texts, SMALL_BLOCK_BYTES):
            starts, ends, first = self.hasher.words(data, offsets)
            w = self.hasher.hashes(data, starts, ends)
            grams = np.zeros(max(0, len(w) - k + 1), np.uint64)
            for i, f in enumerate(self.factors):
                grams += w[i : len(w) - k + 1 + i] * f if len(grams) else 0
            grams = mix(grams)
            for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                if b - a >= k:
                    yield np.unique(grams[a : b - k + 1])
                elif b > a:
                    part = w[a:b] * self.factors[: b - a]
                    yield mix(np.array([part.sum() + np.uint64(b - a)], np.uint64))
                else:
                    yield np.zeros(0, np.uint64)


def prefix_length(n: int, percent: int) -> int:
    return n - -(-n * percent // 100) + 1 if n else 0


class Levels:
    """How common tokens are: 0 in one set, 1 and up in several; shared by all tasks."""

    def __init__(self, common: bytes, cells: bytes, threshold: int):
        self.common, self.cells, self.threshold = common, cells, threshold

    def of(self, tokens: np.ndarray) -> np.ndarray:
        bit = (tokens >> np.uint64(64 - COMMON_BITS)).astype(np.int64)
        common = np.frombuffer(self.common, np.uint8)[bit >> 3] >> (7 - (bit & 7)) & 1
        cells = np.frombuffer(self.cells, np.uint8)[tokens >> np.uint64(64 - CELL_BITS)]
        return np.where(common, np.maximum(cells, 1), 0)

    def shared(self, tokens: np.ndarray, level: np.ndarray) -> np.ndarray:
        """Which tokens other sets can have."""
        return level > 0 if self.threshold == 2 else np.ones(len(tokens), bool)


def ordered(tokens: np.ndarray, level: np.ndarray, order: int, length: int) -> np.ndarray:
    """Where the first ``length`` tokens are under an order: rare levels first, then a seeded hash."""
    if length >= len(tokens):
        return np.arange(len(tokens))
    rank = level.astype(np.uint64) << np.uint64(56)
    rank |= mix(tokens ^ SEEDS[order]) >> np.uint64(8)
    return np.argpartition(rank, length - 1)[: max(0, length)]


def set_id(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _packed_counts(parts: list[np.ndarray], bucket_bits: int) -> pa.RecordBatch:
    """The counts of upper token halves, packed by bucket."""
    all_ = np.sort(np.concatenate(parts))
    heads = np.flatnonzero(np.append(True, all_[1:] != all_[:-1]))
    token, n = all_[heads], np.diff(np.append(heads, len(all_))).astype(np.uint32)
    bucket = token >> np.uint32(32 - bucket_bits) if bucket_bits else np.zeros(len(token), np.uint32)
    cut = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(token))
    packed = []
    for i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        # small numbers: byte planes compress
        delta = np.diff(token[i:j], prepend=token[i : i + 1])
        planes = [x.view(np.uint8).reshape(-1, 4).T.tobytes() for x in (delta, n[i:j] - np.uint32(1))]
        packed.append(token[i : i + 1].tobytes() + b"".join(planes))
    buckets = pa.array(bucket[cut[:-1]].astype(np.int32))
    return pa.RecordBatch.from_arrays([buckets, pa.array(packed, pa.binary())], ["bucket", "packed"])


def _token_counts(words: int, bucket_bits: int, at_once: int = COUNTED_TOKENS):
    """Packed upper token halves and their counts by bucket, of ``at_once`` tokens and a document's at most.

    Batches may have any number of rows. Equal sets of a task count once.
    """

    def run(batches):
        shingler, seen = Shingler(words), set()
        parts, held = [], 0
        for batch in batches:
            for tokens in shingler.sets(batch.column(0)):
                key = set_id(tokens)
                if len(tokens) and key not in seen:
                    seen.add(key)
                    parts.append((tokens >> np.uint64(32)).astype(np.uint32))
                    held += len(tokens)
                    if held >= at_once:
                        yield _packed_counts(parts, bucket_bits)
                        parts, held = [], 0
        if parts:
            yield _packed_counts(parts, bucket_bits)

    return run


def _unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, their counts) of one batch."""
    planes = np.frombuffer(packed, np.uint8, offset=4).reshape(2, 4, -1)
    delta, more = (np.ascontiguousarray(x.T).view(np.uint32).ravel() for x in planes)
    return np.cumsum(delta, dtype=np.uint32) + np.frombuffer(packed[:4], np.uint32)[0], more.astype(np.int64) + 1


def _frequent(table: pa.Table) -> pa.Table:
    """Tokens of a bucket that occur in two sets or more, with their counts."""
    parts = [_unpack(x.as_py()) for x in table.column("packed")]
    token, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(token, kind="stable")
    token = token[order]
    heads = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
    token, n = token[heads], np.add.reduceat(n[order], heads)
    token, n = token[n > 1], n[n > 1]
    return pa.table(
        {
            "bucket": table.column("bucket").slice(0, 1).cast(pa.int32()),
            "tokens": pa.array([token.astype(np.int64)], pa.list_(pa.int64())),
            "counts": pa.array([n.astype(np.int64)], pa.list_(pa.int64())),
        }
    )


def frequency_levels(texts: DataFrame, words: int = WORDS) -> Levels:
    """How common tokens are, over all documents.

    A token is common from two sets on, or from more where over COMMON_TOKENS tokens are. Only the
    tables, whose size is fixed, reach the driver.
    """
    rows = texts.count()
    bits = min(22, max(4, math.ceil(math.log2(max(1, rows) / 4096 + 1))))
    packed = texts.mapInArrow(_token_counts(words, bits), "bucket int, packed binary")
    counted = stored(
        packed.groupBy("bucket").applyInArrow(_frequent, "bucket int, tokens array<bigint>, counts array<bigint>")
    )
    pairs = counted.select(F.explode(F.arrays_zip("tokens", "counts")).alias("p")).select("p.*")
    by_class = pairs.groupBy(F.floor(F.log2("counts")).cast("int").alias("c")).count().collect()  # 64 rows at most
    classes, threshold, total = {r["c"]: r["count"] for r in by_class}, 2, 0
    for c in sorted(classes, reverse=True):
        total += classes[c]
        if total > COMMON_TOKENS:
            threshold = 1 << (c + 1)
            break
    common = pairs.where(F.col("counts") >= threshold).select(F.shiftright("tokens", 32 - COMMON_BITS).alias("bit"))
    level = F.when(F.col("counts") < 64, F.col("counts")).otherwise(F.least(F.lit(255), 16 + 8 * F.log2("counts")))
    cells = pairs.where(F.col("counts") >= max(threshold, VERY_COMMON)).select(
        F.shiftright("tokens", 32 - CELL_BITS).cast("int").alias("cell"), level.cast("int").alias("level")
    )
    cells = cells.groupBy("cell").agg(F.max("level").alias("level"))
    return Levels(bit_table(common, COMMON_BITS), byte_table(cells, CELL_BITS), threshold)


def _sliced(bits: int):
    """Cells of a partition laid out in slices of 2 ** bits cells; a partition has whole slices."""

    def run(batches):
        slices: dict[int, np.ndarray] = {}
        for batch in batches:
            cell, level = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            order = np.argsort(cell)
            cell, level = cell[order], level[order]
            cut = np.append(np.flatnonzero(np.diff(cell >> bits, prepend=-1)), len(cell))
            for i, j in zip(cut[:-1], cut[1:], strict=True):
                out = slices.setdefault(int(cell[i]) >> bits, np.zeros(1 << bits, np.uint8))
                out[cell[i:j] & ((1 << bits) - 1)] = level[i:j]
        packed = [x.tobytes() for x in slices.values()]
        yield pa.RecordBatch.from_arrays([pa.array([*slices], pa.int32()), pa.array(packed, pa.binary())], ["slice", "packed"])

    return run


def byte_table(cells: DataFrame, bits: int) -> bytes:
    """A table of 2 ** bits bytes from (cell, level), each cell once."""
    slices = cells.repartition(F.shiftright("cell", 12)).mapInArrow(_sliced(12), "slice int, packed binary")
    table = np.zeros(1 << bits, np.uint8)
    for row in slices.collect():  # slices of 4 KB, no more than the table has
        table[row["slice"] << 12 : (row["slice"] + 1) << 12] = np.frombuffer(row["packed"], np.uint8)
    return table.tobytes()


def bit_table(marked: DataFrame, bits: int) -> bytes:
    """A table of 2 ** bits bits from the numbers (bit) of those that are set."""
    cells = marked.select(F.col("bit").cast("int").alias("bit")).groupBy(F.shiftright("bit", 3).alias("cell"))
    return byte_table(cells.agg(F.bit_or(F.expr("shiftleft(1, 7 - bit % 8)")).alias("level")), bits - 3)


def _digests(words: int, percent: int, levels):
    def run(batches):
        shingler, own, seen = Shingler(words), levels.value, set()
        for batch in batches:
            sizes, ids, prefixes = [], [], []
            for tokens in shingler.sets(batch.column("text")):
                key = set_id(tokens)
                sizes.append(len(tokens))
                ids.append(key)
                prefix = None
                if len(tokens) and key not in seen:
                    seen.add(key)
                    level = own.of(tokens)
                    at = ordered(tokens, level, 0, prefix_length(len(tokens), percent))
                    prefix = tokens[at][own.shared(tokens, level)[at]].view(np.int64)
                prefixes.append(prefix)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(ids, pa.binary()),
                    pa.array(prefixes, pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "set_id", "prefix"],
            )

    return run


def wanted_sets(ids: DataFrame) -> bytes:
    """A bit table of fixed size (16 MB) of the sets that will be compared; it may hold more."""
    head = F.conv(F.substring(F.hex("set_id"), 1, 8), 16, 10).cast("long")
    return bit_table(ids.select(F.shiftright(head, 32 - SET_BITS).alias("bit")), SET_BITS)


def _whole_sets(words: int, levels, wanted):
    def run(batches):
        bits, own = np.frombuffer(wanted.value, np.uint8), levels.value
        shingler, seen = Shingler(words), set()
        for batch in batches:
            ids, sizes, sets = [], [], []
            for tokens in shingler.sets(batch.column(0)):
                key = set_id(tokens)
                cell = int.from_bytes(key[:4], "big") >> (32 - SET_BITS)
                if not len(tokens) or not bits[cell >> 3] >> (7 - (cell & 7)) & 1 or key in seen:
                    continue
                seen.add(key)
                ids.append(key)
                sizes.append(len(tokens))
                sets.append(tokens[own.shared(tokens, own.of(tokens))].tobytes())
            arrays = [pa.array(ids, pa.binary()), pa.array(sizes, pa.int64()), pa.array(sets, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["set_id", "n", "tokens"])

    return run


def _sized(percent: int):
    return (F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent) & (F.col("a") < F.col("b"))


def _compared(levels, percent: int):
    def run(pairs: pa.Table, sets: pa.Table) -> pa.Table:
        known, own = {}, levels.value
        for key, n, packed in zip(*(sets.column(c).to_pylist() for c in ("set_id", "n", "tokens")), strict=True):
            tokens = np.frombuffer(packed, np.uint64)
            level = own.of(tokens)
            # Tokens of one set come first in every order; they are not sent, only counted.
            length = prefix_length(n, percent) - (n - len(tokens))
            known[key] = n, tokens, [tokens[ordered(tokens, level, k, length)] for k in range(1, ORDERS)]
        out = []
        for a, b in zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist(), strict=True):
            (n_a, all_a, some_a), (n_b, all_b, some_b) = known[a], known[b]
            if all(len(np.intersect1d(x, y, True)) for x, y in zip(some_a, some_b, strict=True)):
                shared = len(np.intersect1d(all_a, all_b, True))
                if shared * 100 >= (n_a + n_b - shared) * percent:
                    out.append((a, b))
        return pa.table({"a": pa.array([a for a, _ in out], pa.binary()), "b": pa.array([b for _, b in out], pa.binary())})

    return run


def _verified(pairs: DataFrame, sets: DataFrame, levels, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar: orders 2 and 3 first, then the whole sets.

    Candidates that hang together are compared in blocks, small groups many to a block.
    """
    place = stored(_placed(stored(components(pairs))))
    pairs = pairs.join(place.drop("parts").withColumnsRenamed({"node": "a", "part": "part_a"}), "a")
    pairs = pairs.join(place.select(F.col("node").alias("b"), F.col("part").alias("part_b")), "b")
    block = ["small", "group", "part_a", "part_b"]
    pairs = stored(pairs.select(*block, "a", "b"))
    members = pairs.select(*block, F.col("a").alias("set_id")).unionByName(pairs.select(*block, F.col("b").alias("set_id")))
    members = members.distinct().join(sets, "set_id").withColumnsRenamed({c: f"set_{c}" for c in block})
    members = members.groupBy(*[f"set_{c}" for c in block])
    return pairs.groupBy(*block).cogroup(members).applyInArrow(_compared(levels, percent), "a binary, b binary")


def _placed(label: DataFrame) -> DataFrame:
    """(node, small, group, part, parts): where the sets of (node, component) are compared.

    A small component shares a group with others; a large one is a group in several parts.
    """
    groups = max(1, label.count() // BLOCK_SETS)
    sizes = label.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    small, parts = F.col("size") <= BLOCK_SETS, F.ceil(F.col("size") / BLOCK_SETS)
    return label.join(sizes, "component").select(
        "node",
        small.alias("small"),
        F.when(small, F.pmod(F.xxhash64("component"), F.lit(groups))).otherwise(F.xxhash64("component")).alias("group"),
        F.pmod(F.xxhash64("node", F.lit(1)), parts).alias("part"),
        parts.alias("parts"),
    )


def _overlaps(left: list[np.ndarray], right: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """How many tokens each of ``left`` shares with each of ``right``, by products of small tables."""
    sets = left + right
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    token, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = count[column] > 1
    row, column = row[keep], (np.cumsum(count > 1) - 1)[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for c in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        i, j = np.searchsorted(column, [c, c + width])
        table = np.zeros((len(sets), width), np.float32)
        table[row[i:j], column[i:j] - c] = 1
        out += table[: len(left)] @ table[len(left) :].T
    return out.astype(np.int64)


def _block_links(levels, percent: int):
    def run(table: pa.Table) -> pa.Table:
        own = levels.value
        part = table.column("part").to_numpy()
        a, b = table.column("part_a")[0].as_py(), table.column("part_b")[0].as_py()
        left, right = np.flatnonzero(part == a), np.flatnonzero(part == b)
        n = table.column("n").to_numpy()
        component = np.unique(np.array(table.column("component").to_pylist(), object), return_inverse=True)[1]
        mask = np.minimum.outer(n[left], n[right]) * 100 >= np.maximum.outer(n[left], n[right]) * percent
        mask &= component[left][:, None] != component[right][None, :]
        if a == b:
            mask &= np.triu(np.ones(mask.shape, bool), 1)
        tokens = [np.frombuffer(x, np.uint64) for x in table.column("tokens").to_pylist()]
        level = [own.of(x) for x in tokens]
        for k in range(ORDERS):
            if mask.any():
                first = [
                    x[ordered(x, y, k, prefix_length(int(m), percent) - (int(m) - len(x)))]
                    for x, y, m in zip(tokens, level, n, strict=True)
                ]
                mask &= _overlaps([first[i] for i in left], [first[i] for i in right]) > 0
        if mask.any():
            shared = _overlaps([tokens[i] for i in left], [tokens[i] for i in right])
            mask &= shared * 100 >= (n[left][:, None] + n[right][None, :] - shared) * percent
        i, j = np.nonzero(mask)
        ids = table.column("set_id").combine_chunks()
        return pa.table({"a": ids.take(pa.array(left[i])), "b": ids.take(pa.array(right[j]))})

    return run


def _within(at: DataFrame, sets: DataFrame, levels, percent: int) -> DataFrame:
    """Links between different components among sets that long lists (token, set_id, b) tie together.

    The sets of a cluster are dealt to parts, and every two parts meet in one task, which compares
    their sets at once. A set is sent once for each part of its cluster, and no pair is written
    but those that are links.
    """
    cluster = stored(components(at.select(F.col("set_id").alias("a"), "b").distinct()))
    place = stored(_placed(cluster))
    place = place.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    place = place.select(
        F.col("node").alias("set_id"),
        "small",
        "group",
        "part",
        F.least("part", "other").alias("part_a"),
        F.greatest("part", "other").alias("part_b"),
    )
    found = place.join(at.select("set_id", "component").distinct(), "set_id").join(sets, "set_id")
    return found.groupBy("small", "group", "part_a", "part_b").applyInArrow(_block_links(levels, percent), "a binary, b binary")


def similar_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text).

    Rows whose shingle sets have a Jaccard similarity of ``percent`` / 100 or more are linked;
    component_id is the smallest doc_id that links reach. A text of fewer than ``words`` words
    is one shingle; a text without words, or a null text, has none and is linked with nothing.
    Equal texts are linked whatever their number. A repeated row is returned as often as it
    comes. A null doc_id counts as larger than all others; a component of such rows alone has a
    null component_id. Other columns are ignored. An empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    texts = docs.select("text")
    levels = spark.sparkContext.broadcast(frequency_levels(texts, words))
    rows = stored(
        docs.mapInArrow(
            _digests(words, percent, levels),
            "doc_id bigint, n_shingles bigint, set_id binary, prefix array<bigint>",
        )
    )
    lists = stored(
        rows.where("size(prefix) > 0")
        .select(F.explode("prefix").alias("token"), "set_id", F.col("n_shingles").alias("n"))
        .distinct()
    )
    size = lists.groupBy("token").agg(
        F.count(F.lit(1)).alias("m"), F.min("set_id").alias("low"), F.max("set_id").alias("high")
    )
    size = stored(size.where("m > 1"))
    n_of = lists.select("set_id", "n").distinct()

    short = lists.join(size.where(F.col("m") <= SHORT_LIST).select("token"), "token")
    left = short.select("token", F.col("set_id").alias("a"), F.col("n").alias("n_a"))
    right = short.select("token", F.col("set_id").alias("b"), F.col("n").alias("n_b"))
    paired = left.join(right, "token").where(_sized(percent)).select("a", "b")
    long = stored(lists.join(size.where(F.col("m") > SHORT_LIST), "token"))
    spokes = [
        long.select(F.col("set_id").alias("x"), "n", F.col(hub).alias("hub")).where("x <> hub").distinct()
        for hub in ("low", "high")
    ]
    hubs = n_of.select(F.col("set_id").alias("hub"), F.col("n").alias("n_hub"))
    spokes = spokes[0].unionByName(spokes[1]).distinct().join(hubs, "hub")
    spokes = spokes.select(
        F.least("x", "hub").alias("a"),
        F.greatest("x", "hub").alias("b"),
        F.when(F.col("x") < F.col("hub"), F.col("n")).otherwise(F.col("n_hub")).alias("n_a"),
        F.when(F.col("x") < F.col("hub"), F.col("n_hub")).otherwise(F.col("n")).alias("n_b"),
    ).where(_sized(percent))
    first = stored(paired.unionByName(spokes.select("a", "b")).distinct())

    # All members of long lists may be compared later on, so they are fetched at once.
    ids = first.select(F.col("a").alias("set_id")).unionByName(first.select(F.col("b").alias("set_id")))
    ids = ids.unionByName(long.select("set_id")).distinct()
    wanted = spark.sparkContext.broadcast(wanted_sets(ids))
    sets = texts.mapInArrow(_whole_sets(words, levels, wanted), "set_id binary, n bigint, tokens binary")
    sets = stored(sets.dropDuplicates(["set_id"]))
    links = stored(_verified(first, sets, levels, percent))
    label = stored(components(links))

    # Long lists whose members are in one component are done; the others are compared in full.
    at = long.select("token", "set_id").join(label.withColumnRenamed("node", "set_id"), "set_id", "left")
    at = at.select("token", "set_id", F.coalesce("component", "set_id").alias("component"))
    ends = at.groupBy("token").agg(
        F.min("component").alias("c0"), F.max("component").alias("c1"), F.min("set_id").alias("b")
    )
    at = stored(at.join(ends.where("c0 <> c1").select("token", "b"), "token"))
    if at.take(1):
        more = _within(at, sets, levels, percent)
        links = stored(links.unionByName(more))
        label = stored(components(links))

    found = rows.join(label.withColumnRenamed("node", "set_id"), "set_id", "left")
    found = found.select("doc_id", "n_shingles", F.coalesce("component", "set_id").alias("component"))
    found = stored(found)
    # A row that is alone names itself; the others meet the stored names of their components.
    linked = found.where("n_shingles > 0").groupBy("component")
    lowest = linked.agg(F.min("doc_id").alias("lowest"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    lowest = broadcast_if_small(stored(lowest.drop("rows")))
    return found.join(lowest, "component", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.coalesce("lowest", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def representatives(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of ``docs`` for each group of rows that links join, with all its columns.

    Rows are told apart by themselves, not by doc_id: different texts that share a doc_id are
    different rows. Of a group, the row with the smallest doc_id stays (null last), then the one
    whose text hashes lowest. Rows without words are linked with nothing and all stay. Nulls,
    repeated rows and an empty table are taken as ``similar_components`` takes them; column names
    can't clash.
    """
    row = free_name(docs, "row")
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()))
    found = similar_components(numbered.select(F.col(row).alias("doc_id"), "text"), words, percent)
    own = numbered.select(F.col(row).alias("doc_id"), F.col("doc_id").alias("own"), F.xxhash64("text").alias("print"))
    first = F.min(F.struct(F.col("own").isNull().alias("none"), "own", "print", "doc_id")).alias("first")
    linked = found.where("n_shingles > 0").join(own, "doc_id").groupBy("component_id").agg(first)
    alone = found.where("n_shingles = 0").select("doc_id")
    stay = stored(linked.select(F.col("first.doc_id").alias(row)).unionByName(alone.withColumnRenamed("doc_id", row)))
    return numbered.join(broadcast_if_small(stay), row, "left_semi").select(*docs.columns)
