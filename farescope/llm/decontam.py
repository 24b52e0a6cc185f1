"""Benchmark passages in training text, found by binary search in suffix arrays.

Each block of training text is a shard: its word positions, sorted by the words that follow,
are its suffix array. Every suffix of every benchmark item is looked up in it by binary
search. Only positions followed by enough benchmark words can match, so only they are sorted.
A shard lives in one task; the benchmark is what all tasks share.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WordHasher, free_name, plain_words, stored, text_blocks

WINDOW = 13
# Characters of benchmark text that are sent to all executors at once: some 20 bytes each there.
BENCHMARK_CHARS = 4 << 20

MATCH = "struct<item_id:string,doc_start:bigint,item_start:bigint,n_words:bigint>"
RESULT = {
    "n_words": "bigint",
    "n_hit": "bigint",
    "n_items": "bigint",
    "items_sha256": "string",
    "contaminated": "boolean",
    "matches": f"array<{MATCH}>",
}


class Suffixes:
    """All suffixes of the benchmark items, as keys of ``window`` word numbers."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.window = window
        self.hasher = WordHasher(plain_words())
        texts = pa.array([text for _, text in items], pa.large_string())
        words = []
        for _, data, offsets in text_blocks(texts):
            starts, ends, first = self.hasher.words(data, offsets)
            h = self.hasher.hashes(data, starts, ends)
            words += [h[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
        self.vocabulary = np.unique(np.concatenate([*words, np.zeros(0, np.uint64)]))
        keys, lengths, owners, places = [], [], [], []
        for i, h in enumerate(words):
            numbers = (np.searchsorted(self.vocabulary, h) + 1).astype(">u4")
            n = min(window, len(numbers))
            for p in range(len(numbers) - n + 1 if n else 0):
                keys.append(numbers[p : p + n].tobytes())
                lengths.append(n)
                owners.append(i)
                places.append(p)
        self.names = np.array([name for name, _ in items], object)
        self.low = np.array(keys, f"S{4 * window}")
        self.high = np.array([k.ljust(4 * window, b"\xff") for k in keys], f"S{4 * window}")
        self.lengths = np.array(lengths, np.int64)
        self.owners = np.array(owners, np.int64)
        self.places = np.array(places, np.int64)
        self.shortest = int(self.lengths.min()) if keys else 0

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word in the benchmark's vocabulary, 0 for others."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.uint32)
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == hashes, at + 1, 0).astype(np.uint32)

    def find(self, numbers: np.ndarray, first: np.ndarray):
        """(word position, suffix) of every place in the shard where a suffix's window occurs."""
        nothing = np.zeros(0, np.int64)
        if not self.shortest or not len(numbers):
            return nothing, nothing
        from .common import runs

        starts, ends = runs(numbers > 0, first)
        keep = ends - starts >= self.shortest
        starts, ends = starts[keep], ends[keep]
        counts = ends - starts - self.shortest + 1
        if not counts.sum():
            return nothing, nothing
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        position = np.repeat(starts, counts) + within
        limit = np.repeat(ends, counts)
        follow = position[:, None] + np.arange(self.window)
        keys = np.where(follow < limit[:, None], numbers[np.minimum(follow, len(numbers) - 1)], 0)
        keys = np.ascontiguousarray(keys.astype(">u4")).view(f"S{4 * self.window}").ravel()
        order = np.argsort(keys, kind="stable")  # the suffix array of the shard
        position, keys = position[order], keys[order]
        low = np.searchsorted(keys, self.low, "left")
        high = np.searchsorted(keys, self.high, "right")
        found = np.flatnonzero(high > low)
        counts = (high - low)[found]
        if not len(found):
            return nothing, nothing
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        return position[np.repeat(low[found], counts) + within], np.repeat(found, counts)

    def longest(self, position: np.ndarray, suffix: np.ndarray):
        """Windows that continue each other, merged into the longest verbatim matches.

        (position, place in the item, item, words) of each.
        """
        owner, place, n = self.owners[suffix], self.places[suffix], self.lengths[suffix]
        order = np.lexsort((position, position - place, owner))
        owner, place, n, position = owner[order], place[order], n[order], position[order]
        new = np.ones(len(position), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (position[1:] != position[:-1] + 1) | (place[1:] != place[:-1] + 1)
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(position)) - 1
        return position[head], place[head], owner[head], position[tail] - position[head] + n[tail]


def summary(matches: list[dict], n_words: int) -> tuple:
    """(n_hit, n_items, items_sha256, contaminated) of one document."""
    end = hit = 0
    for s, n in sorted((m["doc_start"], m["n_words"]) for m in matches):
        hit += max(0, s + n - max(s, end))
        end = max(end, s + n)
    items = sorted({m["item_id"] for m in matches})
    digest = hashlib.sha256(",".join(items).encode()).hexdigest()
    return hit, len(items), digest, hit > 0 and 20 * hit >= n_words


def _search(columns: list[str], suffixes, full: bool):
    def run(batches):
        own: Suffixes = suffixes.value
        clean = (0, 0, hashlib.sha256(b"").hexdigest(), False)
        for batch in batches:
            n_words, matches = [], {}
            for row, data, offsets in text_blocks(batch.column("text")):
                starts, ends, first = own.hasher.words(data, offsets)
                numbers = own.number(own.hasher.hashes(data, starts, ends))
                n_words += np.diff(first).tolist()
                position, suffix = own.find(numbers, first)
                if len(position):
                    position, place, owner, n = own.longest(position, suffix)
                    doc = np.searchsorted(first, position, "right") - 1
                    for d, p, q, o, m in zip(doc, position - first[doc], place, owner, n, strict=True):
                        hit = {"item_id": own.names[o], "doc_start": int(p), "item_start": int(q), "n_words": int(m)}
                        matches.setdefault(row + int(d), []).append(hit)
            out = [batch.column(c) for c in columns] + [pa.array(n_words, pa.int64())]
            if full:
                rows = [summary(matches[i], n) if i in matches else clean for i, n in enumerate(n_words)]
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.bool_())
                out += [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            kind = pa.struct([("item_id", pa.string()), ("doc_start", pa.int64()), ("item_start", pa.int64()), ("n_words", pa.int64())])
            out.append(pa.array([matches.get(i, []) for i in range(len(n_words))], pa.list_(kind)))
            yield pa.RecordBatch.from_arrays(out, [*columns, "n_words", *(["n_hit", "n_items", "items_sha256", "contaminated"] if full else []), "matches"])

    return run


def _schema(docs: DataFrame, columns: list[str], names: list[str]) -> T.StructType:
    extra = T.StructType.fromDDL(", ".join(f"{n} {RESULT[n]}" for n in names))
    return T.StructType([docs.schema[c] for c in columns] + extra.fields)


def _summed(columns: list[str]):
    def run(batches):
        for batch in batches:
            n_words, matches = batch.column("n_words").to_pylist(), batch.column("matches").to_pylist()
            rows = [summary(m, n) for m, n in zip(matches, n_words, strict=True)]
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.bool_())
            out = [batch.column(c) for c in [*columns, "n_words"]]
            out += [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*out, batch.column("matches")], [*columns, *RESULT])

    return run


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    columns: list[str] | None = None,
    window: int = WINDOW,
    benchmark_chars: int = BENCHMARK_CHARS,
) -> DataFrame:
    """``columns`` of every document (all of them if None) and what benchmark text it holds.

    n_words: its words. matches: the longest verbatim matches, each with the item, the word
    positions in document and item, and its words; several may overlap. n_hit: words inside any
    match. n_items and items_sha256: the distinct items with a match. contaminated: a hit, and
    a twentieth of the words or more. An item of fewer than ``window`` words matches as a whole;
    items without words, and null texts on either side, match nothing. A null item_id stands for
    the empty string. Repeated rows are judged alike. Columns of ``docs`` that are named like
    the new ones are replaced. An empty table gives no rows, an empty benchmark no matches.

    A benchmark of more than ``benchmark_chars`` characters is searched for in several passes,
    each over all documents with a part of the items; an item is never cut.
    """
    spark = docs.sparkSession
    columns = [c for c in (docs.columns if columns is None else columns) if c not in RESULT]
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    items = items.where("text is not null")
    chars = items.agg(F.coalesce(F.sum(F.length("text") + 16), F.lit(0))).first()[0]
    parts = max(1, math.ceil(chars / benchmark_chars))

    def suffixes(part: int):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part) if parts > 1 else items
        rows = [(r["item_id"], r["text"]) for r in own.collect()]  # checked: a part's characters are bounded
        return spark.sparkContext.broadcast(Suffixes(rows, window))

    if parts == 1:
        needed = docs.select(*dict.fromkeys([*columns, "text"]))
        return needed.mapInArrow(_search(columns, suffixes(0), True), _schema(docs, columns, list(RESULT)))
    number = free_name(docs, "row")
    numbered = stored(docs.withColumn(number, F.monotonically_increasing_id()))
    found = None
    for part in range(parts):
        sent = suffixes(part)
        one = numbered.select(number, "text").mapInArrow(
            _search([number], sent, False), _schema(numbered, [number], ["n_words", "matches"])
        )
        one = stored(one if part == 0 else one.where(F.size("matches") > 0))
        sent.destroy()  # one part at a time
        found = one if found is None else found.unionByName(one)
    merged = found.groupBy(number).agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_list("matches")).alias("matches"))
    merged = numbered.select(number, *columns).join(merged, number).drop(number)
    return merged.mapInArrow(_summed(columns), _schema(docs, columns, list(RESULT)))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that ``contamination`` doesn't find contaminated, with their own columns.

    Nulls, repeated rows and empty tables are taken as there; column names can't clash.
    """
    others = [c for c in docs.columns if c.lower() != "text"]
    rest = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(others)], F.lit(0).alias("none")).alias("rest")
    judged = contamination(docs.select(rest, "text"), benchmark, ["rest", "text"], **options).where("not contaminated")
    own = {c: F.col("rest")[f"c{i}"].alias(c) for i, c in enumerate(others)}
    return judged.select(*[own.get(c, F.col("text").alias(c)) for c in docs.columns])
