"""Ranked lexical search for a set of items, each class of equal documents scored once.

Only words of the items' vocabulary can score. So a document is its bag: the tf vector over that
vocabulary, packed in one canonical form, with its length measure m. Documents of one bag and m
score alike for every item. They are grouped by a hash of both, equality being decided on the
bag's bytes, and of a class only the smallest doc_ids that could be ranked are kept, before and
after the shuffle; so a mass of equal documents is a handful of rows. Each class is scored once
against all items; its members then follow each other by ascending doc_id.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WordHasher, plain_words, stored, text_blocks

TOP = 10
# Characters of item text that are searched for in one pass over the documents.
ITEM_CHARS = 2 << 20
# Numbers that are added up at once when classes are scored.
STEP = 4_000_000

BAGS = "n bigint, bag binary"
SCORED = "item bigint, score bigint, members array<bigint>"


class Vocabulary:
    """The items' terms, numbered; a term is found by its hash and checked byte by byte."""

    def __init__(self, texts: list[str]):
        self.hasher = WordHasher(plain_words())
        terms: dict[bytes, int] = {}
        self.items = []
        for text in texts:
            own = set()
            for _, data, offsets in text_blocks(pa.array([text], pa.large_string())):
                starts, ends, _ = self.hasher.words(data, offsets)
                plain = self.hasher.folded(data).tobytes()
                own |= {plain[i:j] for i, j in zip(starts.tolist(), ends.tolist(), strict=True)}
            self.items.append(np.array(sorted(terms.setdefault(t, len(terms)) for t in own), np.int64))
        self.terms = list(terms)
        self.raw = np.frombuffer(b"".join(self.terms), np.uint8)
        self.sizes = np.array([len(t) for t in self.terms], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        hashes = self.hasher.hashes(self.raw, self.starts, self.starts + self.sizes) if self.terms else np.zeros(0, np.uint64)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        if (self.hashes[1:] == self.hashes[:-1]).any():
            raise ValueError("two terms of the items share a 64-bit hash")

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the word, number of the term) of the words that are terms."""
        nothing = np.zeros(0, np.int64)
        if not self.terms or not len(starts):
            return nothing, nothing
        hashes = self.hasher.hashes(data, starts, ends)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.terms) - 1)
        term = self.order[at]
        word = np.flatnonzero((self.hashes[at] == hashes) & (self.sizes[term] == ends - starts))
        term = term[word]
        if not len(word):
            return nothing, nothing
        size = self.sizes[term]
        heads = np.cumsum(size) - size
        within = np.arange(size.sum()) - np.repeat(heads, size)
        said = self.hasher.fold[data[np.repeat(starts[word], size) + within]]
        same = np.logical_and.reduceat(said == self.raw[np.repeat(self.starts[term], size) + within], heads)
        return word[same], term[same]


def pack_bag(terms: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending term numbers and their counts in one canonical form."""
    wide = max(1, math.ceil(int(counts.max()).bit_length() / 8)) if len(counts) else 1
    wide = next(w for w in (1, 2, 4, 8) if w >= wide)
    return bytes([wide]) + terms.astype("<u4").tobytes() + counts.astype(f"<u{wide}").tobytes()


def unpack_bag(bag: bytes) -> tuple[np.ndarray, np.ndarray]:
    wide = bag[0]
    n = (len(bag) - 1) // (4 + wide)
    return np.frombuffer(bag, "<u4", n, 1), np.frombuffer(bag, f"<u{wide}", n, 1 + 4 * n)


def _bags(vocabulary):
    """(doc_id, n, bag) of each document: all its terms counted, those of the vocabulary kept."""

    def run(batches):
        own: Vocabulary = vocabulary.value
        many = max(1, len(own.terms))
        for batch in batches:
            totals, bags = [], []
            for _, data, offsets in text_blocks(batch.column(1)):
                starts, ends, first = own.hasher.words(data, offsets)
                totals += np.diff(first).tolist()
                word, term = own.find(data, starts, ends)
                doc = np.searchsorted(first, word, "right") - 1
                keys = np.sort(doc * many + term)
                heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
                counts = np.diff(np.append(heads, len(keys)))
                doc, term = np.divmod(keys[heads], many)
                cuts = np.searchsorted(doc, np.arange(len(offsets)))
                bags += [pack_bag(term[i:j], counts[i:j]) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(totals, pa.int64()), pa.array(bags, pa.binary())], ["doc_id", "n", "bag"]
            )

    return run


def _holders(many: int):
    """(term, documents that hold it) of a task."""

    def run(batches):
        total = np.zeros(many, np.int64)
        for batch in batches:
            terms = [unpack_bag(b)[0] for b in batch.column(0).to_pylist()]
            total += np.bincount(np.concatenate(terms), minlength=many) if terms else 0
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["term", "df"])

    return run


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Scorer:
    """Scores of bags for all items: a sum over the terms that a bag and an item share."""

    def __init__(self, items: list[np.ndarray], weights: np.ndarray):
        owner = np.repeat(np.arange(len(items)), [len(i) for i in items])
        terms = np.concatenate([*items, np.zeros(0, np.int64)])
        order = np.argsort(terms, kind="stable")
        self.weights = weights
        self.n_items = len(items)
        self.item = owner[order]  # items by term
        self.first = np.searchsorted(terms[order], np.arange(len(weights) + 1))

    def blocks(self, bags: list[bytes], measures: np.ndarray):
        """(first bag, scores as bags x items) for runs of bags, STEP additions or one bag at a time."""
        pairs = [unpack_bag(b) for b in bags]
        load = np.cumsum([int((self.first[t + 1] - self.first[t]).sum()) + self.n_items for t, _ in ((t.astype(np.int64), c) for t, c in pairs)])
        i = 0
        while i < len(bags):
            j = max(i + 1, int(np.searchsorted(load, (load[i - 1] if i else 0) + STEP, "right")))
            terms = np.concatenate([t for t, _ in pairs[i:j]]).astype(np.int64)
            counts = np.concatenate([c.astype(np.int64) for _, c in pairs[i:j]])
            bag = np.repeat(np.arange(j - i), [len(t) for t, _ in pairs[i:j]])
            part = self.weights[terms] * ((1_000_000_000 * counts) // (1000 * counts + 8 * measures[i:j][bag]))
            many = self.first[terms + 1] - self.first[terms]
            within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            item = self.item[np.repeat(self.first[terms], many) + within]
            total = np.zeros((j - i) * self.n_items, np.int64)
            np.add.at(total, np.repeat(bag, many) * self.n_items + item, np.repeat(part, many))
            yield i, total.reshape(j - i, self.n_items)
            i = j


def _score(scorer, top: int):
    """The classes that lead in a task, for each item: ``top`` of them at most."""

    def run(batches):
        own: Scorer = scorer.value
        best: list[list] = [[] for _ in range(own.n_items)]  # (-score, smallest doc_id, members)

        def cut(i):
            best[i].sort(key=lambda x: x[:2])
            del best[i][top:]

        floor = np.zeros(own.n_items, np.int64)  # scores below can't be among the first
        for batch in batches:
            measures, members = batch.column(0).to_numpy(), batch.column(2)
            for first, scores in own.blocks(batch.column(1).to_pylist(), measures):
                rows, items = np.nonzero((scores > 0) & (scores >= floor))
                for r, i, s in zip(rows.tolist(), items.tolist(), scores[rows, items].tolist(), strict=True):
                    if s < floor[i]:
                        continue
                    ids = members[first + r].as_py()
                    best[i].append((-s, (ids[0] is None, ids[0] or 0), ids))
                    if len(best[i]) >= 4 * top:
                        cut(i)
                        floor[i] = -best[i][-1][0]
        out = []
        for i in range(own.n_items):
            cut(i)
            out += [(i, -s, ids) for s, _, ids in best[i]]
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], ["item", "score", "members"])

    return run


def _by_id(*before: Column) -> list[Column]:
    return [*before, F.col("doc_id").asc_nulls_last()]


def _item_blocks(items: DataFrame, item_chars: int):
    """The items as lists of rows that hold about ``item_chars`` characters, or one item, each."""
    chars = items.agg(F.coalesce(F.sum(F.length("text") + 16), F.lit(0))).first()[0]
    parts = max(1, math.ceil(chars / item_chars))
    own = items if parts == 1 else stored(items.withColumn("part", F.pmod(F.xxhash64("item"), F.lit(parts))))
    for part in range(parts):
        rows = (own if parts == 1 else own.where(F.col("part") == part)).select("item", "text").collect()
        yield [(r["item"], r["text"]) for r in rows]  # a part's characters are bounded


def _search(spark: SparkSession, docs: DataFrame, rows: list[tuple], top: int) -> DataFrame:
    own = Vocabulary([text for _, text in rows])
    vocabulary = spark.sparkContext.broadcast(own)
    bags = stored(docs.mapInArrow(_bags(vocabulary), T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL(BAGS).fields])))
    n_docs, length = bags.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    holders = bags.select("bag").mapInArrow(_holders(len(own.terms)), "term bigint, df bigint")
    df = holders.groupBy("term").agg(F.sum("df")).collect()  # a number for each term of the items
    weights = np.zeros(len(own.terms), np.int64)
    for term, n in df:
        weights[term] = weight(n_docs, n)
    scorer = spark.sparkContext.broadcast(Scorer(own.items, weights))

    m = F.expr(f"10 + (90 * n * {n_docs}L) div {max(1, length)}L")
    key = [F.xxhash64("bag", "m").alias("print"), "m", "bag"]
    measured = bags.where(F.length("bag") > 1).withColumn("m", m).select(*key, "doc_id")
    place = F.row_number().over(W.partitionBy("print", "m", "bag").orderBy(*_by_id()))
    first = measured.withColumn("place", place).where(F.col("place") <= top)
    order = F.array_sort(F.collect_list(F.struct("place", "doc_id")))
    classes = first.groupBy("print", "m", "bag").agg(F.transform(order, lambda x: x["doc_id"]).alias("members"))
    scored = classes.select("m", "bag", "members").mapInArrow(_score(scorer, top), SCORED)
    names = spark.createDataFrame([(i, name) for i, (name, _) in enumerate(rows)], T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", T.StringType())]))
    found = scored.select("item", "score", F.explode("members").alias("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(W.partitionBy("item").orderBy(*_by_id(F.desc("score")))))
    ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")  # a row an item


def search(docs: DataFrame, items: DataFrame, top: int = TOP, item_chars: int = ITEM_CHARS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of each item of ``items`` (item_id, text).

    Terms are runs of ASCII letters and digits and of everything beyond ASCII, A-Z as a-z. With N
    documents that have terms, L terms in all, n in the document, df documents that hold a term
    and tf occurrences in the document: a term weighs w = floor(1000 ln((2N+2) / (2df+1))), the
    document's m is 10 + (90 n N) div L, and its score is the sum of
    w * ((10^9 tf) div (1000 tf + 8 m)) over the item's different terms. Scores of 0 are left
    out; equal scores come by ascending doc_id, null last. All sums are of 64-bit integers.

    Rows of ``items`` with one item_id, null included, are one item with the terms of all. A null
    or empty text has no terms; such an item has no rows in the result. Every row of ``docs``
    (doc_id, text) is a document, repeated ones too. Other columns are ignored. Empty tables
    give no rows. Items of more than ``item_chars`` characters in all take several passes over
    the documents.
    """
    spark, kind = docs.sparkSession, items.schema["item_id"].dataType
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    texts = items.where("text is not null").select(F.col("item_id").cast("string").alias("item"), "text")
    found = None
    for rows in _item_blocks(texts, item_chars):
        joined: dict = {}
        for name, text in rows:
            joined.setdefault(name, []).append(text)
        one = _search(spark, docs, [(name, " ".join(t)) for name, t in joined.items()], top)
        found = one if found is None else found.unionByName(one)
    return found.withColumn("item_id", F.col("item_id").cast(kind))
