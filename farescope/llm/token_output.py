"""Token ids in compressed files: one zstandard frame for each document, one shared dictionary.

Files, below one folder:

- ``dictionary``: one row with the dictionary, its sha256, and the bytes of an id (2 or 4)
- ``blocks``: rows of about a megabyte of ids. ``data`` holds the frames of consecutive documents;
  ``offsets`` says where each begins, so a short document is read without its neighbours.
  ``part`` and ``block`` order the blocks, ``first_token`` counts the ids before a block in its
  part, ``dictionary`` names the dictionary by its sha256.

Spark writes and commits the files, so a lost executor leaves no half-written block.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import os
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WordHasher, space_words, text_blocks

END_ID = 0
# The dictionary is trained on so many documents at most, on so many characters of each.
SAMPLE_DOCUMENTS = 1000
SAMPLE_CHARS = 4096
DICTIONARY_BYTES = 32 << 10
BLOCK_IDS = 1 << 19
# Bytes of text that a task writes on average, at most.
RANGE_BYTES = 64 << 20
# Distinct pieces of text whose ids a worker remembers.
REMEMBERED = 1_200_000
CHUNK_BYTES = 1 << 20
# ASCII punctuation that a piece may begin with after an ASCII letter or digit.
POINTS = b".,;:!?#$%&*"
POINT, ALNUM, ODD_BYTES, ODD_THIRD = (np.zeros(256, bool) for _ in range(4))
POINT[list(POINTS)] = True
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = True
# White space beyond space and line feed: bytes, pairs of bytes, and third bytes after E2 80.
ODD_BYTES[[0x09, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F]] = True
ODD_PAIRS = {lead: np.isin(np.arange(256), seconds) for lead, seconds in ((0xC2, [0x85, 0xA0]), (0xE1, [0x9A]), (0xE2, [0x81]), (0xE3, [0x80]))}
ODD_THIRD[[*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF]] = True

BLOCKS = (
    "part int, block int, first_token bigint, doc_ids array<bigint>, n_tokens array<bigint>, "
    "offsets array<bigint>, data binary, dictionary string"
)


class Places:
    """Places of 64-bit keys in a list, by open addressing in arrays: whole arrays are looked up at once."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(12, int(len(keys) * 3).bit_length())
        self.slots = np.full(1 << self.bits, -1, np.int64)
        self.keys = keys
        self._put(np.arange(len(keys)))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - self.bits)).astype(np.int64)

    def _put(self, places: np.ndarray) -> None:
        at = self._slot(self.keys[places])
        while len(places):
            free = self.slots[at] < 0
            self.slots[at[free]] = places[free]  # of several for one slot the last stays
            out = self.slots[at] != places
            places, at = places[out], (at[out] + 1) & ((1 << self.bits) - 1)

    def add(self, keys: np.ndarray) -> None:
        """Append keys that aren't in the list yet."""
        places = np.arange(len(self.keys), len(self.keys) + len(keys))
        self.keys = np.concatenate([self.keys, keys])
        if len(self.keys) * 2 > len(self.slots):
            self.__init__(self.keys)
        else:
            self._put(places)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 for those that aren't in the list."""
        out = np.full(len(keys), -1, np.int64)
        open_, at = np.arange(len(keys) if len(self.keys) else 0), self._slot(keys)
        while len(open_):
            place = self.slots[at]
            same = (place >= 0) & (self.keys[place] == keys[open_])
            out[open_[same]] = place[same]
            on = (place >= 0) & ~same
            open_, at = open_[on], (at[on] + 1) & ((1 << self.bits) - 1)
        return out


class Encoder:
    """Ids of texts as packed little-endian bytes, from a byte-level BPE of the tokenizers library.

    Its pre-tokeniser always parts a text before a single space or line feed between two
    non-blank characters, and between an ASCII letter or digit and one of POINTS; what it parts is
    encoded piece by piece. So the ids of a piece are those of any earlier equal piece, and are
    remembered: pieces of a block are looked up together, by a hash that can't mistake pieces of
    up to eight bytes and a comparison of the longer ones. Texts with other white space, or with
    a special token's string, are encoded as a whole, and so is everything if the tokeniser
    parts texts in another way.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.remembered = remembered
        self.hasher = WordHasher(space_words(), fold=False)
        # Ids whose text begins with a space or a line feed, as the byte-level alphabet writes them.
        self.blank_led = np.zeros(size, bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.blank_led[i] = token[:1] in ("\u0120", "\u010a")
        self._forget()
        parts = ["\na", " b", "\nc", ",", " d", "\n1", ".5", " 'x", " \u00e9", "###"]
        self.pieces = b"".join(self._pack(parts)) == self._pack(["".join(parts)])[0]

    def _forget(self) -> None:
        self.places = Places(np.zeros(0, np.uint64))
        self.text = np.zeros(0, np.uint8)  # of the known pieces, one after another
        self.text_start = np.zeros(1, np.int64)
        self.ids = np.zeros(0, self.dtype)
        self.ids_start = np.zeros(1, np.int64)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _pack(self, texts: list[str]) -> list[bytes]:
        return [np.array(ids, self.dtype).tobytes() for ids in self._ids(texts)]

    def _learn(self, keys: np.ndarray, pieces: list[bytes]) -> None:
        """Remember new pieces. Those that begin with a blank are encoded as one text, and parted again there."""
        led = np.array([p[0] in b" \n" for p in pieces], bool)
        counts = np.zeros(len(pieces), np.int64)
        joined = b"".join(p for p, x in zip(pieces, led, strict=True) if x).decode()
        one = np.array(self._ids([joined])[0] if joined else [], self.dtype)
        heads = np.flatnonzero(self.blank_led[one])
        if len(heads) != led.sum():
            raise ValueError("the tokeniser doesn't part texts at blanks")
        counts[led] = np.diff(np.append(heads, len(one)))
        rest = self._ids([p.decode() for p, x in zip(pieces, led, strict=True) if not x])
        counts[~led] = [len(x) for x in rest]
        order = np.concatenate([np.flatnonzero(led), np.flatnonzero(~led)])
        ids = np.concatenate([one, np.fromiter(itertools.chain.from_iterable(rest), self.dtype)])
        self.places.add(keys[order])
        text = [pieces[i] for i in order]
        self.text = np.concatenate([self.text, np.frombuffer(b"".join(text), np.uint8)])
        self.text_start = np.append(self.text_start, self.text_start[-1] + np.cumsum([len(p) for p in text]))
        self.ids = np.concatenate([self.ids, ids])
        self.ids_start = np.append(self.ids_start, self.ids_start[-1] + np.cumsum(counts[order]))

    def _whole(self, raw: bytes, data: np.ndarray, blank: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which texts can't be taken piece by piece."""
        odd = ODD_BYTES[data]
        odd[1:] |= blank[1:] & blank[:-1]
        filled = offsets[1:] > offsets[:-1]
        odd[offsets[:-1][filled]] |= blank[offsets[:-1][filled]]
        odd[offsets[1:][filled] - 1] |= blank[offsets[1:][filled] - 1]
        at = [np.flatnonzero(odd)]
        for lead, seconds in ODD_PAIRS.items():
            here = np.flatnonzero(data[:-1] == lead)
            at.append(here[seconds[data[here + 1]]])
        triple = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x80))
        at.append(triple[ODD_THIRD[data[triple + 2]]])
        for word in self.special:
            place = raw.find(word)
            while place >= 0:
                at.append(np.array([place]))
                place = raw.find(word, place + 1)
        out = np.zeros(len(offsets) - 1, bool)
        out[np.searchsorted(offsets, np.concatenate(at), "right") - 1] = True
        return out

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The packed ids of each text; null counts as empty."""
        out: list[bytes] = []
        for _, data, offsets in text_blocks(texts, CHUNK_BYTES):
            out += self._block(data, offsets)
        return out

    def _block(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        raw, rows = data.tobytes(), len(offsets) - 1
        blank = (data == 0x20) | (data == 0x0A)
        whole = self._whole(raw, data, blank, offsets) if self.pieces and len(data) else np.ones(rows, bool)
        texts = [raw[i:j].decode() for i, j, w in zip(offsets[:-1], offsets[1:], whole, strict=True) if w]
        alone = iter(self._pack(texts) if texts else [])
        if whole.all():
            return list(alone)
        cut = blank.copy()
        cut[1:] |= POINT[data[1:]] & ALNUM[data[:-1]]
        cut[offsets[:-1][offsets[:-1] < len(data)]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(data))
        taken = ~whole[np.searchsorted(offsets, starts, "right") - 1]
        starts, ends = starts[taken], ends[taken]
        keys = self.hasher.hashes(data, starts, ends)
        place = self.places.find(keys)
        if (place < 0).any():
            new, first = np.unique(keys[place < 0], return_index=True)
            if len(self.places.keys) + len(new) > self.remembered:
                self._forget()
                new, first = np.unique(keys, return_index=True)
                i, j = starts[first], ends[first]
            else:
                i, j = starts[place < 0][first], ends[place < 0][first]
            self._learn(new, [raw[a:b] for a, b in zip(i.tolist(), j.tolist(), strict=True)])
            place = self.places.find(keys)
        self._compare(data, starts, ends, place)
        count = self.ids_start[place + 1] - self.ids_start[place]
        upto = np.cumsum(count)
        ids = self.ids[np.repeat(self.ids_start[place] - (upto - count), count) + np.arange(upto[-1])]
        bounds = np.append(0, upto)[np.searchsorted(starts, offsets)]
        return [next(alone) if w else ids[i:j].tobytes() for w, i, j in zip(whole, bounds[:-1], bounds[1:], strict=True)]

    def _compare(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, place: np.ndarray) -> None:
        """That each piece is the known one, not one with the same hash."""
        size = ends - starts
        known = self.text_start[place + 1] - self.text_start[place]
        long = np.flatnonzero(size > 8)
        n = size[long]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        same = (size == known).all()
        if same:
            here = data[np.repeat(starts[long], n) + within]
            same = (here == self.text[np.repeat(self.text_start[place[long]], n) + within]).all()
        if not same:
            raise ValueError("two pieces of text share a 64-bit hash")


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _train(tokenizer: str):
    def run(batches):
        samples = [x for b in batches for x in encoder(tokenizer).encode(b.column(0)) if x]
        data, raw = b"", b"".join(samples)
        if samples:
            try:
                data = zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
            except zstandard.ZstdError:  # too few samples: the samples themselves
                data = raw[:DICTIONARY_BYTES]
        yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["dictionary"])

    return run


def _frames(dictionary: bytes, compress: bool):
    shared = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
    return zstandard.ZstdCompressor(level=3, **shared) if compress else zstandard.ZstdDecompressor(**shared)


def _blocks(tokenizer: str, dictionary: bytes, end_id: int):
    name = hashlib.sha256(dictionary).hexdigest()
    schema = pa.schema(
        [
            ("part", pa.int32()),
            ("block", pa.int32()),
            ("first_token", pa.int64()),
            ("doc_ids", pa.list_(pa.int64())),
            ("n_tokens", pa.list_(pa.int64())),
            ("offsets", pa.list_(pa.int64())),
            ("data", pa.binary()),
            ("dictionary", pa.string()),
        ]
    )

    def run(batches):
        part, codec, enc = TaskContext.get().partitionId(), _frames(dictionary, True), encoder(tokenizer)
        end = np.array([end_id], enc.dtype).tobytes()
        block = first = 0
        doc_ids, sizes, frames = [], [], []

        def row():
            offsets = np.cumsum([0, *map(len, frames)])
            values = [part, block, first, doc_ids, sizes, offsets, b"".join(frames), name]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema, strict=True)], schema=schema)

        for batch in batches:
            for doc_id, data in zip(batch.column(0).to_pylist(), enc.encode(batch.column(1)), strict=True):
                data += end
                doc_ids.append(doc_id)
                sizes.append(len(data) // enc.dtype.itemsize)
                frames.append(codec.compress(data))
                if sum(sizes[-1:]) >= BLOCK_IDS or len(sizes) % 64 == 0 and sum(sizes) >= BLOCK_IDS:
                    yield row()
                    block, first = block + 1, first + sum(sizes)
                    doc_ids, sizes, frames = [], [], []
        if doc_ids:
            yield row()

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Write the ids of every text of ``docs`` (doc_id, text), each followed by ``end_id``.

    Documents are in ascending order of doc_id, null first, rows with one doc_id in an order of
    their texts; repeated rows stay repeated. A null text counts as empty. Other columns are
    ignored. An empty table writes files without blocks. Each text is encoded once.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    key = F.xxhash64("doc_id", "text")
    sample = docs.where("text <> ''").select(F.substring("text", 1, SAMPLE_CHARS).alias("text"), key.alias("key"))
    sample = sample.orderBy("key", "text").limit(SAMPLE_DOCUMENTS).select("text").coalesce(1)
    trained = sample.mapInArrow(_train(tokenizer), "dictionary binary").first()  # None without texts
    dictionary = bytes(trained[0]) if trained else b""
    width = encoder(tokenizer).dtype.itemsize
    row = [(dictionary, hashlib.sha256(dictionary).hexdigest(), width)]
    docs.sparkSession.createDataFrame(row, "dictionary binary, sha256 string, width int").coalesce(1).write.parquet(f"{path}/dictionary")
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    ranges = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / RANGE_BYTES))
    ordered = docs.withColumn("key", key).repartitionByRange(ranges, "doc_id", "key").sortWithinPartitions("doc_id", "key", "text")
    ordered.select("doc_id", "text").mapInArrow(_blocks(tokenizer, dictionary, end_id), BLOCKS).write.parquet(f"{path}/blocks")


def _read(dictionary: bytes, sha256: str, width: int, with_ids: bool):
    def run(batches):
        codec = _frames(dictionary, False)
        for batch in batches:
            for r in batch.to_pylist():
                if r["dictionary"] != sha256:
                    raise ValueError(f"block written with dictionary {r['dictionary']}, not {sha256}")
                ids, n, crc, at = [], [], [], [r["start"]]
                for i, j, size in zip(r["offsets"], r["offsets"][1:], r["n_tokens"], strict=False):
                    x = np.frombuffer(codec.decompress(r["data"][i:j]), f"<u{width}").astype("<u4")
                    if len(x) != size:
                        raise ValueError("a frame doesn't hold as many ids as its index says")
                    crc.append(zlib.crc32(x.tobytes()))
                    n.append(size)
                    at.append(at[-1] + size)
                    if with_ids:
                        ids.append(x)
                out = [pa.array(r["doc_ids"], pa.int64()), pa.array(at[:-1], pa.int64()), pa.array(n, pa.int64()), pa.array(crc, pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    out, names = [*out, pa.array(ids, pa.list_(pa.int64()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(out, names)

    return run


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None, ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the documents in the files below ``path``.

    start: ids of all documents before it. ids_crc32: of the ids as little-endian unsigned
    32-bit integers. ``ids`` adds the ids themselves. ``doc_ids`` reads only the blocks that hold
    one of these documents.
    """
    head = spark.read.parquet(f"{path}/dictionary").first()
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    total = blocks.select("part", F.aggregate("n_tokens", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n"))
    parts = total.groupBy("part").agg(F.sum("n").alias("n"))  # a row for each writing task
    before = F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", before.alias("before"))
    if doc_ids is not None:
        blocks = blocks.where(F.arrays_overlap("doc_ids", F.array(*[F.lit(int(i)).cast("bigint") for i in doc_ids])))
    blocks = blocks.join(parts, "part").withColumn("start", F.col("before") + F.col("first_token"))
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<bigint>" if ids else "")
    found = blocks.select("doc_ids", "n_tokens", "offsets", "data", "dictionary", "start").mapInArrow(
        _read(bytes(head["dictionary"]), head["sha256"], head["width"], ids), schema
    )
    return found if doc_ids is None else found.where(F.col("doc_id").isin([int(i) for i in doc_ids]))
