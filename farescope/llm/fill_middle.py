"""Fill-in-middle training examples: documents cut at two token borders and put in another order.

Where a token border lies is found from chunks. A rolling hash of the last bytes decides where a
chunk ends, so texts that share a passage share its chunks wherever the passage stands. A worker
remembers the border summary of a chunk under its whole content: how many words end in it, how
many characters it has, and whether it begins and ends inside a word. Summaries of neighbours
add up, less one word where a word runs across, and the sums tell which chunk a cut falls into;
only that chunk is looked at again. Documents never leave their task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import runs, space_words, text_blocks

# Bytes that the rolling hash sees; a chunk ends where its upper CHUNK_BITS bits are zero.
HASH_BYTES, CHUNK_BITS = 32, 10
LEAST_CHUNK, LONGEST_CHUNK = 64, 1 << 14
# Bytes of chunks whose summaries a worker remembers.
REMEMBERED_BYTES = 64 << 20

MARKS = ("<P>", "<S>", "<M>")
COLUMNS = ("n", "form", "prefix_chars", "middle_chars", "output")

_WORD = space_words()
_GEAR = np.random.default_rng(11).integers(0, 1 << 32, 256, dtype=np.uint32)


def chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the chunks of a block begin; every text that isn't empty begins one."""
    h, width = _GEAR[data], 1
    while width < HASH_BYTES:  # h[i] covers the bytes i - width + 1 .. i
        h[width:] += h[:-width] << np.uint32(width)
        width *= 2
    ends = np.flatnonzero(h >> np.uint32(32 - CHUNK_BITS) == 0) + 1
    ends = ends[np.diff(ends, prepend=-LEAST_CHUNK) >= LEAST_CHUNK]
    ends = ends[ends - offsets[np.searchsorted(offsets, ends, "right") - 1] >= HASH_BYTES]
    heads = np.unique(np.concatenate([offsets[:-1], ends]))
    heads = heads[heads < len(data)]
    size = np.diff(np.append(heads, len(data)))
    parts = -(-size // LONGEST_CHUNK)
    within = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    return np.repeat(heads, parts) + within * LONGEST_CHUNK


class ChunkSummaries:
    """Border summaries by chunk content, the ones not asked for lately forgotten.

    A summary is (words, characters, begins inside a word, ends inside a word). Lookup compares
    the whole content, so equal hashes of different chunks do no harm.
    """

    def __init__(self, limit: int = REMEMBERED_BYTES):
        self.limit, self.size = limit, 0
        self.known: dict[bytes, tuple] = {}
        self.older: dict[bytes, tuple] = {}

    @staticmethod
    def summarise(chunks: list[bytes]) -> list[tuple]:
        data = np.frombuffer(b"".join(chunks), np.uint8)
        ends = np.cumsum([len(c) for c in chunks])
        heads = np.append(0, ends[:-1])
        word = _WORD[data]
        starts, _ = runs(word, np.append(0, ends))
        words = np.diff(np.searchsorted(starts, np.append(0, ends)))
        chars = np.add.reduceat(((data & 0xC0) != 0x80).astype(np.int64), heads)
        return list(zip(words.tolist(), chars.tolist(), word[heads].tolist(), word[ends - 1].tolist(), strict=True))

    def of(self, chunks: list[bytes]) -> np.ndarray:
        """A row of (words, characters, begins, ends) for each chunk."""
        known, older = self.known, self.older
        new = []
        for c in set(chunks):
            if c not in known:
                if c in older:
                    known[c] = older[c]
                    self.size += len(c)
                else:
                    new.append(c)
        if new:
            known.update(zip(new, self.summarise(new), strict=True))
            self.size += sum(map(len, new))
        out = np.array([known[c] for c in chunks], np.int64).reshape(-1, 4)
        if self.size > self.limit // 2:
            self.older, self.known, self.size = known, {}, 0
        return out


def _end_of_word(chunk: np.ndarray, number: int) -> int:
    """Characters of the chunk up to the end of its ``number``-th word."""
    _, ends = runs(_WORD[chunk], np.array([0, len(chunk)]))
    return int(((chunk[: ends[number - 1]] & 0xC0) != 0x80).sum())


def cut_places(texts, first, second, wanted, summaries: ChunkSummaries) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens, characters before the first cut, characters between the cuts) of each text.

    The cuts come after ``first % (n + 1)`` and ``second % (n + 1)`` of a text's n tokens, the
    smaller one first; they are looked for where ``wanted`` says so.
    """
    n_rows = len(texts)
    n, before, between = (np.zeros(n_rows, np.int64) for _ in range(3))
    for row, data, offsets in text_blocks(texts):
        if not len(data):
            continue
        heads = chunk_starts(data, offsets)
        tails = np.append(heads[1:], len(data))
        raw = data.tobytes()
        words, chars, begins, ends = summaries.of([raw[i:j] for i, j in zip(heads.tolist(), tails.tolist(), strict=True)]).T
        # Words that end in a chunk: not those that go on in the next chunk of the same text.
        same = np.zeros(len(heads), bool)
        same[:-1] = ~np.isin(heads[1:], offsets)
        goes_on = np.zeros(len(heads), np.int64)
        goes_on[:-1] = ends[:-1] & begins[1:] & same[:-1]
        done = np.cumsum(words - goes_on)
        passed = np.cumsum(chars)
        bounds = np.searchsorted(heads, offsets)  # chunks of row i: bounds[i] .. bounds[i + 1]
        for i in range(len(offsets) - 1):
            a, b = int(bounds[i]), int(bounds[i + 1])
            if a == b:
                continue
            words_before, chars_before = (int(done[a - 1]), int(passed[a - 1])) if a else (0, 0)
            total = int(done[b - 1]) - words_before
            tokens = total + (not ends[b - 1])
            n[row + i] = tokens
            if not wanted[row + i]:
                continue
            places = []
            for cut in sorted((int(first[row + i]) % (tokens + 1), int(second[row + i]) % (tokens + 1))):
                if cut == tokens:
                    places.append(int(passed[b - 1]) - chars_before)
                elif cut == 0:
                    places.append(0)
                else:
                    c = int(np.searchsorted(done[a:b], words_before + cut)) + a
                    number = words_before + cut - (int(done[c - 1]) if c else 0)
                    places.append((int(passed[c - 1]) if c else 0) - chars_before + _end_of_word(data[heads[c] : tails[c]], number))
            before[row + i], between[row + i] = places[0], places[1] - places[0]
    return n, before, between


_summaries = ChunkSummaries()
_CUTS = T.StructType([T.StructField(c, T.LongType()) for c in ("n", "prefix_chars", "middle_chars")])


@F.arrow_udf(_CUTS)
def _cuts(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for texts, first, second, wanted in batches:
        found = cut_places(texts, first.to_numpy(), second.to_numpy(), wanted.to_numpy(zero_copy_only=False), _summaries)
        n, before, between = (pa.array(x, pa.int64()) for x in found)
        yield pa.StructArray.from_arrays([n, before, between], _CUTS.names)


def draws(key: Column, seed: str) -> list[Column]:
    """Four numbers below 2 ** 32 from the SHA-256 of the seed, a colon and ``key`` as text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def fill_in_middle(
    docs: DataFrame, rate: int = 50, spm_rate: int = 80, seed: str = "42", marks: tuple[str, str, str] = MARKS
) -> DataFrame:
    """``docs`` with (n, form, prefix_chars, middle_chars, output).

    A token is a word with the white space (0x20, 0x09-0x0D) before it, or the white space that
    ends a text; n counts them. ``rate`` per cent of the documents, chosen by their doc_id, are
    cut in three; ``spm_rate`` per cent of those are written suffix first (form spm), the others
    prefix first (psm). Texts that are empty or hold one of ``marks`` stay as they are (plain),
    like the rest. The marks must neither overlap nor begin with one another's ends.

    A null text counts as empty, a null doc_id draws as the empty string; repeated rows are cut
    alike. Other columns pass through, but for those named like the new ones, which are
    replaced. An empty table gives no rows. A text of any length is cut as a whole.
    """
    own = [c for c in docs.columns if c.lower() not in COLUMNS]
    prefix_mark, suffix_mark, middle_mark = map(F.lit, marks)
    text = F.coalesce(F.col("text"), F.lit(""))
    h1, h2, h3, h4 = draws(F.col("doc_id"), seed)
    plain = (text == "") | (h3 % 100 >= rate)
    for mark in marks:
        plain = plain | F.contains(text, F.lit(mark))
    form = F.when(plain, "plain").when(h4 % 100 < spm_rate, "spm").otherwise("psm")
    drawn = docs.select(F.struct(*own).alias("row"), text.alias("text"), form.alias("form"), h1.alias("h1"), h2.alias("h2"))
    cut = drawn.select("row", "text", "form", _cuts("text", "h1", "h2", F.col("form") != "plain").alias("cut"))
    text, p, m = F.col("text"), F.col("cut.prefix_chars").cast("int"), F.col("cut.middle_chars").cast("int")
    prefix, middle = F.substr(text, F.lit(1), p), F.substr(text, p + 1, m)
    suffix = F.substr(text, p + m + 1)
    output = (
        F.when(F.col("form") == "plain", text)
        .when(F.col("form") == "psm", F.concat(prefix_mark, prefix, suffix_mark, suffix, middle_mark, middle))
        .otherwise(F.concat(suffix_mark, suffix, prefix_mark, prefix, middle_mark, middle))
    )
    return cut.select(
        *[F.col("row").getField(c).alias(c) for c in own],
        F.col("cut.n").alias("n"),
        "form",
        *[F.when(F.col("form") != "plain", F.col(f"cut.{c}")).alias(c) for c in ("prefix_chars", "middle_chars")],
        output.alias("output"),
    )


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that an output of ``fill_in_middle`` was made from, read from output and form alone."""

    def part(rest: Column, mark: str) -> tuple[Column, Column]:
        piece = F.substring_index(rest, mark, 1)
        return piece, F.substr(rest, F.length(piece) + len(mark) + 1)

    prefix_mark, suffix_mark, middle_mark = marks
    prefix, rest = part(F.substr(output, F.lit(len(prefix_mark) + 1)), suffix_mark)
    suffix, middle = part(rest, middle_mark)
    psm = F.concat(prefix, middle, suffix)
    suffix, rest = part(F.substr(output, F.lit(len(suffix_mark) + 1)), prefix_mark)
    prefix, middle = part(rest, middle_mark)
    return F.when(form == "psm", psm).when(form == "spm", F.concat(prefix, middle, suffix)).otherwise(output)
