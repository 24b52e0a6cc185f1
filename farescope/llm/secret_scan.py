"""Secrets in text: patterns, and a battery of randomness tests on long tokens.

Every long token gets an encoding by its characters (hex, base32, lower, base64). Three tests ask
whether it looks drawn at random from that alphabet: chi-squared uniformity, the number of runs
above and below the middle, and the correlation of neighbours. Their p-values are combined.

How often plain text passes depends on the encoding and the length, so each pair of them has its
own limit: the lowest p-value at which the share of false discoveries stays below a bound. What
plain text does is learnt from decoys: tokens of that encoding and length, drawn from a model of
which letter follows which in the whole corpus. So there are decoys for every length, whatever
words the corpus has. The counts behind it cover all documents and are tables of fixed size.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import runs, stored, text_blocks

KINDS = ("assign", "access", "hex", "random")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX, LEAST_TOKEN = 12, 18, 16, 20

ENCODINGS = ("hex", "base32", "lower", "base64")
STRATA = (20, 24, 32, 40, 48, 64, 96, 128)
BINS = 100
FALSE_DISCOVERIES = 0.05
# Decoys for each encoding and length, and characters of a kind that each is given at least.
DECOYS = 10_000
PLANTED = 2

FOUND = (
    "doc_id bigint, base array<struct<start:bigint,kind:int,end:bigint>>, base_sha256 string, "
    "tokens array<struct<start:bigint,end:bigint,cell:int,p:double>>"
)


def _table(chars: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[ord(c) for c in chars]] = True
    return table


DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
HEX_BYTES = _table(DIGITS + "abcdef")
TOKEN_BYTES = _table(DIGITS + LOWER + UPPER + "+/_-")
ALPHABETS = {
    "hex": DIGITS + "abcdef",
    "base32": UPPER + "234567",
    "lower": DIGITS + LOWER,
    "base64": UPPER + LOWER + DIGITS + "+/",
}
# Codes of the model: places in the base64 alphabet, the URL-safe signs included; CODES for no code.
CODES = len(ALPHABETS["base64"])
CODE = np.full(256, CODES, np.int64)
for _c, _chars in enumerate(ALPHABETS["base64"]):
    CODE[ord(_chars)] = _c
CODE[ord("-")], CODE[ord("_")] = CODE[ord("+")], CODE[ord("/")]


def encoding(token: str) -> tuple[str, str] | None:
    """(encoding, token in its alphabet), or None for what can't be a key, such as numbers."""
    kinds = {("d" if c in DIGITS else "l" if c in LOWER else "u" if c in UPPER else "s") for c in token}
    if "d" not in kinds or kinds <= {"d", "s"}:
        return None
    if "s" not in kinds:
        low = token.lower()
        if ("l" in kinds) != ("u" in kinds) and set(low) <= set(ALPHABETS["hex"]):
            return "hex", low
        if "l" not in kinds and set(token) <= set(ALPHABETS["base32"]):
            return "base32", token
        if "u" not in kinds or "l" not in kinds:
            return "lower", low
    if {"d", "l", "u"} <= kinds:
        return "base64", token.replace("-", "+").replace("_", "/")
    return None


def _tail(z: np.ndarray) -> np.ndarray:
    return 0.5 * _erfc(z / math.sqrt(2))


_erfc = np.vectorize(math.erfc, otypes=[float])


def randomness(x: np.ndarray, k: int) -> np.ndarray:
    """Combined p-values of three tests, small for rows of ``x`` that aren't random numbers below ``k``."""
    rows, n = x.shape
    counts = np.bincount((x + k * np.arange(rows)[:, None]).ravel(), minlength=rows * k).reshape(rows, k)
    chi = ((counts - n / k) ** 2).sum(axis=1) * k / n
    uniform = _tail((chi - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n))
    with np.errstate(divide="ignore", invalid="ignore"):
        above = x >= k / 2
        a = above.sum(axis=1)
        mean = 1 + 2 * a * (n - a) / n
        variance = (mean - 1) * (mean - 2) / (n - 1)
        r = 1 + (above[:, 1:] != above[:, :-1]).sum(axis=1)
        run = 2 * _tail(np.where(variance > 0, np.abs(r - mean) / np.sqrt(variance), 0.0))
        run = np.where((a == 0) | (a == n), 0.0, run)
        d = x - x.mean(axis=1, keepdims=True)
        total = (d * d).sum(axis=1)
        serial = 2 * _tail(np.where(total > 0, np.abs((d[:, 1:] * d[:, :-1]).sum(axis=1) / total + 1 / n) * math.sqrt(n), 0.0))
        serial = np.where(total > 0, serial, 0.0)
    s = -sum(np.log(np.maximum(p, 1e-300)) for p in (uniform, run, serial))
    return np.exp(-s) * (1 + s + s * s / 2)  # Fisher, six degrees of freedom


def _numbers(token: str, kind: str) -> np.ndarray:
    return np.array([[ALPHABETS[kind].index(c) for c in token]])


def _letters(batches):
    """(pair, n): how often a character follows another within words of the alphabet, in a task.

    CODES stands for the border of a word on either side, and for tokens that are tested.
    """
    side = CODES + 1
    total = np.zeros(side * side, np.int64)
    for batch in batches:
        for _, data, offsets in text_blocks(batch.column(0)):
            code = CODE[data]
            starts, ends = runs(TOKEN_BYTES[data], offsets)
            edge = np.zeros(len(data) + 1, np.int64)
            long = ends - starts >= LEAST_TOKEN
            np.add.at(edge, starts[long], 1)
            np.add.at(edge, ends[long], -1)
            code[np.cumsum(edge[:-1]) > 0] = CODES  # what is to be judged isn't part of the model
            # a border before each text, so that texts don't run into each other
            code = np.insert(code, offsets[:-1], CODES)
            code = np.append(code, CODES)
            total += np.bincount(code[:-1] * side + code[1:], minlength=side * side)
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["pair", "n"])


def decoys(pairs: dict[int, int], length: int, kind: str, n: int = DECOYS, seed: int = 7) -> np.ndarray:
    """``n`` tokens of plain text in one encoding, as rows of numbers.

    Words of the model are strung together and written in the encoding, characters that it
    doesn't have left out. As a token of an encoding holds digits, and of base64 both cases, each
    decoy is given PLANTED of them at least, at random places.
    """
    rng = np.random.default_rng([seed, length, ENCODINGS.index(kind)])
    alphabet, side = ALPHABETS[kind], CODES + 1
    table = np.zeros((side, side))
    for pair, count in pairs.items():
        table[divmod(pair, side)] = count
    table[CODES, CODES] = 0  # no empty words
    table += np.full(side, 1e-9)  # an empty corpus: any character
    step = (table / table.sum(axis=1, keepdims=True)).cumsum(axis=1)
    written = np.full(side, -1)  # the number of each code in the encoding
    for c, char in enumerate(ALPHABETS["base64"]):
        char = char if kind == "base64" else char.upper() if kind == "base32" else char.lower()
        written[c] = alphabet.find(char)
    out = np.zeros((n, length), np.int64)
    size, state, rows = np.zeros(n, np.int64), np.full(n, CODES), np.arange(n)
    for _ in range(60 * length):
        state = np.minimum((step[state] < rng.random(n)[:, None]).sum(axis=1), CODES)
        put = (written[state] >= 0) & (size < length)
        out[rows[put], size[put]] = written[state[put]]
        size += put
        if (size == length).all():
            break
    # What a corpus of other scripts can't fill is random: that makes a limit stricter.
    short = np.arange(length) >= size[:, None]
    out[short] = rng.integers(0, len(alphabet), int(short.sum()))
    groups = [DIGITS] if kind != "base64" else [DIGITS, UPPER, LOWER]
    place = rng.random((n, length)).argsort(axis=1)
    for g, group in enumerate(groups):
        numbers = np.array([i for i, c in enumerate(alphabet) if c in group])
        for j in range(PLANTED):
            out[rows, place[:, g * PLANTED + j]] = rng.choice(numbers, n)
    return out


def _positions(data: bytes, word: bytes):
    at = data.find(word)
    while at >= 0:
        yield at
        at = data.find(word, at + 1)


def _scan(batches):
    span = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
    token = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("cell", pa.int32()), ("p", pa.float64())])
    nothing = hashlib.sha256(b"").hexdigest()
    for batch in batches:
        n = batch.num_rows
        base: list[list] = [[] for _ in range(n)]
        tokens: list[list] = [[] for _ in range(n)]
        for row, data, offsets in text_blocks(batch.column("text")):
            raw = data.tobytes()
            low = raw.lower()
            assigned = {at for word in KEYWORDS for at in _positions(low, word)}
            keyed = set((np.searchsorted(offsets, sorted(assigned), "right") - 1).tolist()) if assigned else set()
            accessed = [*_positions(raw, b"AKIA")]
            accessed = set((np.searchsorted(offsets, accessed, "right") - 1).tolist()) if accessed else set()
            spans: dict[int, list] = {}
            for kind, table, least in (("hex", HEX_BYTES, LEAST_HEX), ("token", TOKEN_BYTES, LEAST_TOKEN)):
                starts, ends = runs(table[data], offsets)
                keep = ends - starts >= least
                for s, e in zip(starts[keep].tolist(), ends[keep].tolist(), strict=True):
                    doc = int(np.searchsorted(offsets, s, "right")) - 1
                    spans.setdefault(doc, []).append((kind, s - int(offsets[doc]), e - int(offsets[doc])))
            for doc in keyed | accessed | spans.keys():
                part = raw[offsets[doc] : offsets[doc + 1]]
                text = part.decode()
                own = base[row + doc]
                if doc in keyed:
                    own += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
                if doc in accessed:
                    own += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
                point = None
                if len(text) < len(part):  # code points before each byte
                    view = np.frombuffer(part, np.uint8)
                    point = np.concatenate([[0], np.cumsum((view & 0xC0) != 0x80)])
                for kind, s, e in spans.get(doc, ()):
                    a, b = (s, e) if point is None else (int(point[s]), int(point[e]))
                    if kind == "hex":
                        own.append((a, 2, b))
                    elif not (s and part[s - 1] >= 0x80 or e < len(part) and part[e] >= 0x80):
                        found = encoding(text[a:b])
                        if found:
                            stratum = int(np.searchsorted(STRATA, b - a, "right")) - 1
                            cell = ENCODINGS.index(found[0]) * len(STRATA) + stratum
                            p = float(randomness(_numbers(found[1], found[0]), len(ALPHABETS[found[0]]))[0])
                            tokens[row + doc].append((a, b, cell, p))
                own.sort()
        hashes = [
            hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in b).encode()).hexdigest() if b else nothing for b in base
        ]
        out = [
            batch.column("doc_id"),
            pa.array([[dict(zip(("start", "kind", "end"), x, strict=True)) for x in b] for b in base], pa.list_(span)),
            pa.array(hashes, pa.string()),
            pa.array([[dict(zip(("start", "end", "cell", "p"), x, strict=True)) for x in t] for t in tokens], pa.list_(token)),
        ]
        yield pa.RecordBatch.from_arrays(out, ["doc_id", "base", "base_sha256", "tokens"])


def limits(counts: dict[tuple[int, int], int], pairs: dict[int, int], q: float = FALSE_DISCOVERIES) -> dict[int, float]:
    """The least p-value that counts as a secret, for each cell of encoding and length.

    ``counts`` has the number of tokens by (cell, bin of p), ``pairs`` the letters of the corpus.
    Tokens are a mixture: random ones have p-values spread evenly, plain ones those of the
    decoys. The share of plain ones follows from the lowest bin, and the false discoveries are
    the plain tokens times the share of decoys that pass. A cell in which no limit keeps them
    below ``q`` of the discoveries has none, and none of its tokens is a secret.
    """
    table = np.zeros((len(ENCODINGS), len(STRATA), BINS))
    for (cell, b), n in counts.items():
        table[cell // len(STRATA), cell % len(STRATA), b] += n
    from_here = table[:, :, ::-1].cumsum(axis=2)[:, :, ::-1]
    out = {}
    for e, kind in enumerate(ENCODINGS):
        for s, length in enumerate(STRATA):
            tokens = from_here[e, s]
            if not tokens[0]:
                continue
            p = randomness(decoys(pairs, length, kind), len(ALPHABETS[kind]))
            bins = np.minimum((p * BINS).astype(int), BINS - 1)
            passed = np.bincount(bins, minlength=BINS)[::-1].cumsum()[::-1]
            share = (passed + 1) / (len(p) + 1)
            lowest, even = 1 - share[1], 1 / BINS
            plain = 1.0
            if lowest > even:
                plain = min(1.0, max(0.0, ((table[e, s, 0] + 1) / (tokens[0] + 1) - even) / (lowest - even)))
            good = np.flatnonzero((tokens > 0) & (plain * share * tokens[0] <= q * tokens))
            good = good[good > 0]  # the lowest bin is what plain tokens fill
            if len(good):
                out[e * len(STRATA) + s] = good[0] / BINS
    return out


def scan(docs: DataFrame, q: float = FALSE_DISCOVERIES) -> DataFrame:
    """Secrets of every row of ``docs`` (doc_id, text), as spans in code points, end exclusive.

    n_assign, n_access and n_hex count what the patterns find, base_sha256 digests those spans,
    and spans lists them and the random tokens that lie within none of them, as kind:start:end
    by start, then kind. A null or empty text has no spans. Repeated rows are scanned alike; other
    columns are ignored; an empty table gives no rows.
    """
    found = stored(docs.select("doc_id", "text").mapInArrow(_scan, FOUND))
    bins = found.select(F.explode("tokens").alias("t")).select(
        F.col("t.cell").alias("cell"), F.least(F.floor(F.col("t.p") * BINS), F.lit(BINS - 1)).cast("int").alias("bin")
    )
    counts = {(r["cell"], r["bin"]): r["count"] for r in bins.groupBy("cell", "bin").count().collect()}  # 3,200 at most
    pairs = docs.select("text").mapInArrow(_letters, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n"))
    pairs = dict(map(tuple, pairs.collect())) if counts else {}  # 4,225 at most
    least = [x for item in limits(counts, pairs, q).items() for x in item]
    none = F.lit(None).cast("double")
    limit = (lambda c: F.create_map(*map(F.lit, least))[c]) if least else (lambda c: none)
    added = F.filter(
        "tokens",
        lambda t: (F.coalesce(t["p"] >= limit(t["cell"]), F.lit(False)))
        & ~F.exists("base", lambda b: (b["start"] <= t["start"]) & (b["end"] >= t["end"])),
    )
    added = F.transform(added, lambda t: F.struct(t["start"].alias("start"), F.lit(3).alias("kind"), t["end"].alias("end")))
    names = F.array(*map(F.lit, KINDS))
    text = F.transform(
        F.array_sort(F.concat("base", added)),
        lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string")),
    )
    count = lambda kind: F.size(F.filter("base", lambda b: b["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{KINDS[k]}") for k in range(3)],
        "base_sha256",
        F.array_join(text, ",").alias("spans"),
    )
