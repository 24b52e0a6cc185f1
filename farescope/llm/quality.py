"""Quality scores: ridge regression on random Fourier features, calibrated by isotonic regression.

The features of a text are statistics of its bytes, words and lines. Random cosines of the
standardised features approximate a Gaussian kernel. Each task sums its share of the normal
equations; the sums, whose size is fixed, are added up in a tree and solved. Scores of rows set
aside are counted in narrow bins, and the pooled bins give the probability.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SMALL_BLOCK_BYTES, runs, space_words, stored, text_blocks

FOURIER = 256
GAMMA_SCALE = 4.0
RIDGE = 1.0
BINS = 512
# Labelled rows that a model is fitted on at most: those with the smallest hashes of their ids.
FIT_ROWS = 400_000
CALIBRATION_SHARE = 4
SEED = 17
THRESHOLD = 0.3

FEATURES = (
    "log_chars", "log_words", "word_length", "word_length_deviation", "long_words", "upper", "digits",
    "points", "symbols", "bars", "beyond_ascii", "lines_per_word", "repeated_lines", "distinct_words",
    "top_word", "words_with_symbols", "upper_words", "exclamations", "vowels", "distinct_pairs", "top_line",
)


def _class(chars: str) -> np.ndarray:
    table = np.zeros(256, np.float64)
    table[[ord(c) for c in chars]] = 1
    return table


CLASSES = np.stack(
    [
        _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        _class("0123456789"),
        _class(".,;:?'\"()-"),
        _class("#$%&*@^~+=<>{}[]\\/_`"),
        _class("|"),
        _class("!"),
        _class("aeiouAEIOU"),
    ],
    axis=1,
)
SYMBOL = (CLASSES[:, 3] + CLASSES[:, 4] + CLASSES[:, 5]) > 0


def statistics(texts) -> np.ndarray:
    """FEATURES of each text, a row each; a text without words has zeros."""
    out = []
    is_word = space_words()
    for _, data, offsets in text_blocks(texts, SMALL_BLOCK_BYTES):
        starts, ends = runs(is_word[data], offsets)
        first = np.searchsorted(starts, offsets)
        length = ends - starts
        symbols = np.concatenate([[0], np.cumsum(SYMBOL[data])])
        upper = np.concatenate([[0], np.cumsum(CLASSES[data, 0])])
        has_symbol = symbols[ends] > symbols[starts]
        all_upper = (upper[ends] - upper[starts]) * 2 > length
        raw = data.tobytes()
        for i in range(len(offsets) - 1):
            a, b = int(offsets[i]), int(offsets[i + 1])
            p, q = int(first[i]), int(first[i + 1])
            n = q - p
            if not n:
                out.append(np.zeros(len(FEATURES)))
                continue
            counts = np.bincount(data[a:b], minlength=256)
            share = counts @ CLASSES / (b - a)
            text = raw[a:b]
            words = text.split()
            tally: dict[bytes, int] = {}
            for w in words:
                tally[w] = tally.get(w, 0) + 1
            lines = [x for x in text.split(b"\n") if x]
            line_tally: dict[bytes, int] = {}
            for x in lines:
                line_tally[x] = line_tally.get(x, 0) + 1
            pairs = len(set(zip(words, words[1:], strict=False)))
            size = length[p:q]
            out.append(
                np.array(
                    [
                        math.log1p(b - a), math.log1p(n), size.mean(), size.std(), (size > 15).mean(),
                        share[0], share[1], share[2], share[3], share[4], counts[128:].sum() / (b - a),
                        len(lines) / n, 1 - len(line_tally) / max(1, len(lines)), len(tally) / max(1, len(words)),
                        max(tally.values(), default=0) / max(1, len(words)), has_symbol[p:q].mean(), all_upper[p:q].mean(), share[5], share[6],
                        pairs / max(1, len(words) - 1), max(line_tally.values(), default=0) / max(1, len(lines)),
                    ]
                )
            )
    return np.array(out).reshape(-1, len(FEATURES))


@dataclass
class Model:
    """A fitted scorer; small, and sent to the tasks as it is."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    edges: np.ndarray
    levels: np.ndarray

    def fourier(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.directions + self.phases
        return np.hstack([np.cos(z) * math.sqrt(2 / len(self.phases)), np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.fourier(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.edges, self.levels) if len(x) else np.zeros(0)


def pooled(n: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Isotonic regression of good / n over bins in order: adjacent violators pooled."""
    blocks: list[list[float]] = []
    for i in range(len(n)):
        blocks.append([good[i], n[i], 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            g, m, k = blocks.pop()
            blocks[-1] = [blocks[-1][0] + g, blocks[-1][1] + m, blocks[-1][2] + k]
    return np.concatenate([np.full(int(k), g / m) for g, m, k in blocks]) if blocks else np.zeros(0)


def _features(batches):
    for batch in batches:
        x = statistics(batch.column(2)).astype(np.float32)
        values = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float32()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), values], ["key", "label", "x"])


def _matrix(column) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64).reshape(-1, len(FEATURES))


def _equations(model: Model):
    def run(batches):
        size = FOURIER + 1
        left, right = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                part = batch.slice(i, 4096)
                z = model.fourier(_matrix(part.column("x")))
                left += z.T @ z
                right += z.T @ part.column("label").to_numpy().astype(float)
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([left.ravel(), right]).tobytes()], pa.binary())], ["sums"])

    return run


def _added(batches):
    total = np.zeros((FOURIER + 1) * (FOURIER + 2))
    for batch in batches:
        for x in batch.column(0):
            total += np.frombuffer(x.as_py())
    yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])


def _raw(model: Model):
    def run(batches):
        for batch in batches:
            raw = model.raw(_matrix(batch.column("x")))
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(raw)], ["label", "raw"])

    return run


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, seed: int = SEED) -> Model:
    """A model from the texts of ``docs`` (doc_id, text) that ``labels`` (doc_id, label 0 or 1) names.

    About ``fit_rows`` labels at most are used, those with the smallest hashes. Three of four, by
    another hash, fit the weights; the others calibrate. Null labels and ids are left out, null
    texts count as empty. Without any labelled row, scores are constant.
    """
    labels = labels.where("label is not null and doc_id is not null")
    labels = labels.select(F.col("doc_id").alias("key"), F.col("label").cast("int").alias("label"))
    order = F.xxhash64("key", F.lit(seed))
    if (n := labels.count()) > fit_rows:
        cut = labels.select(order.alias("h")).stat.approxQuantile("h", [fit_rows / n], 1e-4)[0]
        labels = labels.where(order <= F.lit(cut))
    texts = docs.select(F.col("doc_id").alias("key"), "text")
    rows = texts.join(F.broadcast(labels), "key").select("key", "label", "text")  # fit_rows bounds it
    x = stored(rows.mapInArrow(_features, "key bigint, label int, x array<float>"))
    share = F.pmod(F.xxhash64("key", F.lit(seed + 1)), F.lit(CALIBRATION_SHARE))
    training, aside = x.where(share > 0), x.where(share == 0)
    if not training.take(1) or not aside.take(1):
        training = aside = x
    moments = training.select(*[F.col("x")[i].cast("double").alias(f"f{i}") for i in range(len(FEATURES))])
    stats = moments.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in moments.columns for f in (F.avg, F.stddev_pop)]).first()
    mean = np.array([stats[2 * i] or 0.0 for i in range(len(FEATURES))])
    scale = np.array([max(stats[2 * i + 1] or 0.0, 1e-9) for i in range(len(FEATURES))])
    scale[scale <= 1e-9] = 1.0
    rng = np.random.default_rng(seed)
    directions = rng.normal(0, 1 / GAMMA_SCALE, (len(FEATURES), FOURIER))
    none = np.zeros(0)
    model = Model(mean, scale, directions, rng.uniform(0, 2 * math.pi, FOURIER), none, none, none)
    sums = training.mapInArrow(_equations(model), "sums binary")
    while (n := sums.rdd.getNumPartitions()) > 16:  # half a megabyte a row
        sums = sums.repartition(max(1, n // 8)).mapInArrow(_added, "sums binary")
    total = np.zeros((FOURIER + 1) * (FOURIER + 2))
    for row in sums.toLocalIterator():
        total += np.frombuffer(row[0])
    size = FOURIER + 1
    left, right = total[: size * size].reshape(size, size), total[size * size :]
    model.weights = np.linalg.solve(left + RIDGE * np.eye(size), right)

    raw = aside.mapInArrow(_raw(model), "label int, raw double")
    width = F.least(F.greatest((F.col("raw") + 0.5) / 2, F.lit(0.0)), F.lit(1.0))  # raw scores lie around 0 to 1
    counts = raw.groupBy(F.floor(width * (BINS - 1)).cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("good"), F.avg("raw").alias("raw")
    )
    bins = sorted(counts.collect(), key=lambda r: r["bin"])  # BINS rows at most
    if not bins:
        model.edges, model.levels = np.array([0.0]), np.array([0.5])
        return model
    model.edges = np.array([r["raw"] for r in bins])
    model.levels = pooled(np.array([r["n"] for r in bins], float), np.array([r["good"] for r in bins], float))
    return model


def _scores(columns: list[str], model: Model, threshold: float):
    def run(batches):
        for batch in batches:
            score = model.score(statistics(batch.column("text")))
            out = [batch.column(c) for c in columns] + [pa.array(score), pa.array((score >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(out, [*columns, "score", "predicted"])

    return run


def score(docs: DataFrame, model: Model, columns: list[str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``columns`` of ``docs`` (all if None) with score (0 to 1) and predicted (1 from ``threshold`` on).

    Only the text is looked at; a null or empty text is scored like a text without words. Columns
    of ``docs`` that are named score or predicted are replaced. Repeated rows score alike; an
    empty table gives no rows.
    """
    columns = [c for c in (docs.columns if columns is None else columns) if c not in ("score", "predicted")]
    schema = T.StructType([docs.schema[c] for c in columns] + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return docs.select(*dict.fromkeys([*columns, "text"])).mapInArrow(_scores(columns, model, threshold), schema)


def accepted(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores ``threshold`` or more, with all their columns."""

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(model.score(statistics(batch.column("text"))) >= threshold))

    return docs.mapInArrow(run, docs.schema)
