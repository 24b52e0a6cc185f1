"""Mixing sources to target weights by systematic sampling.

Within a source, documents stand in order of size; each adds its expected copies to a running
sum, and it is taken once for every integer that the sum, plus one offset of the source,
crosses. The number of words taken so differs from the target by less than the largest
document; of OFFSETS evenly spaced offsets, the first of them random, the one that comes nearest
is used. The running sum needs a document's position only: documents are sorted into ranges
over (source, size, doc_id), so that a large source spans many of them, and the rows of a range
before a document and the ranges before its own add up to its position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
SEED = "mix-1"
OFFSETS = 32
RESULT = ("size", "source_size", "target", "taken", "copies")


def word_count(text: Column) -> Column:
    """Number of runs of characters other than 0x20 and 0x09-0x0D."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row a source.

    Sources in order of their names, null last, take the weights in turn. The targets share the
    sum of all sizes; one stops at ``most`` times its source's size, and the rest is shared out
    again by weight. A source is full if its limit for each unit of weight is at most what a unit
    would get once all sources with lower limits are full.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    limit = (F.lit(most) * F.col("source_size")).cast("double")
    rows = sizes.withColumn("weight", weight).withColumn("limit", limit)
    rank = W.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    whole = W.partitionBy()
    below = rank.rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("left", F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(below), F.lit(0.0)))
    rows = rows.withColumn("unfilled", F.sum("weight").over(rank.rowsBetween(0, W.unboundedFollowing)))
    rows = rows.withColumn("unit", F.col("left") / F.col("unfilled"))
    rows = rows.withColumn("full", F.col("limit") <= F.col("unit") * F.col("weight"))
    unit = F.max(F.when(~F.col("full"), F.col("unit"))).over(whole)  # that of the first
    target = F.when(F.col("full"), F.col("limit")).otherwise(unit * F.col("weight"))
    return rows.select("source", "source_size", target.alias("target"))


def offset(source: Column, seed: str) -> Column:
    """A number in [0, 1) for each source, the same in every run."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(source, F.lit("\u0000"))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def mix(
    docs: DataFrame, weights=WEIGHTS, most: int = MOST_COPIES, seed: str = SEED
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) for every row of ``docs``.

    size: words of the text, 0 for null. target: the words that its source should give; copies:
    how often the row is taken, ``most`` times at most; taken: copies times size. Sources are
    told apart by name, null being one, the last. A source without words has target 0 and gives
    nothing. Rows with equal source, size and doc_id are interchangeable. The same rows give the
    same result in whatever order or partitions they come. Other columns are ignored; an empty
    table gives no rows.
    """
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    rows = stored(rows)
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    shares = stored(targets(sizes.drop("rows"), weights, most))
    keys = [F.col("source").asc_nulls_last(), F.col("size"), F.col("doc_id")]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = stored(placed.withColumn("at", F.monotonically_increasing_id()))
    placed = placed.withColumn("range", F.shiftright("at", 33))
    pieces = placed.groupBy("source", "range").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("source").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    pieces = pieces.select(
        F.col("source").alias("source_"), F.col("range").alias("range_"), "first",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
    )
    shares = shares.withColumnRenamed("source", "source__")
    pieces = pieces.join(shares, F.col("source_").eqNullSafe(F.col("source__"))).drop("source__")
    same = (F.col("range") == F.col("range_")) & F.col("source").eqNullSafe(F.col("source_"))
    placed = placed.join(pieces, same)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    position = F.col("before") + F.col("at") - F.col("first")

    def copies(start: Column) -> Column:
        crossed = F.floor(start + ratio * (position + 1)) - F.floor(start + ratio * position)
        return F.least(F.ceil(ratio), crossed)

    def shifted(k: int) -> Column:
        start = offset(F.col("source"), seed) + F.lit(k / OFFSETS)
        return start - F.floor(start)

    misses = placed.groupBy("source").agg(
        F.max("target").alias("target"), *[F.sum(F.col("size") * copies(shifted(k))).alias(f"t{k}") for k in range(OFFSETS)]
    )
    miss = [F.struct(F.abs(F.col(f"t{k}") - F.col("target")).alias("miss"), F.lit(k).alias("k"), shifted(k).alias("start")) for k in range(OFFSETS)]
    starts = stored(misses.select(F.col("source").alias("source__"), F.least(*miss)["start"].alias("start")))
    return (
        placed.join(starts, F.col("source").eqNullSafe(F.col("source__")))
        .withColumn("copies", copies(F.col("start")).cast("int"))
        .select(
            "doc_id", "source", "size", "source_size", "target", "copies",
            (F.col("copies") * F.col("size")).alias("taken"),
        )
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as ``mix`` takes it, with the columns of ``docs``.

    Rows with equal doc_id, source and size are numbered on both sides and matched by number.
    Nulls and an empty table are taken as ``mix`` takes them; column names can't clash.
    """
    keys = ["doc_id", "source", "size"]
    number = F.row_number().over(W.partitionBy(*keys).orderBy("order")).alias("number")
    copies = mix(docs, **options).select(*keys, "copies", F.lit(0).alias("order"))
    copies = copies.select(*[F.col(c).alias(f"{c}_") for c in keys], "copies", number).withColumnRenamed("number", "number_")
    rows = docs.select(
        F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("row"),
        "doc_id",
        "source",
        word_count(F.col("text")).alias("size"),
        F.xxhash64("text").alias("order"),
    ).select("row", *keys, number)
    same = (F.col("size") == F.col("size_")) & (F.col("number") == F.col("number_"))
    for c in ("doc_id", "source"):
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_"))
    found = rows.join(copies, same).where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), "copies")))
    return found.select(*[F.col("row")[f"c{i}"].alias(c) for i, c in enumerate(docs.columns)])
