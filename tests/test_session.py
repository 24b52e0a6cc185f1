"""The size check behind broadcasts counts bytes, nested values included."""

import pytest
from pyspark.sql import functions as F

from farescope.session import broadcast_if_small, fits_broadcast


@pytest.mark.parametrize(
    ("column", "least", "most"),
    [
        ("id", 24_000, 24_000),
        ("repeat('x', 100)", 124_000, 124_000),
        ("cast(null AS string)", 24_000, 24_000),
        ("transform(sequence(1, 50), i -> named_struct('a', 1D, 'b', 2D))", 800_000, 900_000),
        ("array('abc', repeat('y', 200))", 200_000, 300_000),
        ("cast(null AS array<double>)", 16_000, 32_000),
        ("named_struct('a', id, 's', 'four')", 30_000, 40_000),
        ("map('k', repeat('z', 300))", 300_000, 400_000),
    ],
)
def test_bytes_of_a_thousand_rows(spark, column, least, most):
    df = spark.range(1000).select(F.expr(column).alias("odd `name. x"))
    assert fits_broadcast(df, most) and not fits_broadcast(df, least - 1)


def test_hint_follows_the_check(spark):
    df = spark.range(100)
    assert "broadcast" in broadcast_if_small(df)._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in broadcast_if_small(df, max_bytes=10)._jdf.queryExecution().analyzed().toString().lower()
    assert fits_broadcast(df.where("false"), 0)
