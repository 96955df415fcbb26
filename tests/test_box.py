"""Bounds, missing values and ties in the box algebra."""

import math

import pytest
from pyspark.sql import functions as F

from boxloom.functions import box, chem, hashing
from boxloom.functions.normal import phi


@pytest.fixture(scope="module")
def values(spark):
    return spark.createDataFrame([(1, 5.0), (2, float("nan")), (3, None), (4, 10.0), (5, 20.0)], "k int, v double")


def column(df, expression):
    return [r[0] for r in df.orderBy("k").select(expression).collect()]


def test_inside_is_closed_and_false_for_missing(values):
    assert column(values, box.inside(F.col("v"), F.lit(5.0), F.lit(10.0))) == [True, False, False, True, False]


def test_open_side(values):
    assert column(values, box.inside(F.col("v"), F.lit(10.0), F.lit(None).cast("double"))) == [False, False, False, True, True]


def test_distance_is_infinite_for_missing(values):
    assert column(values, box.distance(F.col("v"), F.lit(8.0), F.lit(12.0))) == [3.0, math.inf, math.inf, 0.0, 8.0]


def test_inverted_bounds_are_swapped_by_the_score(values):
    straight = column(values, box.score([(F.col("v"), F.lit(8.0), F.lit(12.0))], "l1"))
    assert straight == column(values, box.score([(F.col("v"), F.lit(12.0), F.lit(8.0))], "l1"))
    assert straight[3] == 1.0


def test_zero_width_box_divides_by_one(values):
    assert column(values, box.score([(F.col("v"), F.lit(10.0), F.lit(10.0))], "l1"))[0] == -5.0


def test_undecided_is_null_for_missing(values):
    assert column(values, box.undecided(F.col("v"), F.lit(10.0), F.lit(10.0))) == [False, None, None, True, False]


def test_phi(spark):
    rows = spark.createDataFrame([(x / 4,) for x in range(-12, 13)], "x double").select("x", phi(F.col("x")).alias("p")).collect()
    assert all(abs(r.p - (1 + math.erf(r.x / math.sqrt(2))) / 2) < 2e-4 for r in rows)


def test_sha_uniform_matches_python(spark):
    import hashlib

    keys = ["a", "b", "scaffold 7"]
    rows = spark.createDataFrame([(k,) for k in keys], "k string").select("k", hashing.sha_uniform("s", F.col("k")).alias("u")).collect()
    for r in rows:
        assert r.u == int(hashlib.sha256(f"s::{r.k}".encode()).hexdigest()[:16], 16) % 10000 / 10000


def test_chemistry_needs_a_toolkit():
    try:
        import rdkit  # noqa: F401
    except ImportError:
        with pytest.raises(chem.Missing):
            chem.kernel("canonical", "string")
