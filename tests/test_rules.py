"""Rule classifiers and scalar functions on literal cases."""

import pytest
from pyspark.sql import functions as F

from attesta.functions import rules, text


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "verbatim, want",
    [
        ("The city was awarded $4", "received"),
        ("Granted over $70,000 through our program", "disbursed"),
        ("$4,500,000 from the Rescue Plan", "received"),
        ("savings from the retrofit programme", "saved"),
        ("Council authorized the sale", "authorized"),
        ("invested in trees", "spent"),
        ("", "unknown"),
        (None, "unknown"),
    ],
)
def test_direction(spark, verbatim, want):
    assert one(spark, rules.fiscal_direction(F.col("v")), v=verbatim) == want


@pytest.mark.parametrize("amount, verbatim, want", [(0, "cost $0 in total", 0), (0, "no figure", None), (0, "$0.50 each", None), (5, None, 5), (None, "$0", None)])
def test_stated_amount(spark, amount, verbatim, want):
    assert one(spark, rules.stated_amount(F.col("a").cast("int"), F.col("v").cast("string")), a=amount, v=verbatim) == want


@pytest.mark.parametrize(
    "raw, want",
    [("metric_tons_co2e", ("metric_tons_co2e", None)), ("MTCO2e", ("metric_tons_co2e", None)), ("tons of material", ("metric_tons", "material")), ("weeks", ("weeks", None)), (" ", ("other", None)), ("trees planted", ("count", "trees planted")), ("Percent.", ("percent", None))],
)
def test_units(spark, raw, want):
    assert tuple(one(spark, rules.split_unit(F.col("u")), u=raw)) == want


@pytest.mark.parametrize("title, want", [("Council 1/13/26", "2026-01-13"), ("Council 13/45/2020", None), ("Board 2-3-20", "2020-02-03"), ("Board - May 12, 2026", "2026-05-12"), ("nothing", None), (None, None)])
def test_title_date(spark, title, want):
    got = one(spark, text.title_date(F.col("t").cast("string")), t=title)
    assert (got and got.isoformat()) == want


@pytest.mark.parametrize("word, want", [("decarbonization", "decarbon"), ("housing", "hous"), ("cities", "citi"), ("bus", "bus"), ("programs", "program")])
def test_root(spark, word, want):
    assert one(spark, text.root(F.col("w")), w=word) == want


def test_phrases(spark):
    assert one(spark, text.core_phrase(F.col("n")), n="Move Toward a Circular Economy") == "Circular Economy"
    assert one(spark, text.slugify(F.col("n")), n="Parks & Rec -- 2024!") == "parks-and-rec-2024"
    assert sorted(one(spark, text.key_terms(F.col("n")), n="Implement the Strategy 2 of Solar Homes")) == ["homes", "solar", "strategy"]
    assert one(spark, text.clock(F.col("n")), n="7:05 PM") == "19:05"
    assert one(spark, text.hms(F.col("n")), n=3725) == "1:02:05"
    assert one(spark, text.singular(F.col("n")), n="Cities") == "city"
