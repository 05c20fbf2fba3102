"""Sequence matching, anchoring and curation guards on literal cases."""

import pytest
from pyspark.sql import functions as F

from attesta.operators import anchoring, curation, speech


def test_transfer_fills_agreeing_gaps():
    words = "hello there my um friends good bye now".split()
    turns = [("Ann", "Hello there, my friends."), ("Bob", "good night now")]
    assert speech.transferred(words, turns) == ["Ann"] * 5 + ["Bob"] * 3
    assert speech.transferred(["x"], [("Ann", "y")]) == [None]
    assert speech.transferred([], turns) == []


def test_roster():
    roster = ["Missy Stults", "Ken Garber", "Ana Mallek"]
    assert speech.roster_match("Ms. Malik", roster)[0] == "Ana Mallek"
    assert speech.roster_match("Stultz", roster)[0] == "Missy Stults"
    assert speech.roster_match("Zzz", roster) == (None, 0.0)
    assert speech.roster_match(None, roster) == (None, 0.0)


def test_dissent_needs_three_and_all_others():
    assert speech.dissent({"a": "x y", "b": "x z"}) == []
    got = speech.dissent({"a": "the solar plan", "b": "the solar plan", "c": "the polar plan"})
    assert got == [(1, "c", "polar", "solar")]
    assert speech.dissent({"a": "one", "b": "two", "c": "three"}) == []
    # a word that one leaves out, and replacements of unequal length as far as both go
    assert speech.dissent({"a": "the new solar plan", "b": "the solar plan", "c": "the new solar plan"}) == [(1, "b", "", "new")]
    assert speech.dissent({"a": "we met at noon", "b": "we met at noon", "c": "we sat down at noon"}) == [(1, "c", "sat", "met")]


def test_seams(spark):
    rows = [(1, 0, 1, 0, 500), (1, 0, 2, 500, 900), (1, 1, 3, 480, 880), (1, 1, 4, 895, 1200)]
    df = spark.createDataFrame(rows, "media_id int, chunk int, id int, start_ms long, end_ms long")
    assert sorted(r["id"] for r in speech.drop_seams(df).collect()) == [1, 2, 4]


def test_dissents_by_clip(spark):
    rows = [(c, s, t) for c in (1, 2) for s, t in (("a", "red green"), ("b", "red green"), ("c", "red grain" if c == 1 else "red green"))]
    got = speech.dissents(spark.createDataFrame(rows, "clip int, system string, text string")).collect()
    assert [(r["clip"], r["system"], r["reading"], r["agreed"]) for r in got] == [(1, "c", "grain", "green")]


def test_anchor():
    text = "He said “no  thanks” — twice. It’s over; it's over."
    assert anchoring.anchor(text, '"no thanks" - twice') == (8, 28)
    assert anchoring.anchor(text, "IT'S OVER") is None  # stands twice under folding
    assert anchoring.anchor(text, "It’s over") == (30, 39)
    assert anchoring.anchor(text, " ") is None and anchoring.anchor(None, "x") is None


def test_anchored_column(spark):
    row = spark.createDataFrame([("a b c", "b"), ("a b c", "z"), (None, "a")], "t string, q string").select(anchoring.anchored("t", "q").alias("s")).collect()
    assert [(r["s"]["span_start"], r["s"]["span_end"]) if r["s"] and r["s"]["span_start"] is not None else None for r in row] == [(2, 3), None, None]


def test_windows():
    text = "design a district geothermal loop and districts for geothermal study"
    wanted = anchoring.terms("Geothermal Districts")
    assert wanted == {"geothermal", "district"}
    a, b = anchoring.windows(text, wanted)
    assert text[a:b] == "district geothermal"
    assert anchoring.windows("geothermal loop in a district", wanted) is None


def test_unit_rulings_never_map(spark):
    rows = spark.createDataFrame([(1, "tons")], "id int, unit string")
    terms = spark.createDataFrame([("MW", True, False)], "term string, approved boolean, deprecated boolean")
    proposals = spark.createDataFrame([("tons", 1)], "term string, occurrences long")
    rulings = spark.createDataFrame([("quantity_unit", "tons", "map", "MW")], "vocabulary string, term string, action string, target string")
    after, _, _ = curation.apply_rulings(rows, proposals, rulings, "unit", "quantity_unit", terms)
    with pytest.raises(Exception, match="never mapped"):
        after.collect()


def test_award_status_needs_a_reason(spark):
    rows = spark.createDataFrame([(1, "unknown", None, None)], "id int, award_status string, status_change_reason string, status_as_of date")
    terms = spark.createDataFrame([("terminated", True, False)], "term string, approved boolean, deprecated boolean")
    for status, reason, message in (("terminated", " ", "needs the sentence"), ("made_up", "why", "not an approved term")):
        changes = spark.createDataFrame([(1, status, reason, None)], "id int, new_status string, reason string, as_of date")
        with pytest.raises(Exception, match=message):
            curation.apply_award_status(rows, changes, terms).collect()


def test_flags(spark):
    row = spark.createDataFrame([('{"a": 1}',), (None,)], "f string").select(curation.set_flag(F.col("f"), "b", F.lit(2)).alias("on"), curation.set_flag(F.col("f"), "a", F.lit(None)).alias("off")).collect()
    assert [(r["on"], r["off"]) for r in row] == [('{"a":"1","b":"2"}', "{}"), ('{"b":"2"}', "{}")]


def test_word_agreement_is_over_the_longer_side(spark):
    from pyspark.sql import functions as F

    from attesta.operators import metrics

    rows = [("the new solar plan", "the solar plan"), ("um the plan uh", "THE plan!"), ("a b", "c d"), ("", ""), (None, "a b"), ("a b c d", "a b x y")]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, a string, b string")
    got = [r["x"] for r in df.select("k", metrics.word_agreement("a", "b").alias("x")).orderBy("k").collect()]
    assert got == [0.75, 1.0, 0.0, 0.0, 0.0, 0.5]
    both = [r["x"] for r in df.select("k", metrics.word_agreement("b", "a").alias("x")).orderBy("k").collect()]
    assert both == got
    total = df.select(metrics.review_seconds(unnamed=F.lit(2), welded=F.lit(1), split=F.lit(None).cast("int")).alias("x")).first()["x"]
    assert total == 2 * metrics.BURDEN["unnamed"] + metrics.BURDEN["welded"]
