"""Plans that grow with their input, and results on copies and crowded keys, against direct loops."""

from pyspark.sql import functions as F

from attesta.operators import conversion, geometry, review, similarity, speech, writes


def _chain(spark):
    """Four rows; the first source knows one value of its keys, the second many."""
    rows = spark.createDataFrame([(1, None, 1, 1), (2, 9, 1, 1), (3, None, 2, 2), (4, None, None, 1)], "id int, v int, a int, b int")
    a = spark.createDataFrame([(1, 5), (1, 5)], "a int, v int")
    b = spark.createDataFrame([(1, v) for v in range(20, 0, -1)] + [(2, 7)], "b int, v int")
    return writes.inherit(rows, "id", "v", [("second", b, ["b"]), ("first", a, ["a"])], longest="second")


def _plan(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_filled_rows_meet_no_lists(spark):
    after = _chain(spark)[0]
    assert sorted(map(tuple, after.collect()), key=str) == [(1, 5, 1, 1, "first"), (2, 9, 1, 1, None), (3, 7, 2, 2, "second"), (4, None, None, 1, None)]
    assert "collect_set" not in _plan(after)


def test_long_lists_are_joined_last(spark):
    queue = _chain(spark)[1]
    assert [tuple(r) for r in queue.collect()] == [(4, "ambiguous", list(range(1, 21)))]
    joins = [line for line in _plan(queue).splitlines() if "Join LeftOuter" in line]
    assert "(b#" in joins[0] and "(a#" in joins[1]


def test_counting_filled_rows_makes_no_lists(spark):
    counts = _chain(spark)[2]
    assert {r["provenance"]: r["filled"] for r in counts.collect()} == {"first": 1, "second": 1}
    assert "collect_set" not in _plan(counts)


def test_rows_that_need_not_ask_are_dealt_over_tasks(spark):
    """No key, or a value already: such rows meet under no one key."""
    held = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    rows = spark.range(2000).selectExpr("cast(id as int) id", "cast(null as int) v", "if(id % 2 = 0, cast(id as int), null) a", "if(id % 2 = 0, 1, null) b")
    a = spark.range(0, 2000, 4).selectExpr("cast(id as int) a", "7 v")
    b = spark.createDataFrame([(1, 8), (2, 9)], "b int, v int")
    try:
        for k, v in zip(held, ("false", "-1")):
            spark.conf.set(k, v)
        for sources, filled in ([("b", b, ["b"])], {"b": 1000}), ([("a", a, ["a"]), ("b", b, ["b"])], {"a": 500, "b": 500}):
            after, _, counts = writes.inherit(rows, "id", "v", sources)
            assert {r["provenance"]: r["filled"] for r in counts.collect()} == filled
            idle = after.where("provenance is null or provenance = 'a'").groupBy(F.spark_partition_id()).count().collect()
            assert len(idle) == 4 and max(r["count"] for r in idle) < 600
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def test_sources_by_the_same_keys_share_a_shuffle(spark):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    rows = spark.createDataFrame([(1, None, 1), (2, None, 2), (3, None, None)], "id int, v int, a int")
    first, second = spark.createDataFrame([(1, 5)], "a int, v int"), spark.createDataFrame([(1, 6), (2, 7)], "a int, v int")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        after = writes.inherit(rows, "id", "v", [("first", first, ["a"]), ("second", second, ["a"])])[0]
        assert sorted(map(tuple, after.collect())) == [(1, 5, 1, "first"), (2, 7, 2, "second"), (3, None, None, None)]
        assert after._jdf.queryExecution().sparkPlan().toString().count("SortMergeJoin") == 2
        plan = after._jdf.queryExecution().executedPlan().toString()
        assert plan[plan.index("Initial Plan") if "Initial Plan" in plan else 0 :].count("Exchange hashpartitioning") == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def test_a_source_by_the_rows_own_key_tells_of_asking_rows_only(spark):
    rows = spark.createDataFrame([(1, None), (2, 4), (3, None), (3, None), (5, None), (None, None)], "id int, v int")
    told = spark.createDataFrame([(1, 5), (1, 6), (2, 7), (3, 7), (3, 8), (4, 9), (None, 9), (5, None)], "id int, v int")
    live = spark.createDataFrame([(5, 6)], "id int, survivor int")
    after, queue, counts = writes.inherit(rows, "id", "v", [("own", told, ["id"])], live)
    assert sorted(map(tuple, after.collect()), key=str) == sorted([(1, 6, "own"), (2, 4, None), (3, None, None), (3, None, None), (5, None, None), (None, None, None)], key=str)
    assert sorted(map(tuple, queue.collect()), key=str) == sorted([(3, "ambiguous", [7, 8])] * 2 + [(5, "no candidate", []), (None, "no candidate", [])], key=str)
    assert [tuple(r) for r in counts.collect()] == [("own", 1)]
    assert "Join LeftSemi" in _plan(counts)


def test_a_reading_of_a_copy_is_not_one_of_this_section(spark):
    sections = spark.createDataFrame([(1, "h", "one two", None, "clean"), (2, "h", "one two", None, "clean")], "id int, content_hash string, text string, parse_flags map<string,string>, parse_confidence string")
    reads = spark.createDataFrame([(2, "h", "one", "r")], "id int, content_hash string, other string, reader string")
    told = {r["id"]: (r["parse_flags"], r["parse_confidence"]) for r in review.apply_second_reads(sections, reads).collect()}
    assert told == {1: ({}, "clean"), 2: ({"ocr_conflicts": "two"}, "unaudited")}
    told = {r["id"]: r["parse_confidence"] for r in review.apply_second_reads(sections, reads.drop("id")).collect()}
    assert told == {1: "unaudited", 2: "unaudited"}


def test_videos_meet_counted_meetings(spark, tmp_path):
    """A day of many meetings is one row before videos meet it; a video of several days has all their meetings."""
    import datetime

    from attesta.plans.document_queries import channel_reconciliation
    from attesta.plans.store import Store

    day = lambda n: datetime.datetime(2020, 1, n)
    orders = [(100 + k, 1, day(1)) for k in range(50)] + [(3, 1, day(2)), (5, 1, day(3))]
    spark.createDataFrame([(k, c, "F", 1.0, d, "p") for k, c, d in orders], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    videos = [(v, 1, day(1)) for v in range(10, 30)] + [(3, 1, day(2)), (6, 1, day(3)), (7, 1, day(3)), (7, 1, day(2)), (8, 2, day(1)), (9, 1, day(3)), (9, 1, day(3))]
    line = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, l_shipdate timestamp_ntz"
    spark.createDataFrame([(v, 1, b, 1, 1.0, "N", d) for v, b, d in videos], line).write.parquet(f"{tmp_path}/lineitem.parquet")
    told = channel_reconciliation(Store(spark, str(tmp_path)))
    got = {r["video_id"]: (r["event_id"], r["state"]) for r in told.collect()}
    want = {v * 10 + 1: (None, "ambiguous") for v in range(10, 30)}
    assert got == want | {31: (3, "both_corroborated"), 61: (5, "recovered"), 71: (None, "ambiguous"), 81: (None, "orphan"), 91: (5, "recovered")}
    shown = _plan(told)
    assert shown.index("min(") and "Aggregate [body_id" in shown


def test_characters_are_never_broadcast(spark):
    """One row of a small table explodes to many characters, so its size says nothing about theirs."""
    tokens = spark.createDataFrame([(1, "ab")], "doc_id int, token string")
    glyphs = spark.createDataFrame([(1, 1, "a", 0.0, 1.0, 9.0), (1, 2, "b", 1.0, 2.0, 9.0)], "doc_id int, position int, character string, x0 double, x1 double, size double")
    told = geometry.token_verdicts(tokens, glyphs, spark.createDataFrame([(1, "ab")], "doc_id int, word string"))
    assert [(r["token"], r["verdict"]) for r in told.collect()] == [("ab", "primary")]
    assert "BroadcastHashJoin" not in told._jdf.queryExecution().executedPlan().toString()


def test_dissents_take_no_frame_a_word(spark):
    """300 clips of 100 words in a fraction of a second, and many clips to a batch rather than a group each."""
    import time

    clips = [{"a": " ".join(f"w{k % 17}x{n}" for k in range(100)), "b": " ".join(f"w{k % 17}x{n + (k == 50)}" for k in range(100))} for n in range(300)]
    began = time.perf_counter()
    assert all(speech.dissent(c | {"c": c["a"]}) == [(50, "b", f"w16x{n + 1}", f"w16x{n}")] for n, c in enumerate(clips))
    assert time.perf_counter() - began < 4
    readings = spark.createDataFrame([(n, s, t) for n, c in enumerate(clips[:5]) for s, t in (c | {"c": c["a"]}).items()], "clip int, system string, text string")
    found = speech.dissents(readings)
    assert sorted(map(tuple, found.collect())) == [(n, 50, "b", f"w16x{n + 1}", f"w16x{n}") for n in range(5)]
    assert "InPandas" not in found._jdf.queryExecution().executedPlan().toString()


def test_candidates_find_dissents_once(spark):
    """Scoring the readings reads the dissents once: one pass of Python over the clips, not one for each side of a join."""
    texts = {"a": "the solar panels hum", "b": "the solar panels hum", "c": "the soler panels hum"}
    readings = spark.createDataFrame([(n, s, t) for n in range(3) for s, t in texts.items()], "clip int, system string, text string")
    told = speech.vocabulary_candidates(speech.dissents(readings))
    assert sorted((r["clip"], r["spelling"], r["variants"], r["rank"]) for r in told.collect()) == [(n, "solar", {"soler": 1}, 1) for n in range(3)]
    assert "Join" not in _plan(told)


def _joined_rows(node):
    """Rows that a plan's joins gave out, once it has run."""
    name, kids = node.nodeName(), []
    if name.startswith("AdaptiveSparkPlan"):
        kids = [node.executedPlan()]
    elif "QueryStage" in name:
        kids = [node.plan()]
    else:
        children = node.children()
        kids = [children.apply(k) for k in range(children.size())]
    own = node.metrics().apply("numOutputRows").value() if name.endswith("Join") else 0
    return own + sum(map(_joined_rows, kids))


def test_words_of_common_parts_do_not_all_meet(spark):
    """1,600 words from 40 beginnings and 40 ends: those that share a half are no pairs, and few of them meet."""
    import random

    draw = random.Random(3)
    halves = ["".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(4)) for _ in range(80)]
    words = {a + b for a in halves[:40] for b in halves[40:]}
    pairs = similarity.edit_pairs(spark.createDataFrame([(w,) for w in words], "word string"))
    found = pairs._jdf.queryExecution()
    assert len(found.executedPlan().executeCollect()) < 1600
    assert _joined_rows(found.executedPlan()) < 20 * len(words)


def test_long_similar_words_equal_all_pairs(spark):
    """Three to six edits, where words are cut into parts."""
    import random

    draw = random.Random(5)
    words = set()
    for _ in range(60):
        w = "".join(draw.choice("abcd") for _ in range(draw.randint(14, 31)))
        words.add(w)
        for _ in range(draw.randint(1, 8)):
            at = draw.randint(0, len(w))
            w = draw.choice([w[:at] + draw.choice("abcd") + w[at:], w[:at] + w[at + 1 :], w[:at] + draw.choice("abcd") + w[at + 1 :]])
            words.add(w)
    frame = spark.createDataFrame([(w,) for w in words], "w string")
    for least in (0.8, 0.75):
        both = frame.selectExpr("w a").crossJoin(frame.selectExpr("w b")).where("a < b").selectExpr("a", "b", "levenshtein(a, b) d", "greatest(length(a), length(b)) n")
        want = {(r["a"], r["b"]): r["d"] for r in both.where(f"d <= {1 - least} * n + 1e-9").collect()}
        got = {(r["a"], r["b"]): r["distance"] for r in similarity.edit_pairs(frame, "w", least).collect()}
        assert got == want and max(want.values()) >= 4


def test_pages_that_hold_their_words_are_not_shuffled(spark):
    page = "struct<seq:int,text:string>"
    pages = spark.createDataFrame([(1, [(0, "One"), (1, "two,"), (2, "--"), (3, "the"), (4, "three"), (5, "four")], "one four"), (2, [(0, "a"), (1, "b"), (2, "c")], "ab c"), (3, None, "x"), (4, [(0, "a")], None)], f"page int, cells array<{page}>, assembled string")
    told = conversion.missing_runs_of(pages, ["page"], ["the"], 2)
    assert [tuple(r) for r in told.collect()] == [(1, 1, "two, the three")]
    assert "Exchange" not in told._jdf.queryExecution().executedPlan().toString()
