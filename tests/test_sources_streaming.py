"""Sources, sinks and streaming forms."""

import json
import time

import pytest
from pyspark.sql import functions as F

from attesta.functions import rollcall
from attesta.operators import gates, sequences, similarity, writes
from attesta.sources import calendar, records, renderer
from attesta.streaming import turns

SF = "/root/testdata/sf0.001"


def test_paged_source(spark, tmp_path):
    rows = [{"EventId": k, "EventBodyName": "Council" if k % 2 else "Board", "EventDate": f"2024-01-{k + 1:02}"} for k in range(7)]
    for page in range(3):
        (tmp_path / f"events-{page * 3}.json").write_text(json.dumps(rows[page * 3 : page * 3 + 3]))
    spark.dataSource.register(records.PagedSource)
    reader = spark.read.format("paged_json").schema("EventId long, EventBodyName string, EventDate string").option("pages", 3).option("pageSize", 3)
    df = reader.load(f"{tmp_path}/events-{{skip}}.json")
    assert sorted(r["EventId"] for r in df.collect()) == list(range(7))
    assert sorted(r["EventId"] for r in records.since(df, "Council", "2024-01-04").collect()) == [3, 5]
    assert records.since(df, None, None).count() == 7
    # without a number of pages they end with the short one, and what is cached beyond it is not read
    (tmp_path / "events-9.json").write_text(json.dumps(rows[:3]))
    assert records.accessor(spark, "events", f"{tmp_path}/events-{{skip}}.json", pageSize="3").count() == 7
    assert records.accessor(spark, "events", f"{tmp_path}/none-{{skip}}.json", pageSize="3").count() == 0
    for page in range(2):
        (tmp_path / f"{records.page_key('votes?x', 2, page * 2)}.json").write_text(json.dumps([{"VoteId": page * 2 + k, "VoteValueName": "Yes" if k else None} for k in range(2)]))
    cached = records.accessor(spark, "votes", f"{tmp_path}/{{digest}}.json", pageSize="2", request="votes?x")
    assert cached.count() == 4 and sorted(r["VoteId"] for r in records.votes(cached).collect()) == [1, 3]
    with pytest.raises(Exception, match="ignores the offset"):
        records.accessor(spark, "events", f"{tmp_path}/events-0.json", pageSize="3").count()


def test_checklists_keep_ticks(spark):
    found = spark.createDataFrame([(1, "truncation", "medium", "p.3"), (1, "page_map", "high", None), (2, "ocr", "medium", "p.1")], "doc_id int, finding string, severity string, evidence string")
    made = renderer.checklist(found)
    assert {r["doc_id"]: r["checklist"] for r in made.collect()} == {1: "- [ ] page_map\n- [ ] truncation: p.3", 2: "- [ ] ocr: p.1"}
    old = spark.createDataFrame([(1, "# Review\n- [x] page_map\n- [ ] truncation"), (2, "- [ ] ocr")], "doc_id int, checklist string")
    assert [r["doc_id"] for r in renderer.unticked(made, old).collect()] == [2]


def test_json_records(spark, tmp_path):
    doc = {"segments": [{"text": "a b", "start": 0.0, "end": 1.0, "words": [{"word": "a", "start": 0.0, "end": 0.5}, {"word": "b", "start": None, "end": None}]}, {"text": "none", "start": 2.0, "end": 3.0}]}
    (tmp_path / "t.json").write_text(json.dumps(doc))
    words = records.words_of(records.read_json(spark, "transcript", str(tmp_path))).orderBy("segment", "position").collect()
    assert [(w["word"], w["start"]) for w in words] == [("a", 0.0), ("b", None), ("none", 2.0)]


def test_sheet_header_is_strict(spark, tmp_path):
    df = spark.createDataFrame([("1", "keep, please"), ("2", None)], "cluster string, decision string")
    records.write_sheet(df.coalesce(1), str(tmp_path / "out"))
    again = records.read_sheet(spark, str(tmp_path / "out"), ["cluster", "decision"])
    assert sorted((r["cluster"], r["decision"] or None) for r in again.collect()) == [("1", "keep, please"), ("2", None)]
    with pytest.raises(records.HeaderMismatch):
        records.read_sheet(spark, str(tmp_path / "out"), ["decision", "cluster"])
    with pytest.raises(Exception, match="(?i)already exists"):
        records.write_sheet(df, str(tmp_path / "out"))


def test_registry(spark):
    rows = spark.createDataFrame([("EPA", ["US EPA", "agency"], ["agency"]), ("DOE", ["Dept of Energy", "us epa"], None)], "canonical string, aliases array<string>, ambiguous array<string>")
    assert {(r["canonical"], r["alias"]) for r in records.registry_aliases(rows).collect()} == {("EPA", "epa"), ("DOE", "doe"), ("DOE", "dept of energy")}


def test_markdown(spark):
    rows = [(1, 2, 1, "TextItem", "second", None), (1, 1, 1, "SectionHeaderItem", "Head", 2), (1, 3, 2, "SectionHeaderItem", "Deep", 5), (1, 4, 2, "ListItem", "item", None)]
    df = spark.createDataFrame(rows, "doc_id int, seq int, page_no int, kind string, text string, level int")
    assert renderer.markdown(df).first()["markdown"] == "<!-- p.1 -->\n## Head\n\nsecond\n\n<!-- p.2 -->\n**Deep**\n\n- item"


def test_html_and_pdf(spark):
    row = spark.createDataFrame([(bytearray(b"%PDF-1.7"), None, "<p>a&amp;b</p><script>x</script>c\n\n\n\nd")], "content binary, kind string, html string")
    got = row.select(calendar.is_pdf(F.col("content"), F.col("kind")).alias("pdf"), calendar.visible_body(F.col("html")).alias("body")).first()
    assert got["pdf"] and got["body"].split() == ["a&b", "c", "d"] and "\n\n\n" not in got["body"]


def test_roll_call_layouts(spark):
    cases = {
        "x ROLL CALL Present: 2 - Ann Lee, Bob Ray Absent: 1 - Cy Young APPROVAL OF": (["Ann Lee", "Bob Ray"], ["Cy Young"], True, ""),
        "ROLL CALL\n2 -\nPresent\n:\nAnn Lee, and\nBob Ray\n1 - Cy Young Absent : public comment": (["Ann Lee", "Bob Ray"], ["Cy Young"], True, ""),
        "ROLL CALL 2 - 1 - Present : Ann Lee, Bob Ray Excused : Cy Young CONSENT": (["Ann Lee", "Bob Ray"], ["Cy Young"], True, ""),
        "ROLL CALL Present: 3 - Ann Lee, Bob Ray CONSENT": ([], [], False, "present: declared 3, extracted 2"),
        "ROLL CALL Absent: 1 - Cy Young CONSENT": ([], ["Cy Young"], False, "no counted present block"),
        "ROLL CALL 10 - 5 - Present : Jon Mallek, and Rita Mitchell PUBLIC COMMENT": ([], [], False, "2 counts, 1 labels, 1 name runs"),
        "APPROVAL OF AGENDA": ([], [], False, "no ROLL CALL block"),
        None: ([], [], False, "no ROLL CALL block"),
    }
    rows = rollcall.roll_calls(spark.createDataFrame([(t,) for t in cases], "t string"), "t").collect()
    assert {r["t"]: tuple(r)[1:] for r in rows} == cases


def test_gate_expressions(spark):
    row = spark.createDataFrame([("improvements at", "x; and", "EnhaEnNciHngA ok", "$2.5 million")], "a string, b string, c string, d string")
    got = row.select(gates.dangling(F.col("a")), gates.dangling(F.col("b")), gates.garbled(F.col("c")), gates.normal_money(F.col("d"))).first()
    assert list(got) == [True, False, 1, 2_500_000]


def test_enforce_fails_only_on_refused_rows(spark):
    rows = spark.range(5)
    assert writes.enforce(rows, F.col("id") > 9, "no").count() == 5
    with pytest.raises(Exception, match="refused here"):
        writes.enforce(rows, F.col("id") == 3, "refused here").collect()


def test_spans_and_edits(spark):
    spans = spark.createDataFrame([(1, 1, 10, 20), (2, 1, 30, 40), (3, 2, 0, 5)], "id int, doc int, span_start int, span_end int")
    edits = spark.createDataFrame([(1, 0, 5, 3), (1, 35, 50, -2), (1, 20, 30, 1)], "doc int, edit_start int, edit_end int, delta int")
    got = {r["id"]: (r["span_start"], r["span_end"], r["needs_reanchor"]) for r in writes.shift_spans(spans, edits, "doc").collect()}
    assert got == {1: (13, 23, False), 2: (30, 40, True), 3: (0, 5, False)}


def test_mentions_are_whole_words(spark):
    texts = spark.createDataFrame([(1, "Solar Plan and solar plan; SolarPlan, a solar planet. The solar plan of Ann"), (2, None)], "claim_id int, verbatim string")
    names = spark.createDataFrame([(7, "Solar Plan"), (8, "The solar plan"), (9, "solar")], "subject_id int, name string")
    got = [(r["subject_id"], r["span_start"], r["matched_text"]) for r in similarity.literal_mentions(texts, names).orderBy("span_start").collect()]
    assert got == [(7, 0, "Solar Plan"), (7, 15, "solar plan"), (8, 54, "The solar plan")]


def test_jaccard_pairs_against_all_pairs(spark):
    import random

    r = random.Random(9)
    sets = [(k, sorted({f"t{min(r.randrange(12), r.randrange(12))}" for _ in range(r.randint(0, 6))})) for k in range(80)]
    pairs = similarity.jaccard_pairs(spark.createDataFrame(sets, "id int, tokens array<string>")).collect()
    least = {}
    for k, t in sets:
        least.setdefault(tuple(t), k)
    want = set()
    for a, x in sets:
        for b, y in sets:
            if a < b and x and y:
                if x == y and least[tuple(x)] == a:
                    want.add((a, b, 1.0))
                elif x != y and a == least[tuple(x)] and b == least[tuple(y)]:
                    j = len(set(x) & set(y)) / len(set(x) | set(y))
                    if j >= 0.6:
                        want.add((a, b, round(j, 3)))
    assert {(p["a"], p["b"], p["score"]) for p in pairs} == want


# ---------------------------------------------------------------- streaming


def drained(spark, df, name, mode="append"):
    q = df.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    try:
        assert q.awaitTermination(90)
        return spark.sql(f"SELECT * FROM {name}").collect()
    finally:
        q.stop()


@pytest.fixture(scope="module")
def stream(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("events")
    batch = spark.read.parquet(f"{SF}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    batch.coalesce(1).write.mode("overwrite").parquet(str(folder))
    return batch, lambda: spark.readStream.schema(batch.schema).parquet(str(folder))


def test_windows_equal_batch(spark, stream):
    batch, source = stream
    got = {(r["start"], r["event_type"]): r["n"] for r in drained(spark, turns.windowed_counts(source(), "6 hours"), "tumbling", "complete")}
    want = {(r["start"], r["event_type"]): r["n"] for r in turns.windowed_counts(batch, "6 hours").collect()}
    assert got == want and sum(got.values()) == batch.count()


def test_unknown_terms_stream(spark, stream):
    batch, source = stream
    got = drained(spark, turns.unknown_terms(source(), ["click", "view"]), "unknown", "complete")
    assert sum(r["occurrences"] for r in got) == batch.where("event_type not in ('click', 'view')").count()


def test_first_seen_stream(spark, stream):
    batch, source = stream
    got = drained(spark, turns.first_seen(source(), ["event_id"]).select("event_id"), "firsts")
    assert len(got) == batch.select("event_id").distinct().count()


def test_live_turns_equal_batch(spark, tmp_path):
    rows = [(k % 2, k, "AB"[k // 5 % 2], k * 900, k * 900 + 400) for k in range(60)]
    df = spark.createDataFrame(rows, "media_id long, id int, speaker string, start_ms long, end_ms long")
    df.coalesce(1).write.parquet(str(tmp_path / "s"))
    live = turns.live_turns(spark.readStream.schema(df.schema).parquet(str(tmp_path / "s")))
    q = live.writeStream.outputMode("append").format("memory").queryName("live").trigger(processingTime="1 second").start()
    try:  # a query with processing-time timeouts never comes to rest: wait for its input instead
        for _ in range(60):
            if sum(p["numInputRows"] for p in q.recentProgress) >= len(rows):
                break
            time.sleep(1)
        found = spark.sql("SELECT * FROM live").collect()
    finally:
        q.stop()
    got = {(r["media_id"], r["start_ms"], r["end_ms"], r["speaker"]) for r in found}
    want = {(r["media_id"], r["start_ms"], r["end_ms"], r["speaker"]) for r in sequences.coalesce_runs(df).collect()}
    last = {m: max(w for w in want if w[0] == m) for m in (0, 1)}
    assert got == want - set(last.values())
