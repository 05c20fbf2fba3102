"""Conversion steps, markdown, speakers and backends against direct loops and literal cases."""

import random
import re

import pytest
from pyspark.sql import functions as F

from attesta.functions import markdown
from attesta.operators import conversion, curation, documents, speakers
from attesta.sources import probes


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "primary, second, numbers, text, refs",
    [
        ("In Year Two, we:", "In Year Two, we4:", [4], "In Year Two, we:", [4]),
        ("In Year Two, wet:", "In Year Two, we4:", [4], "In Year Two, we:", [4]),
        ("In Year Two, we':", "In Year Two, . we4:", [4], "In Year Two, we:", [4]),
        ("In Year Two, wet:", "In Year Two, we4:", [5], "In Year Two, wet:", []),
        ("grew by 14", "grew by 14", [14], "grew by 14", []),
        ("too short", "not of the same length", [1], "too short", []),
    ],
)
def test_footnote_markers(spark, primary, second, numbers, text, refs):
    got = one(spark, conversion.without_markers(F.col("p"), F.col("s"), F.array(*map(F.lit, numbers))), p=primary, s=second)
    assert (got["text"], got["refs"]) == (text, refs)


def test_missing_runs_equal_direct_loop(spark):
    r, stop = random.Random(3), {"the", "of"}
    pages = []
    for k in range(60):
        words = [r.choice(["the", "of", "Solar", "wind,", "grid", "tree.", "cost", "plan", "--", "AREA"]) + r.choice(["", str(r.randint(0, 30))]) for _ in range(r.randint(0, 40))]
        kept = [w for w in words if r.random() < 0.6]
        pages.append((k, words, " ".join(kept)))
    letters = lambda t: re.sub("[^a-z0-9]", "", t.lower())
    want = []
    for k, words, text in pages:
        have, run = {letters(w) for w in text.split()}, []

        def flush(run):
            missing = [i for i, _, m in run if m]
            if len(missing) >= 3:
                body = " ".join(w for i, w, _ in run if missing[0] <= i <= missing[-1])
                if letters(body) not in letters(text):
                    want.append((k, missing[0], body))

        for i, w in enumerate(words):
            if not letters(w):
                continue
            if letters(w) in stop:
                run.append((i, w, False))
            elif letters(w) in have:
                flush(run)
                run = []
            else:
                run.append((i, w, True))
        flush(run)
    rows = spark.createDataFrame([(k, i, w) for k, words, _ in pages for i, w in enumerate(words)], "page int, seq int, text string")
    texts = spark.createDataFrame([(k, t) for k, _, t in pages], "page int, assembled string")
    got = [tuple(x) for x in conversion.missing_runs(rows, texts, ["page"], sorted(stop)).collect()]
    assert sorted(got) == sorted(want) and want


def test_conflict_windows():
    ours, theirs = "the plan was adopted on March 215, 2022 by the council", "the plan was  adopted on March [21st](x), 2022 by the council"
    assert conversion.conflict("215", ours, theirs) == ("plan was adopted on March 215, 2022 by the", "plan was adopted on March 21st, 2022 by the", ours)
    # where the nearest words differ, shorter windows are tried; without any the case is left
    assert conversion.conflict("x9", "a b c x9 d e", "q b c x8 d f")[:2] == ("b c x9 d", "b c x8 d")
    for token, a, b in (("x9", "x9 d e", "x8 d e"), ("x9", "a x9 d", "b x8 d"), ("x9", "a x9 d", "a x9 d"), ("zz", "a b", "a b"), (None, "a", "b"), ("a", None, "b")):
        assert conversion.conflict(token, a, b) is None


def test_a_choice_may_only_pick_what_was_offered(spark):
    cases = spark.createDataFrame([(1, "a", "b"), (2, "a", "b"), (3, "a", "b"), (4, "a", "b")], "case_id int, primary string, second string")
    choices = spark.createDataFrame([(1, "primary"), (2, "second"), (3, "neither")], "case_id int, choice string")
    got = {r["case_id"]: (r["settled"], r["needs_person"]) for r in conversion.adjudicated(cases, choices).collect()}
    assert got == {1: ("a", False), 2: ("b", False), 3: (None, True), 4: (None, True)}


def test_ingest_is_idempotent_and_refuses(spark):
    stored = spark.createDataFrame([("a", "h1")], "path string, content_hash string")
    kids = spark.createDataFrame([("a", 1), ("z", 1)], "path string, section int")
    batch = spark.createDataFrame([("a", "h1", "PASS", None), ("b", "h2", "REFUSE", "seen")], "path string, content_hash string, verdict string, override_reason string")
    new = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "path string, section int")
    docs, after = conversion.ingest(stored, kids, batch, new)
    first = sorted(map(tuple, docs.collect())), sorted(map(tuple, after.collect()))
    assert first == ([("a", "h1"), ("b", "h2")], [("a", 1), ("a", 2), ("b", 1), ("z", 1)])
    again = conversion.ingest(docs, after, batch, new)
    assert (sorted(map(tuple, again[0].collect())), sorted(map(tuple, again[1].collect()))) == first
    for bad in (("a", "other", "PASS", None), ("c", "h", "REFUSE", "")):
        with pytest.raises(Exception, match="cannot be ingested"):
            conversion.ingest(stored, kids, spark.createDataFrame([bad], batch.schema), new)[0].collect() or conversion.ingest(stored, kids, spark.createDataFrame([bad], batch.schema), new)[1].collect()


def test_reheading(spark):
    text = "<!-- p.1 -->\nThe Plan\n\nIntro\n# One #\n#### A *b*\n<figure_description>\n# inside\n</figure_description>\n### Two\n## Three\nend\n"
    want = "<!-- p.1 -->\n# The Plan\n\nIntro\n## One\n**A \\*b\\***\n<figure_description>\n# inside\n</figure_description>\n## Two\n## Three\nend\n"
    rows = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "# Head\nprose")], "id int, md string")
    got = {r["id"]: tuple(r)[1:] for r in markdown.reheading(rows, "id", "md").collect()}
    assert got == {1: (want, 1, 2, 1, 1), 2: ("", 0, 0, 0, 0), 3: ("", 0, 0, 0, 0), 4: ("## Head\nprose", 0, 1, 0, 0)}
    assert one(spark, markdown.superscript(F.col("t")), t="the A 2 ZERO and CA 2 ZEROS") == "the A²ZERO and CA 2 ZEROS"


def test_page_comments(spark):
    text = "Start\n\n# Head\n\n## Sub\n\nBody [Source: Page 2]\n\nNext\n\n# Last\n\nEnd [Source: Page 5] [Source: Page 6]"
    rows = spark.createDataFrame([(1, text), (2, None), (3, "no pages")], "id int, md string")
    got = {r["id"]: r["markdown"] for r in markdown.page_comments(rows, "id", "md").collect()}
    assert got == {1: "Start\n\n# Head\n\n<!-- p.2 -->\n\n## Sub\n\nBody\n\nNext\n\n<!-- p.5 -->\n\n# Last\n\nEnd\n", 2: "\n", 3: "no pages\n"}
    blocks = [tuple(r)[1:] for r in markdown.page_blocks(rows, "id", "md").where("id = 1").orderBy("block").collect()]
    assert blocks[3:6] == [(3, "Body", 2, "explicit", 1), (4, "Next", 2, "inferred", 0), (5, "# Last", 2, "inferred", 0)] and blocks[6][3:] == ("explicit", 2)


def test_roster_hits():
    names, roles = ["Ann Mallek", "Mallika Kothari", "Lee Wu"], ["councilmember", "youth member", "chair"]
    assert speakers.roster_hit("Malik", names, roles) == "Mallika Kothari"
    assert speakers.roster_hit("Malik", names, roles, "Council  Member") == "Ann Mallek"
    assert speakers.roster_hit("Katari", names, roles) == "Mallika Kothari"
    assert speakers.roster_hit("Wu", names, roles) is None and speakers.roster_hit("Zebra", names, roles) is None and speakers.roster_hit(None, [], []) is None


def resolved(turns, names, roles, human):
    """The rules as a loop over one recording."""
    got = {}

    def offer(who, name, method, confidence):
        if who not in got or speakers.RANK[method] < speakers.RANK[got[who][1]]:
            got[who] = (name, method, confidence)

    for who, name in human.items():
        offer(who, name, "human", 1.0)
    for t in turns:
        for m in re.finditer(speakers.SELF, t["text"]):
            hit = speakers.roster_hit(m[1].split()[-1], names, roles) or speakers.roster_hit(m[1], names, roles)
            offer(t["speaker"], hit or m[1], "self_id", 0.95 if hit else 0.9)
    for i, t in enumerate(turns):
        calls, hand = re.findall(speakers.CALL, t["text"]), re.search(speakers.HANDOFF, t["text"].strip())
        if calls:
            hit = speakers.roster_hit(calls[-1][1], names, roles, calls[-1][0])
            for n in turns[i + 1 : i + 3] if hit else []:
                if n["speaker"] == t["speaker"]:
                    continue
                if n["start_s"] - t["end_s"] <= 6 and len(n["text"].strip()) < 60:
                    here = re.search(speakers.ANSWER, n["text"].strip())
                    offer(n["speaker"], hit, "roll_call" if here else "chair_address", 0.85 if here else 0.6)
                break
        elif hand and (hit := speakers.roster_hit(hand[2], names, roles, hand[1])) and i + 1 < len(turns):
            n = turns[i + 1]
            if n["speaker"] != t["speaker"] and n["end_s"] - n["start_s"] > 8:
                offer(n["speaker"], hit, "chair_address", 0.7)
    return {who: got.get(who, (None, None, None)) for who in {t["speaker"] for t in turns}}


def test_speakers_equal_direct_loop(spark):
    r = random.Random(12)
    names, roles = ["Ann Mallek", "Bob Curtis", "Cy Levin"], ["councilmember", "chair", "member"]
    said = ["Commissioner Levin?", "Chair Curtis? Commissioner Levine?", "Thank you, Council Member Mallek.", "Here.", "present", "I'm Ann Malek, Ward 2", "my name is Zed Unknown", "no", "A very long speech that says nothing of note " * 3, "Director Levin?", "Commissioner Nobody?"]
    rows, want = [], {}
    for rec in range(80):
        at, turns = 0.0, []
        for seq in range(r.randint(1, 12)):
            length = r.choice([1.0, 5.0, 12.0])
            turns.append({"seq": seq, "speaker": r.choice("abcd"), "start_s": at, "end_s": at + length, "text": r.choice(said)})
            at += length + r.choice([0.5, 7.0])
        human = {"a": "Heard"} if rec % 5 == 0 else {}
        want |= {(rec, who): v for who, v in resolved(turns, names, roles, human).items()}
        rows += [(rec, t["seq"], t["speaker"], t["start_s"], t["end_s"], t["text"]) for t in turns]
    turns = spark.createDataFrame(rows, "media_id int, seq int, speaker string, start_s double, end_s double, text string")
    roster = spark.createDataFrame([(k, n, x) for k in range(80) for n, x in zip(names, roles)], "media_id int, name string, role string")
    human = spark.createDataFrame([(k, "a", "Heard") for k in range(0, 80, 5)], "media_id int, speaker string, name string")
    got = {(x["media_id"], x["speaker"]): (x["name"], x["method"], x["confidence"]) for x in speakers.resolve_speakers(turns, roster, human).collect()}
    assert got == want and {v[1] for v in want.values()} == {"human", "self_id", "roll_call", "chair_address", None}


def test_backend_failures_stay_in_their_row(spark):
    def call(row):
        if row["id"] == 2:
            raise ValueError("unreadable")
        return {"words": len(row["path"].split("/"))} if row["id"] != 3 else None

    rows = spark.createDataFrame([(1, "a/b"), (2, "x"), (3, "y")], "id int, path string")
    got = {r["id"]: (r["words"], r["error"]) for r in probes.backend(rows, call, "words int", ["id"]).collect()}
    assert got == {1: (2, None), 2: (None, "ValueError: unreadable"), 3: (None, None)}


def test_sections_in_another_rendering(spark):
    heads = spark.createDataFrame(
        [(1, 0, "STRATEGY 1: Power", "one"), (1, 1, "1: Powering the Grid", "two"), (1, 2, "STRATEGY 2: Homes", "three"), (1, 3, "Summary", "four"), (1, 4, "SUMMARY ", "five"), (1, 5, "2: Homes", "six")],
        "doc_id int, seq int, heading string, body string",
    )
    got = [tuple(r) for r in documents.merged_headings(heads).orderBy("seq").collect()]
    assert got == [(1, 0, "STRATEGY 1: Power", "one\n\ntwo"), (1, 2, "STRATEGY 2: Homes", "three"), (1, 3, "Summary", "four\n\nfive"), (1, 5, "2: Homes", "six")]
    assert one(spark, documents.anchor_phrase(F.col("b")), b="\n- See [the plan](http://x) – it’s A²ZERO now and more and more") == "See the plan - it's A2ZERO now and"
    texts = spark.createDataFrame([(1, "Intro words\nSee the plan - it's A2ZERO  now and more. End of it")], "doc_id int, text string")
    anchors = spark.createDataFrame([(1, 0, "Intro words"), (1, 1, "absent words"), (1, 2, "See the plan – it’s A²ZERO now"), (1, 3, ""), (1, 4, "End")], "doc_id int, seq int, anchor string")
    assert sorted(tuple(r) for r in documents.locate_sections(anchors, texts).collect()) == [(1, 0, 0, 2), (1, 1, None, None), (1, 2, 2, 11), (1, 3, None, None), (1, 4, 11, 14)]


def test_captions_go_to_the_next_section_of_their_page(spark):
    rows = [(1, "heading", 1), (2, "para", 1), (3, "caption", 2), (4, "heading", 2), (5, "caption", 2), (6, "heading", 3), (7, "caption", 3), (8, "heading", 4), (9, "para", None), (10, "caption", None), (11, "heading", None)]
    df = spark.createDataFrame([(1, *r) for r in rows], "doc int, seq int, kind string, page_no int")
    got = [r["section"] for r in documents.captioned_sections(df, "doc", "seq", F.col("kind") == "heading").orderBy("seq").collect()]
    assert got == [1, 1, 2, 2, 2, 3, 3, 4, 4, 4, 5]


def test_enrolling_twice_changes_nothing(spark):
    prints = spark.createDataFrame([(1, [1.0, 0.0], 1, ["a:A"])], "person_id long, embedding array<double>, sample_count int, media array<string>")
    rows = [("b", "A", "confirmed", "x", 1, True, True, [0.0, 1.0]), ("a", "A", "confirmed", "x", 1, True, True, [5.0, 5.0]), ("c", "A", "confirmed", "y", 2, True, True, [3.0, 4.0]), ("a", "A", "confirmed", "z", 3, True, True, [1.0, 1.0]), ("d", "A", "open", "z", 3, True, True, [1.0, 1.0])]
    asked = spark.createDataFrame(rows, "media_id string, cluster string, decision string, name string, person_id long, confident boolean, is_public_figure boolean, embedding array<double>")
    decided = curation.enrolments(asked, prints)
    assert sorted((r["media_id"], r["person_id"], r["action"]) for r in decided.collect()) == [("a", 1, "enrolled already"), ("a", 3, "refused: enrolled for someone else"), ("b", 1, "enrol"), ("c", 2, "enrol")]
    once = {r["person_id"]: r for r in curation.enrolled(prints, decided).collect()}
    assert [round(x, 6) for x in once[1]["embedding"]] == [0.707107, 0.707107] and once[1]["sample_count"] == 2 and once[1]["media"] == ["a:A", "b:A"]
    assert [round(x, 6) for x in once[2]["embedding"]] == [0.6, 0.8] and once[2]["sample_count"] == 1
    stored = spark.createDataFrame(list(once.values()), "person_id long, embedding array<double>, sample_count int, media array<string>")
    assert {r["person_id"]: r for r in curation.enrolled(stored, curation.enrolments(asked, stored)).collect()} == once


def test_key_terms_of_an_agenda(spark):
    titles = ["Ann O'Lee Young - Parks (in person)", "City Council - Roll", "Resolution for Therapaws of Michigan and the Huron River Watershed", "Therapaws of Michigan partnership\nwith Bryant Neighborhood", None, "ann lee - lower case", "Public Hearing Notice"]
    rows = spark.createDataFrame([(1, k, t) for k, t in enumerate(titles)], "event_id int, seq int, title string")
    found = curation.agenda_terms(rows, "event_id")
    assert [(r["source"], r["rank"], r["term"]) for r in found.orderBy("source", "rank").collect()] == [
        ("agenda_proper_nouns", 1, "Therapaws of Michigan"),
        ("agenda_proper_nouns", 2, "Bryant Neighborhood"),
        ("agenda_proper_nouns", 3, "Huron River Watershed"),
        ("agenda_speakers", 0, "Ann O'Lee Young"),
    ]
    given = [("roster", k, t) for k, t in enumerate(["bryant neighborhood", "ab", "x" * 50, "one two three four five six", "a<b>c", "  Solar Fund  ", None])]
    listed = spark.createDataFrame([(1, *g) for g in given], "event_id int, source string, rank long, term string").unionByName(found)
    got = [r["term"] for r in curation.key_terms(listed, "event_id", ["roster", "agenda_speakers", "agenda_proper_nouns"]).orderBy("place").collect()]
    assert got[:3] == ["bryant neighborhood", "Solar Fund", "Ann O'Lee Young"] and "Bryant Neighborhood" not in got and len(got) == len({t.lower() for t in got})


def test_footnotes_are_referred_to_by_the_second_read(spark):
    units = [(1, "para", "In Year Two, we:", 0), (2, "para", "In Year Two, we:", 40), (3, "para", "They met:", 60), (4, "footnote", "1 For more information see", 80), (5, "footnote", "14 Another one of them", 90), (6, "footnote", "3 Too short", 95), (7, "footnote", "2 Outside of all sections", 300)]
    df = spark.createDataFrame([(1, *u) for u in units] + [(2, *units[0]), (2, *units[3])], "doc_id int, seq int, kind string, text string, char_start int")
    sections = spark.createDataFrame([(1, 10, 0, 30), (1, 11, 30, 100), (2, 12, 0, 200)], "doc_id int, id int, char_start int, char_end int")
    second = spark.createDataFrame([(1, "In Year Two, we: x In Year Two, we 14 : and so on"), (2, "In Year Two, we11: no")], "doc_id int, second string")
    got = sorted((r["doc_id"], r["number"], r["section_id"], r["referred_at"]) for r in conversion.footnotes(df, sections, second).collect() if r["number"] != 2)
    assert got == [(1, 1, 11, None), (1, 14, 11, 55), (2, 1, 12, None)]
    assert [r["section_id"] for r in conversion.footnotes(df, sections, second).where("number = 2").collect()] == [None]
