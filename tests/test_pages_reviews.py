"""Page geometry, reviews, second readings, upserts and inheritance against direct loops."""

import random
from statistics import median

from pyspark.sql import functions as F

from attesta.operators import geometry, review, writes


def test_cells_split_like_a_loop(spark):
    rng = random.Random(2)
    words, cells = [], []
    for t in range(60):
        x, line = 0.0, []
        for _ in range(rng.randint(0, 6)):
            x += rng.choice([2.0, 3.0, 29.9, 30.0, 30.1, 80.0])
            line.append((t, 0, 2, x, x + 10, rng.choice([0.0, 9.0]), rng.choice([None, 0.0, 8.0, 10.0, 12.0]), f"w{len(line)}"))
            x += 10
        words += line
        cells.append((t, 0, 2, 3, " ".join(w[7] for w in line)))
    cells.append((99, 1, 0, 1, None))
    got = geometry.split_cells(spark.createDataFrame(cells, "t int, row int, col int, col_span int, text string"), spark.createDataFrame(words, "t int, row int, col int, x0 double, x1 double, height double, size double, text string"), ["t"])
    want = []
    for t, r, c, span, text in cells:
        mine = [w for w in words if w[0] == t]
        ems = sorted(w[6] or w[5] or 10.0 for w in mine)
        parts = [[]]
        for k, w in enumerate(mine):
            if k and w[3] - mine[k - 1][4] > 3 * ems[len(ems) // 2]:
                parts.append([])
            parts[-1].append(w[7])
        want += [(t, r, c + k, 1, " ".join(p), True) for k, p in enumerate(parts)] if len(parts) > 1 else [(t, r, c, span, text, False)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str) and any(w[5] for w in want)


def test_token_verdicts_like_a_loop(spark):
    rng = random.Random(3)
    glyphs, tokens, second, want = [], [], [], {}
    for d in range(300):
        run = "".join(rng.choices("abc", k=rng.randint(0, 9)))
        size = rng.choice([0.0, 9.0, 9.0, 40.0])
        gaps = rng.choices([0.0, 0.1, 0.9, 2.16], [20, 3, 1, 4], k=len(run))
        x = 0.0
        places = []
        for c, g in zip(run, gaps):
            places.append((x, x + 5))
            x += 5 + g
        glyphs += [(d, k, c, a, b, size) for k, (c, (a, b)) in enumerate(zip(run, places))]
        token = run[1:7] if d % 9 else "zz"
        heard = set(rng.choices(["a", "b", "c", "ab", "bc", "ca", "aa"], k=9))
        tokens.append((d, token))
        second += [(d, w) for w in heard]
        at = run.find(token) if token else -1
        if at < 0:
            want[d] = ("unresolved", None)
            continue
        inner = [places[at + k + 1][0] - places[at + k][1] for k in range(len(token) - 1)]
        floor = max(0.15 * size, 2 * median(inner)) if inner and size > 0 else None
        cuts = [0, *([k + 1 for k, g in enumerate(inner) if g >= floor] if floor is not None else []), len(token)]
        parts = [token[a:b] for a, b in zip(cuts, cuts[1:])]
        if floor is not None and any(0.03 * size < g < floor for g in inner):
            verdict = "unresolved"
        else:
            verdict = "primary" if len(parts) == 1 else "second" if set(parts) <= heard else "unresolved"
        want[d] = (verdict, parts)
    got = geometry.token_verdicts(spark.createDataFrame(tokens, "doc_id int, token string"), spark.createDataFrame(glyphs, "doc_id int, position int, character string, x0 double, x1 double, size double"), spark.createDataFrame(second, "doc_id int, word string"))
    assert {r["doc_id"]: (r["verdict"], r["parts"]) for r in got.collect()} == want
    assert {v for v, _ in want.values()} == {"primary", "second", "unresolved"}


def test_contents_of_two_columns(spark):
    def entry(page, x, top, title, ref, lead=False):
        if lead:
            return [(1, page, top, x, x + 8.0, str(ref)), (1, page, top, x + 30.0, x + 90.0, title)]
        return [(1, page, top, x, x + 60.0, title), (1, page, top, x + 120.0, x + 130.0, str(ref))]

    words = [(1, 1, 0.0, 100.0, 300.0, "CONTENTS")]
    for k in range(4):
        words += entry(1, 50.0, 20.0 + 12 * k, f"Left{k}", 3 + k) + entry(1, 330.0, 20.0 + 12 * k, f"Right{k}", 30 + k)
        words += entry(2, 50.0, 20.0 + 12 * k, f"Near{k}", 50 + k, True) + entry(2, 330.0, 20.0 + 12 * k, f"Far{k}", 60 + k, True)
    df = spark.createDataFrame(words, "doc int, page int, top double, x0 double, x1 double, text string")
    got = geometry.contents_of_columns(df, ["doc", "page"], ["doc"]).orderBy("page", "entry").collect()
    assert [(r["page"], r["title"], r["page_ref"]) for r in got] == [(1, f"{n}{k}", b + k) for n, b in (("Left", 3), ("Right", 30)) for k in range(4)] + [(2, f"{n}{k}", b + k) for n, b in (("Near", 50), ("Far", 60)) for k in range(4)]
    assert {r["level"] for r in got if r["page"] == 1} == {1}
    assert geometry.contents_of_columns(df.where("false"), ["doc", "page"], ["doc"]).count() == 0


def test_contents_pages_with_numbers_that_are_line_numbers(spark):
    pages = [("Intro 19\n32 Part two\nCosts 51\nMore 57",), ("a\nb\nc 3",), (None,), ("x .... 1\ny ..... 2\nz …… 3",)]
    assert [r["c"] for r in spark.createDataFrame(pages, "t string").select(geometry.is_contents(F.col("t")).alias("c")).collect()] == [True, False, False, True]


SHEET = "row_no int, k string, text string, speaker string, flag string"


def test_review_is_merged_once(spark):
    base = spark.createDataFrame([("a", "t", None, None), ("b", "t", "Ann", None), ("c", "t", None, "wrong"), ("d", "t", None, None), ("e", "t", None, None)], "k string, text string, speaker string, flag string")
    sheet = spark.createDataFrame(
        [(2, "a", "t", " Bob ", None), (3, "b", "t!", "  ", None), (4, "c", "t", None, "odd"), (5, "d", "t", "Cy", None), (6, "d", "t", "Di", None), (7, "", "t", "Ed", None), (8, "x", "t", "Fy", None), (9, "e", None, "Gus", None), (10, None, "t", None, None)], SHEET
    )
    current = spark.createDataFrame([("b", "Ann", None), ("c", None, "unclear"), ("e", "Hal", None), ("z", "Ida", None)], "k string, speaker string, flag string")
    after, findings = review.import_review(base, sheet, current, "k", ["text"], ["speaker", "flag"], {"flag": ("wrong",)})
    # b's speaker was taken out; c and e were decided otherwise meanwhile
    assert sorted(map(tuple, after.collect())) == [("a", "Bob", None), ("c", None, "unclear"), ("e", "Hal", None), ("z", "Ida", None)]
    assert sorted(((r["row_no"], r["finding"], r["before"], r["after"]) for r in findings.collect()), key=str) == sorted(
        [(3, "tampered", "t", "t!"), (4, "conflict", "unclear", "odd"), (4, "unknown", None, "odd"), (5, "repeated", None, None), (6, "repeated", None, None), (7, "no key", None, None), (8, "orphan", None, None), (9, "conflict", "Hal", "Gus")], key=str
    )
    again, _ = review.import_review(base, sheet, after, "k", ["text"], ["speaker", "flag"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, after.collect()))


def test_second_reads_apply_once_and_follow_the_text(spark):
    sections = spark.createDataFrame([(1, "h1", "cost $5 now", {"ocr_conflicts": "x", "keep": "y"}, "clean"), (2, "h2", "a b c", {"ocr_corroborated": "r"}, "clean"), (3, "h3", None, None, "clean"), (4, "h4", " ".join(f"w{k}" for k in range(40)), {}, None)], "id int, content_hash string, text string, parse_flags map<string,string>, parse_confidence string")
    reads = spark.createDataFrame([("h1", "r2", "now the cost is $5"), ("h1", "r9", ""), ("old", "r1", "a b c"), ("h3", "r1", None), ("h4", "r1", "")], "content_hash string, reader string, other string")
    once = review.apply_second_reads(sections, reads)
    got = {r["id"]: (r["parse_flags"], r["parse_confidence"]) for r in once.collect()}
    assert got[1] == ({"keep": "y", "ocr_corroborated": "r2"}, "unaudited") and got[2] == ({}, "clean") and got[3] == ({"ocr_corroborated": "r1"}, "unaudited")
    assert len(got[4][0]["ocr_conflicts"].split("|")) == 20
    assert {r["id"]: (r["parse_flags"], r["parse_confidence"]) for r in review.apply_second_reads(once, reads).collect()} == got


def test_words_that_differ(spark):
    pairs = spark.createDataFrame([(1, "the plan", "the plan works zq"), (2, "the the end.", "the end."), (3, None, "works"), (4, "same", "same"), (5, "", "")], "id int, ours string, theirs string")
    known = review.lexicon(spark.createDataFrame([("the works",), ("the plan works",)], "text string"))
    got = {r["id"]: tuple(r)[1:] for r in review.differing_words(pairs, known, "id").collect()}
    assert got == {1: (2, 0, 0.5, None, True), 2: (0, 1, None, 1.0, False), 3: (1, 0, 1.0, None, False), 4: (0, 0, None, None, False), 5: (0, 0, None, None, False)}


def test_partial_keys_and_links(spark):
    schema = "id int, body int, ext int, day int, place string, url string"
    old = spark.createDataFrame([(1, 1, None, 1, None, "a"), (2, 1, 7, 2, "p", None), (3, 2, None, 1, "q", None), (4, 2, None, 1, None, None)], schema)
    new = spark.createDataFrame([(11, 1, 5, 1, "x", "b", 1), (12, 1, 6, 1, "y", None, 2), (13, 1, 7, 9, "z", "c", 3), (14, 2, 8, 1, "w", None, 4), (15, 3, 9, 1, None, None, 5), (16, 3, 10, 1, "v", None, 6)], schema + ", seq int")
    rows, outcomes = writes.link_or_insert(old, new, ["body", "day"], ["body", "ext"], "seq", ["place", "url"], ["day", "url"])
    assert sorted(map(tuple, rows.collect()), key=str) == sorted([(1, 1, 6, 1, "x", "a"), (2, 1, 7, 9, "p", "c"), (3, 2, None, 1, "q", None), (4, 2, None, 1, None, None), (15, 3, 10, 1, "v", None)], key=str)
    assert {r["seq"]: (r["outcome"], r["hits"]) for r in outcomes.collect()} == {1: ("linked", 1), 2: ("linked", 1), 3: ("updated", 0), 4: ("ambiguous", 2), 5: ("inserted", 0), 6: ("linked", 0)}
    items = spark.createDataFrame([(1, None, "a", "x"), (2, 5, "b", "x")], "id int, ext int, title string, act string")
    more = spark.createDataFrame([(3, None, "c", "y", 1), (4, 5, "d", "y", 2), (5, 5, "e", "z", 3), (6, 6, "f", "y", 4), (7, 6, "g", "z", 5)], "id int, ext int, title string, act string, seq int")
    after = writes.upsert_where(items, more, ["ext"], "seq", ["act"])
    assert sorted(map(tuple, after.collect()), key=str) == sorted([(1, None, "a", "x"), (3, None, "c", "y"), (2, 5, "b", "z"), (6, 6, "f", "z")], key=str)


def test_inheritance_asks_sources_in_order(spark):
    rows = spark.createDataFrame([(1, None, 1, 1), (2, 9, 1, 1), (3, None, 2, 1), (4, None, 3, 2), (5, None, None, None)], "id int, v int, a int, b int")
    a = spark.createDataFrame([(1, 5), (1, 5), (2, 6), (2, 7), (3, None)], "a int, v int")
    b = spark.createDataFrame([(1, 8), (2, 1), (2, 2)], "b int, v int")
    live = spark.createDataFrame([(5, 50)], "id int, survivor int")
    after, queue, counts = writes.inherit(rows, "id", "v", [("first", a, ["a"]), ("second", b, ["b"])], live)
    assert sorted((r["id"], r["v"], r["provenance"]) for r in after.collect() if r["v"] is not None) == [(1, 50, "first"), (2, 9, None), (3, 8, "second")]
    assert sorted((r["id"], r["reason"], r["candidates"]) for r in queue.collect()) == [(4, "ambiguous", [1, 2]), (5, "no candidate", [])]
    assert {r["provenance"]: r["filled"] for r in counts.collect()} == {"first": 1, "second": 1}


def test_the_largest_picture_goes_with_a_figure(spark):
    from attesta.sources import records

    figures = spark.createDataFrame([(1, "a", "x"), (1, "b", "y"), (2, "a", "z")], "page_no int, top_label string, file string")
    pictures = spark.createDataFrame([(1, "a", [5.0, 0.0], 0.2), (1, "a", [9.0, 0.0], 0.4), (1, "a", [7.0, 1.0], 0.4), (1, "a", [7.0, 1.0], 0.4), (2, "q", [1.0], 0.1)], "page_no int, top_label string, bbox array<double>, area_frac double")
    got = sorted((r["file"], r["picture_bbox"], r["area_frac"]) for r in records.figures_with_pictures(figures, pictures).collect())
    assert got == [("x", [7.0, 1.0], 0.4), ("y", None, None), ("z", None, None)]
