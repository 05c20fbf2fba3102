"""Queries over whole inputs, compared with direct loops on small tables written for the purpose."""

from itertools import combinations

from attesta.operators import similarity
from attesta.plans import catalog, registry, views  # noqa: F401
from attesta.plans.store import Store


def written(spark, folder, **tables):
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def collected(spark, name, folder):
    return [r.asDict() for r in registry.QUERIES[name](spark, folder).collect()]


PART = "p_partkey long, p_name string, p_brand string, p_type string, p_size int"


def test_dedup_takes_all_parts(spark, tmp_path):
    names = [("large ring", "LARGE"), ("red ring", "LARGE"), ("large ring", "LARGE"), ("blue bolt", "SMALL"), ("red ring", "LARGE")]
    rows = [(k, names[k % 5][0], f"Brand#{k}", names[k % 5][1], k) for k in range(1, 25)]
    sf = written(spark, tmp_path, part=(rows, PART))
    tokens = {k: frozenset(f"{n} {t}".lower().split()) for k, n, _, t, _ in rows}
    assert {r["id"]: r["roots"] for r in collected(spark, "identity_roots", sf)} == {k: "|".join(sorted(t)) for k, t in tokens.items()}
    score = {(a, b): len(tokens[a] & tokens[b]) / len(tokens[a] | tokens[b]) for a, b in combinations(tokens, 2)}
    links = [a for (a, b), s in score.items() if s >= 0.6]
    assert {r["least_id"]: r["links"] for r in collected(spark, "dedup_link_counts", sf)} == {a: links.count(a) for a in links}
    first = {t: min(k for k in tokens if tokens[k] == t) for t in tokens.values()}
    near = {(max(a, b), min(a, b)) for (a, b), s in score.items() if 0.6 <= s < 1 and {a, b} <= set(first.values()) and not (b % 4 == 0 and a == b - 1)}
    assert near and {(r["survivor"], r["duplicate"]) for r in collected(spark, "dedup_pairs", sf)} == near


def test_resolve_asks_every_part(spark, tmp_path):
    rows = [(k, f"word{k % 300} ring", f"Brand#{k % 500}", "LARGE", 1) for k in range(395, 805)]
    sf = written(spark, tmp_path, part=(rows, PART))
    want = {}
    for k, name, brand, *_ in rows:
        q = {0: name, 1: brand.upper(), 2: name.split(" ")[0], 3: "nobody"}[k % 4]
        tiers = [[r[0] for r in rows if r[1] == q], [r[0] for r in rows if r[2].upper() == q], [r[0] for r in rows if r[1].split(" ")[0] == q]]
        tier = next((i for i, hits in enumerate(tiers) if hits), None)
        hits = tiers[tier] if tier is not None else []
        want[k] = (hits[0] if len(hits) == 1 else None, tier, ("none", "resolved")[len(hits)] if len(hits) < 2 else "ambiguous")
    got = collected(spark, "resolve_tiers", sf)
    assert len(got) == len(rows) and {r["id"]: (r["hit"], r["tier"], r["state"]) for r in got} == want
    assert {w[2] for w in want.values()} == {"none", "resolved", "ambiguous"}


def test_roll_calls_read_every_order(spark, tmp_path):
    sf = written(spark, tmp_path, orders=([(k,) for k in range(1990, 2020)], "o_orderkey long"))
    got = {r["id"]: (r["present"], r["absent"], r["reliable"]) for r in collected(spark, "roll_calls", sf)}
    assert got == {k: (2, 1, True) if k % 5 in (0, 3) else (0, 0, False) for k in range(1990, 2020)}


def test_prompt_leaks_seek_every_item(spark, tmp_path):
    items = [(1, "a b c d e f"), (2, "too short"), (3, "v w x y z"), (4, None)]
    docs = [(1, "we saw b c d e f here"), (2, "a b c d only"), (3, "v w x y z"), (4, "too short"), (5, None)]
    sf = written(spark, tmp_path, benchmark=(items, "item_id long, text string"), documents=(docs, "doc_id long, text string"))
    assert sorted(r["doc_id"] for r in collected(spark, "prompt_leaks", sf)) == [1, 3]


def test_store_tables_hold_all_rows(spark):
    s = Store(spark, "/root/testdata/sf0.001")
    events, lines = s.raw("events"), s.raw("lineitem")
    for name in ("vocabulary_proposals", "reference_segments", "words"):
        assert getattr(s, name).count() == events.count()
    assert s.quantities.count() == lines.count()
    cited = s.event_attestations
    assert cited.select("claim_id").distinct().count() == lines.selectExpr("l_orderkey * 10 + l_linenumber as id").distinct().count()
    assert cited.select("asserted_event_id").distinct().count() == events.select("user_id").distinct().count()


def test_contained_passages_of_any_length(spark):
    docs = [(1, "the city council met"), (2, "a councilman  spoke at noon today"), (3, "x"), (4, ""), (5, None), (1, "again the city council met here")]
    items = [(1, "council"), (2, "city council"), (3, "the city council met"), (4, "he city cou"), (5, " spoke at"), (6, ""), (7, None), (8, "noon today and"), (9, "at noon tod"), (10, "  ")]
    left = spark.createDataFrame(docs, "doc_id long, text string")
    right = spark.createDataFrame(items, "item_id long, passage string")
    want = sorted((d, i) for d, t in docs for i, p in items if t is not None and p is not None and p in t)
    got = sorted((r["doc_id"], r["item_id"]) for r in similarity.contained(left, right).collect())
    assert sorted(set(got)) == sorted(set(want)) and len([g for g in got if g[0] != 1]) == len([w for w in want if w[0] != 1])
    assert similarity.contained(left, right.where("false")).count() == 0 and similarity.contained(left.where("false"), right).count() == 0


def test_views_are_shown_in_their_order(spark):
    rows = registry.QUERIES["v_open_commitments"](spark, "/root/testdata/sf0.001").orderBy(*views.shown_order("v_open_commitments")).collect()
    dates = [r["due_date"] for r in rows]
    known = [d for d in dates if d is not None]
    assert known == sorted(known) and dates[len(known) :] == [None] * (len(dates) - len(known)) and len(known) < len(dates)
    assert "Exchange rangepartitioning" not in registry.QUERIES["v_open_commitments"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
