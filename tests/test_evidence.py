"""Links in sentences, vocabulary candidates, similar words and merges against direct loops."""

import random
import re
from collections import Counter, defaultdict
from difflib import SequenceMatcher

import pytest

from attesta.operators import links, merging, similarity, speech
from attesta.plans import catalog, registry  # noqa: F401
from attesta.plans.store import Store
from attesta.sources.snapshots import Snapshots

SF = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- sentences


def loop_sentences(text):
    """(start, end) of sentences: a look at every character."""
    cuts, begin = [], 0
    for k, c in enumerate(text):
        before = text[:k]
        stop = any(before.endswith(a) and not (before[: -len(a)][-1:].isalnum() or before[: -len(a)][-1:] == "_") for a in links.ABBREVIATIONS)
        if c in ".!?" and not before[-1:].isdigit() and not stop and text[k + 1 : k + 2] == " " and re.match("[\"“(A-Z0-9-]", text[k + 2 : k + 3]):
            cuts.append((begin, k + 1))
            begin = k + 2
    return [*cuts, (begin, len(text))]


BLOCKS = [
    (1, 0, 0, "Dr. Ames  met St. Paul.  The cost is $5.4 in No. 7. Then Fr. Left? Yes! \n (See U.S. Code.) abc. def ADr. Next"),
    (1, 1, 0, None),
    (1, 2, 0, " \t "),
    (1, 3, 1, "One. Two. Three.\x01Four "),
    (1, 4, 1, "The cost is $5.4 again. “Quote.” End"),
    (2, 0, 0, "."),
    (None, 0, 0, "A. B. C"),
]


@pytest.fixture(scope="module")
def blocks(spark):
    return spark.createDataFrame(BLOCKS, "doc long, seq int, page int, text string")


def loop_spine():
    docs, out = defaultdict(str), {}
    for d, k, p, t in BLOCKS:
        t = re.sub(r"[\x01\t-\r ]+", " ", t or "").strip(" ")
        if t:
            docs[d] += "\n\n" * bool(docs[d])
            out[d, k] = (len(docs[d]), p, t)
            docs[d] += t
    return docs, out


def test_sentences_equal_a_loop(blocks):
    _, spine = loop_spine()
    placed = links.spine(blocks, "doc", "seq", "page", "text")
    assert {(r["doc"], r["seq"]): (r["char_start"], r["page"], r["text"]) for r in placed.collect()} == spine
    got = sorted(((r["doc"], r["seq"], r["sentence_no"], r["sentence_start"], r["sentence_end"], r["sentence"]) for r in links.sentences(placed, "doc", "seq", "text").collect()), key=str)
    want = [(d, k, n, at + a, at + b, t[a:b]) for (d, k), (at, _, t) in spine.items() for n, (a, b) in enumerate(loop_sentences(t))]
    assert got == sorted(want, key=str) and len(want) > len(BLOCKS)


def test_links_find_their_sentences(spark, blocks):
    docs, spine = loop_spine()
    rows = [
        (1, 1, 0, "u", "met St.\nPaul"), (2, 1, 0, "u", "cost is"), (3, 1, 1, "u", "cost is"), (4, 1, 0, "u", "Three"), (5, 1, 1, "v", "two"), (6, 1, 1, "v", None), (7, 1, 1, "w", "  "),
        (8, 1, 0, "u", "Paul. The cost"), (9, 2, 0, "u", "."), (10, 3, 0, "u", "x"), (11, 1, 0, "u", "(See"), (12, 1, 1, "u", "Four The"),
    ]
    answers = [(1, 1, "v", "two. three", 1), (1, 1, "v", " Two.  Three. ", 2), (1, 1, "v", "Four", 3), (1, 0, "u", "Dr. Ames met", 1), (3, 0, "u", "x", 1), (1, 1, "w", None, 1)]
    placed = links.spine(blocks, "doc", "seq", "page", "text")
    found = links.locate_anchors(spark.createDataFrame(rows, "id int, doc long, page int, uri string, anchor_text string"), placed, "doc", "page", "seq", "text")
    known = links.accept_anchors(found, spark.createDataFrame(answers, "doc long, page int, uri string, sentence string, n int"), placed, "doc", "page", "seq", "text", "n")
    got = {r["id"]: r for r in links.with_context(known, placed, "doc", "seq", "text").collect()}
    for i, d, p, uri, anchor in rows:
        a = re.sub(r"\s+", " ", anchor or "").strip()
        hit = next(((k, at + t.index(a), a) for (doc, k), (at, page, t) in spine.items() if doc == d and page == p and a and a in t), None)
        by = "text" if hit else None
        if not hit:
            for ad, ap, au, sentence, _ in sorted(answers, key=lambda x: x[4]):
                q = re.sub(r"\s+", " ", sentence or "").strip()
                if (ad, ap, au) == (d, p, uri) and q and q in docs[d]:
                    at = docs[d].index(q)
                    hit, by = (max(k for (doc, k), (b, _, _) in spine.items() if doc == d and b <= at), at, q), "answer"
                    break
        r = got[i]
        assert r["anchored_by"] == by and r["located"] == bool(hit)
        if not hit:
            assert (r["char_start"], r["block"], r["context_sentence"], r["anchor_text"]) == (None, None, None, anchor)
            continue
        k, at, a = hit
        base, _, t = spine[d, k]
        touched = [(x, y) for x, y in loop_sentences(t) if base + x < at + len(a) and base + y > at]
        assert (r["block"], r["char_start"], r["char_end"]) == (k, at, at + len(a)) and r["context_sentence"] == t[touched[0][0] : touched[-1][1]]
    assert {r["anchored_by"] for r in got.values()} == {"text", "answer", None} and len(got) == len(rows)


# ---------------------------------------------------------------- vocabulary


def test_vocabulary_equals_a_loop(spark):
    c = spark.read.parquet(f"{SF}/conversations.parquet").limit(40)
    texts = {f"{r['conv_id']}-{r['turn']}": r["text"] for r in c.collect()}
    clips = {k: {"a": t, "b": re.sub("ou|tion", "u", t), "c": re.sub(r" (le|th|de) ", " um ", re.sub("er(?=[a-z])", "ar", t))} for k, t in texts.items()}
    clips["long"] = {"a": " ".join(f"word{'abcdefghij'[k % 10]}{'xyz' [k % 3]}" for k in range(200)), "b": "", "c": ""}
    clips["long"]["b"] = clips["long"]["a"]
    clips["long"]["c"] = clips["long"]["a"].replace("word", "ward")
    readings = spark.createDataFrame([(k, s, t) for k, v in clips.items() for s, t in v.items()], "clip string, system string, text string")
    got = {(r["clip"], r["spelling"]): (r["variants"], r["systems"], r["times"], r["rank"]) for r in speech.vocabulary_candidates(speech.dissents(readings)).collect()}
    want = {}
    for clip, v in clips.items():
        found = defaultdict(Counter)
        first = {}
        for at, _, said, agreed in speech.dissent(v)[:60]:
            if len(agreed) >= 4 and agreed.isalpha() and said and SequenceMatcher(None, agreed, said).ratio() > 0.5:
                found[agreed][said] += 1
                first.setdefault(agreed, at)
        order = sorted(found, key=lambda w: (-sum(found[w].values()), first[w], w))[:40]
        want |= {(clip, w): (dict(found[w]), len(found[w]), sum(found[w].values()), n + 1) for n, w in enumerate(order)}
    assert got == want and sum(k[0] == "long" for k in want) == 30 and not any(w in speech.FILLER for _, w in want)


@pytest.mark.parametrize("least", [0.5, 0.7, 0.8, 0.95])
def test_similar_words_equal_all_pairs(spark, least):
    rng = random.Random(4)
    words = {"".join(rng.choices("abé", k=rng.randint(1, 11))) for _ in range(250)} | {"", "aaaaaaaaaa", "aaaaaaaaa"}

    def edits(a, b):
        before = list(range(len(b) + 1))
        for i, x in enumerate(a):
            now = [i + 1]
            for j, y in enumerate(b):
                now.append(min(before[j] + (x != y), before[j + 1] + 1, now[j] + 1))
            before = now
        return before[-1]

    got = {(r["a"], r["b"]): r["distance"] for r in similarity.edit_pairs(spark.createDataFrame([(w,) for w in [*words, None]], "word string"), least=least).collect()}
    names = sorted(w for w in words if w)
    want = {(a, b): d for k, a in enumerate(names) for b in names[k + 1 :] if (d := edits(a, b)) <= (1 - least) * max(len(a), len(b)) + 1e-9}
    assert got == want


# ---------------------------------------------------------------- merges

ENTITY = merging.Entity("things", "names", "thing_id")
KEYS = merging.Keys(
    foreign=(("things", "merged_into_id", "things"), ("things", "parent", "things"), ("names", "thing_id", "things"), ("uses", "thing", "things"), ("uses", "other", "things"), ("unlinked", "x", "elsewhere")),
    unique={"uses": (("thing", "note"),), "names": (("thing_id", "alias"),)},
)
THINGS = [(1, "One", None, None, None, None), (2, "Two", None, None, None, 1), (3, "Three", None, None, None, 2), (4, "TWO", None, None, None, None), (5, "Five", 4, "x", "y", None), (6, None, None, None, None, None)]
RULINGS = [(1, 2, 1, "me", "same"), (2, 3, 2, "me", None), (3, 3, 1, "me", None), (4, 9, 1, "me", None), (5, 5, 1, "me", None), (6, 4, 5, "me", None), (7, 4, 4, "me", None)]


def tables(spark):
    return {
        "things": spark.createDataFrame(THINGS, "id long, name string, merged_into_id long, merged_by string, merge_note string, parent long"),
        "names": spark.createDataFrame([(1, "two", "other"), (2, "Zwei", "other"), (1, "Zwei", "other"), (4, "vier", "other")], "thing_id long, alias string, alias_type string"),
        "uses": spark.createDataFrame([(2, 3, "a"), (1, 4, "a"), (2, 2, None), (2, 1, None), (4, 2, "b"), (5, 5, "c")], "thing long, other long, note string"),
        "unlinked": spark.createDataFrame([(2,)], "x long"),
    }


def test_merges_are_refused_with_a_reason(spark):
    got = {r["seq"]: r["fault"] for r in merging.merge_faults(tables(spark)["things"], spark.createDataFrame(RULINGS, "seq int, loser long, survivor long, merged_by string, merge_note string"), ENTITY).collect()}
    assert got == {2: "target", 3: "merged", 4: "missing", 5: "merged", 6: "target", 7: "self"}


def test_merge_sweeps_declared_keys_and_swaps_at_once(spark, tmp_path):
    store = Snapshots(spark, f"file://{tmp_path}/store")
    assert store.tables() == {}
    store.commit(tables(spark))
    # 3 goes into 2 first, then 2 into 1, so the rows of 3 end at 1
    rulings = spark.createDataFrame([(1, 3, 2, "me", None), (2, 2, 1, "me", "same"), (3, 4, 1, "you", None)], "seq int, loser long, survivor long, merged_by string, merge_note string")
    before = store.tables()
    assert merging.merge_faults(before["things"], rulings, ENTITY).count() == 0
    after, report = merging.merge(before, KEYS, ENTITY, rulings)
    assert set(after) == {"things", "names", "uses"}
    moved = {(r["table_name"], r["column_name"]): (r["moved"], r["dropped"]) for r in report.collect()}
    assert moved == {("names", "thing_id"): (1, 1), ("things", "parent"): (1, 0), ("uses", "other"): (4, 0), ("uses", "thing"): (2, 2)}
    places = store.places()
    bad = spark.range(3).selectExpr("raise_error('no') as x")
    with pytest.raises(Exception, match="no"):
        store.commit({"uses": after["uses"], "names": bad})
    assert store.places() == places and store.tables()["uses"].count() == 6
    store.commit(after)
    now = {k: sorted((tuple(r) for r in v.collect()), key=str) for k, v in store.tables().items()}
    assert now["unlinked"] == [(2,)]
    assert now["things"] == sorted([(1, "One", None, None, None, None), (2, "Two", 1, "me", "same", 1), (3, "Three", 2, "me", None, 1), (4, "TWO", 1, "you", None, None), (5, "Five", 4, "x", "y", None), (6, None, None, None, None, None)], key=str)
    # "Two" is there as "two" already; of the rows that come to one key one stays, the survivor's own first
    assert now["names"] == sorted([(1, "two", "other"), (1, "Zwei", "other"), (1, "vier", "other"), (1, "Three", "other")], key=str)
    assert len(now["uses"]) == 4 and {(r[0], r[2]) for r in now["uses"]} == {(1, "a"), (1, None), (1, "b"), (5, "c")}
    again, report = merging.merge(store.tables(), KEYS, ENTITY, rulings.where("false"))
    assert report.where("moved + dropped > 0").count() == 0 and again["names"].count() == len(now["names"])


def test_every_store_key_is_declared():
    from attesta.plans import merge_queries
    from attesta.plans.store import TABLES

    assert {t for t, *_ in merge_queries.KEYS.foreign} <= set(TABLES)
    declared = {(t, c) for t, c, _ in merge_queries.KEYS.foreign}
    assert all((t, "subject_id") in declared for t, sql in TABLES.items() if re.search(r"\bAS subject_id\b", sql) and t != "links")
