"""Sequential operators against direct loops, on random recordings."""

import random

import pytest

from attesta.operators import intervals, metrics, sequences, writes


def recordings(seed, n=120):
    r = random.Random(seed)
    out, at = [], 0
    for k in range(n):
        at += r.randint(-500, 4000)
        at = max(at, 0)
        out.append((k % 2, k, r.choice("AB"), at, at + r.randint(0, 3500)))
    return sorted(out, key=lambda x: (x[0], x[3], x[1]))


def merged(segments):
    turns = []
    for _, _, speaker, start, end in segments:
        if turns and turns[-1][0] == speaker and max(0, start - turns[-1][2]) <= 2000:
            turns[-1][2] = max(turns[-1][2], end)
        else:
            turns.append([speaker, start, end])
    return turns


def folded(turns):
    out, i = [], 0
    while i < len(turns):
        if i + 2 < len(turns) and turns[i + 1][0] != turns[i][0] == turns[i + 2][0] and turns[i + 1][2] - turns[i + 1][1] < 3000:
            out.append((turns[i][0], turns[i][1], turns[i + 2][2], 1))
            i += 3
        else:
            out.append((*turns[i], 0))
            i += 1
    return out


def test_coalesce_and_absorb(spark):
    for seed in range(3):
        rows = recordings(seed)
        df = spark.createDataFrame(rows, "media_id int, id int, speaker string, start_ms long, end_ms long")
        turns = sequences.coalesce_runs(df)
        absorbed = sequences.absorb_interjections(turns).collect()
        got = turns.collect()
        for media in (0, 1):
            want = merged([x for x in rows if x[0] == media])
            assert [(x.speaker, x.start_ms, x.end_ms) for x in sorted(got, key=lambda x: x.seq) if x.media_id == media] == [tuple(t) for t in want]
            assert [(x.speaker, x.start_ms, x.end_ms, x.interjections) for x in sorted(absorbed, key=lambda x: x.seq) if x.media_id == media] == folded(want)


def test_overlap_counts_each_pair_once(spark):
    r = random.Random(5)
    a = [(0, k, s, s + r.randint(1, 900)) for k in range(60) for s in [r.randint(-500, 3000)]]
    b = [(0, k, s, s + r.randint(1, 900)) for k in range(60) for s in [r.randint(-500, 3000)]]
    schema = "m int, id int, start_ms long, end_ms long"
    got = intervals.overlap_join(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), ["m"], 100).collect()
    want = sorted((x[1], y[1], min(x[3], y[3]) - max(x[2], y[2])) for x in a for y in b if min(x[3], y[3]) > max(x[2], y[2]))
    assert sorted((x.id, x.r_id, x.overlap) for x in got) == want


def test_diarization_error_against_grid(spark):
    r = random.Random(3)
    ref, hyp, at = [], [], 1000
    for k in range(12):
        end = at + r.randint(900, 3000)
        ref.append((0, k, r.choice("PQR"), at, end))
        hyp.append((0, k, r.choice("abc"), at + r.randint(-300, 300), end + r.randint(-300, 300)))
        at = end + r.randint(0, 800)
    schema = "media_id int, id int, speaker string, start_ms long, end_ms long"
    got = metrics.diarization_error(spark.createDataFrame(hyp, schema), spark.createDataFrame(ref, schema)).first()
    shared = {}
    for h in hyp:
        for x in ref:
            o = min(h[4], x[4]) - max(h[3], x[3])
            if o > 0:
                shared[h[2], x[2]] = shared.get((h[2], x[2]), 0) + o
    mapping = {}
    for (c, p), _ in sorted(shared.items(), key=lambda kv: (-kv[1], kv[0])):
        if c not in mapping and p not in mapping.values():
            mapping[c] = p
    bounds = [e for x in ref for e in (x[3], x[4])]
    total = confused = missed = false = 0
    for t in range(min(x[3] for x in ref), max(x[4] for x in ref)):
        if any(b - 250 <= t < b + 250 for b in bounds):
            continue
        true = next((x[2] for x in ref if x[3] <= t < x[4]), None)
        heard = next((h[2] for h in sorted(hyp, key=lambda h: (h[3], h[1])) if h[3] <= t < h[4]), None)
        total += true is not None
        confused += true is not None and heard is not None and mapping.get(heard) != true
        missed += true is not None and heard is None
        false += true is None and heard is not None
    assert (got.total_ms, got.confused_ms, got.missed_ms, got.false_ms) == (total, confused, missed, false)


def test_word_error():
    assert metrics.word_error("a b c d", "a x y c") == 3 / 4  # b replaced by two words, d left out
    assert metrics.word_error("um", "x") is None
    assert metrics.word_error("uh yes", "yes") == 0


def test_manifest_gate_fails_on_a_refused_row(spark):
    claims = spark.createDataFrame([(1, 5, "confirmed"), (2, None, "confirmed"), (3, 5, "proposed"), (4, 5, None)], "id long, subject_id long, curation_state string")
    rows = lambda *ids: spark.createDataFrame([(k, 9) for k in ids], "claim_id long, page_id long")
    assert sorted(r["claim_id"] for r in writes.refused_manifests(rows(1, 2, 3, 4), claims).collect()) == [2, 3]
    # rows that stand already are not looked at again; a null state raises nothing
    assert sorted(r["claim_id"] for r in writes.insert_manifests(rows(2), rows(1, 4), claims).collect()) == [1, 2, 4]
    for bad in (2, 3):
        with pytest.raises(Exception, match="curation_state"):
            writes.insert_manifests(rows(1), rows(bad), claims).collect()


def test_words_go_to_turns_interjections_and_near_edges(spark):
    turns = spark.createDataFrame([(1, "m", 0, 10_000), (2, "m", 14_000, 20_000), (3, "m", 14_000, 16_000)], "turn_id long, media string, start_ms long, end_ms long")
    cut = spark.createDataFrame([(1, 70, 4_000, 5_000), (1, 71, 4_500, 6_000)], "turn_id long, interjection long, start_ms long, end_ms long")
    at = {1: 0.0, 2: 4_700.0, 3: 5_500.0, 4: 10_000.0, 5: 11_900.0, 6: 12_000.5, 7: 13_000.0, 8: 15_000.0, 9: 17_000.0, 10: 18_500.0, 11: -1_999.0, 12: -2_001.0, 13: 12_000.0}
    points = spark.createDataFrame([(k, "m", v) for k, v in at.items()] + [(99, "other", 1.0)], "id long, media string, mid double")
    got = {r["id"]: (r["turn"], r["interjection"], r["basis"]) for r in intervals.assign_points(points, turns, ["media"], "mid", "turn_id", 2000, cut).collect()}
    assert got == {
        1: (1, None, "inside"), 2: (1, 70, "inside"), 3: (1, 71, "inside"), 4: (1, None, "inside"), 5: (1, None, "nearest"), 6: (2, None, "nearest"), 7: (2, None, "nearest"),
        8: (3, None, "inside"), 9: (3, None, "nearest"), 10: (None, None, None), 11: (1, None, "nearest"), 12: (None, None, None), 13: (1, None, "nearest"), 99: (None, None, None),
    }


def test_lineage_ends_on_loops(spark):
    from attesta.plans.dashboards import lineage

    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (5, 5)], "successor_body_id long, predecessor_body_id long")
    got = {(r["successor"], r["ancestor"]): r["depth"] for r in lineage(spark, edges).collect()}
    assert got[1, 4] == 3 and got[1, 3] == 2 and got[5, 5] == 1 and (2, 4) in got
