"""Queries of merges by declared keys: what may be merged, what moves, and the names that survive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.operators import merging
from attesta.plans.registry import query
from attesta.plans.store import Store

SUBJECT = merging.Entity("subjects", "subject_aliases", "subject_id")
ORG = merging.Entity("orgs", "org_aliases", "org_id")
#: Keys of the store's tables.
KEYS = merging.Keys(
    foreign=(
        ("asserted_events", "subject_id", "subjects"),
        ("claim_subject_mentions", "subject_id", "subjects"),
        ("claims", "subject_id", "subjects"),
        ("document_mentions", "subject_id", "subjects"),
        ("document_sections", "subject_id", "subjects"),
        ("fiscal_references", "subject_id", "subjects"),
        ("org_subjects", "subject_id", "subjects"),
        ("quantities", "subject_id", "subjects"),
        ("source_search_log", "subject_id", "subjects"),
        ("subject_aliases", "subject_id", "subjects"),
        ("subjects", "merged_into_id", "subjects"),
        ("subjects", "parent_subject_id", "subjects"),
        ("affiliations", "org_id", "orgs"),
        ("claims", "org_id", "orgs"),
        ("fiscal_references", "awarding_org_id", "orgs"),
        ("funded", "awarding_org_id", "orgs"),
        ("org_aliases", "org_id", "orgs"),
        ("org_subjects", "org_id", "orgs"),
        ("orgs", "merged_into_id", "orgs"),
    ),
    unique={
        "affiliations": (("person_id", "org_id"),),
        "claim_subject_mentions": (("claim_id", "subject_id", "span_start", "span_end"),),
        "org_aliases": (("org_id", "alias"),),
        "source_search_log": (("subject_id", "doc_type"),),
        "subject_aliases": (("subject_id", "alias"),),
    },
)

#: Ruled merges: some go on from a survivor that is merged later, some are refused.
RULINGS = """
SELECT CASE WHEN p_partkey % 10 = 3 THEN p_partkey + 1000000000 ELSE p_partkey END AS seq, p_partkey AS loser,
       CASE p_partkey % 10 WHEN 3 THEN p_partkey - 1 WHEN 4 THEN p_partkey - 2 WHEN 5 THEN p_partkey - 2 WHEN 7 THEN p_partkey WHEN 8 THEN p_partkey + 100000000 ELSE p_partkey - 1 END AS survivor,
       'reviewer' AS merged_by, p_comment AS merge_note
FROM (SELECT DISTINCT p_partkey, concat('ruled on ', p_partkey) AS p_comment FROM {part} WHERE p_partkey % 10 IN (3, 4, 5, 6) OR p_partkey % 70 IN (7, 8))"""

_FAULTS = f"""
  r AS ({RULINGS.format(part='part')}), s AS (SELECT id, any_value(merged_into_id) AS m FROM s_subjects GROUP BY id),
  f AS (SELECT r.*, CASE WHEN r.loser = r.survivor THEN 'self' WHEN a.id IS NULL OR b.id IS NULL THEN 'missing' WHEN a.m IS NOT NULL OR EXISTS (SELECT 1 FROM r x WHERE x.loser = r.loser AND x.seq < r.seq) THEN 'merged'
               WHEN b.m IS NOT NULL OR EXISTS (SELECT 1 FROM r x WHERE x.loser = r.survivor AND x.seq < r.seq) THEN 'target' END AS fault FROM r LEFT JOIN s a ON a.id = r.loser LEFT JOIN s b ON b.id = r.survivor),
  ok AS (SELECT * FROM f WHERE fault IS NULL)"""
_PATHS = f"{_FAULTS}, w AS (SELECT loser, survivor, 1 AS step FROM ok UNION ALL SELECT w.loser, ok.survivor, w.step + 1 FROM w JOIN ok ON ok.loser = w.survivor), m AS (SELECT loser, arg_max(survivor, step) AS survivor FROM w GROUP BY loser)"


def _rulings(s: Store) -> DataFrame:
    return s.spark.sql(RULINGS, part=s.raw("part"))


def _merged(s: Store) -> tuple[dict[str, DataFrame], DataFrame]:
    faults = merging.merge_faults(s.subjects, _rulings(s), SUBJECT)
    good = _rulings(s).join(faults, ["seq", "loser"], "left_anti")
    tables = {t: getattr(s, t) for t in {t for t, *_ in KEYS.foreign} | {SUBJECT.table, SUBJECT.aliases}}
    return merging.merge(tables, KEYS, SUBJECT, good)


@query(f"WITH {_FAULTS} SELECT seq, loser, survivor, fault FROM f WHERE fault IS NOT NULL")
def merge_faults(s: Store) -> DataFrame:
    """Ruled merges that are refused."""
    return merging.merge_faults(s.subjects, _rulings(s), SUBJECT)


def _report_sql(table: str, column: str) -> str:
    unique = [k for k in KEYS.unique.get(table, ()) if column in k]
    moved = f"SELECT t.*, m.survivor AS new_key FROM s_{table} t JOIN m ON m.loser = t.{column}"
    if not unique:
        return f"SELECT '{table}' AS table_name, '{column}' AS column_name, count(*) AS moved, 0::BIGINT AS dropped FROM ({moved})"
    rest = [c for c in unique[0] if c != column]
    same = " AND ".join(f"x.{c} IS NOT DISTINCT FROM y.{c}" for c in rest)
    keys = ", ".join(rest)
    left = f"SELECT count(*) FROM (SELECT DISTINCT new_key, {keys} FROM ({moved}) y WHERE NOT EXISTS (SELECT 1 FROM s_{table} x WHERE x.{column} = y.new_key AND {same}))"
    return f"SELECT '{table}', '{column}', ({left}), (SELECT count(*) FROM ({moved})) - ({left})"


@query(f"WITH RECURSIVE {_PATHS} " + " UNION ALL ".join(_report_sql(t, c) for t, c in KEYS.to("subjects")))
def merge_report(s: Store) -> DataFrame:
    """Rows that the merge moves and drops, for every declared key."""
    return _merged(s)[1]


@query(f"""
WITH RECURSIVE {_PATHS},
  k AS (SELECT DISTINCT coalesce(m.survivor, a.subject_id) AS subject_id, a.alias FROM s_subject_aliases a LEFT JOIN m ON m.loser = a.subject_id),
  n AS (SELECT m.survivor AS subject_id, arg_min(p.name, ok.seq) AS alias FROM m JOIN ok ON ok.loser = m.loser JOIN (SELECT id, any_value(name) AS name FROM s_subjects GROUP BY id) p ON p.id = m.loser GROUP BY m.survivor, lower(p.name))
SELECT * FROM k UNION ALL SELECT * FROM n WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.subject_id = n.subject_id AND lower(k.alias) = lower(n.alias))""")
def merged_aliases(s: Store) -> DataFrame:
    """Names of all subjects once the merge is made; a loser's name is its survivor's, once."""
    return _merged(s)[0]["subject_aliases"].select("subject_id", "alias")


@query(f"WITH RECURSIVE {_PATHS} SELECT p.id, coalesce(x.survivor, p.parent_subject_id) AS parent_subject_id, coalesce(ok.survivor, p.merged_into_id) AS merged_into_id FROM s_subjects p LEFT JOIN m x ON x.loser = p.parent_subject_id LEFT JOIN ok ON ok.loser = p.id")
def merged_subjects(s: Store) -> DataFrame:
    """Subjects once the merge is made: parents repointed, losers marked with the survivor that was ruled."""
    return _merged(s)[0]["subjects"].select("id", "parent_subject_id", "merged_into_id")
