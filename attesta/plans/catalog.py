"""Imports every module that registers queries."""

from attesta.plans import conversion_queries, curation_queries, dashboards, document_queries, evidence_queries, joins, merge_queries, page_queries, review_queries, rule_queries, sequence_queries, views, write_queries  # noqa: F401
