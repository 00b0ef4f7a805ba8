"""Collects the query modules."""
from __future__ import annotations

from sitewright.plans import registry
from sitewright.plans import q_annotations, q_catalogue, q_depth, q_edits, q_evidence, q_functions, q_junctions, q_reads, q_reports, q_sites  # noqa: F401


def queries():
    return dict(registry.QUERIES)


def oracle_sql():
    return registry.oracle_texts()
