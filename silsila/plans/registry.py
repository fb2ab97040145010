"""Queries of the core and their SQL equivalents."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import flatten, hierarchy
from . import book_queries, core_queries, graph_queries, lineage_sql, person_queries  # noqa: F401 - these modules register with core_queries

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    **core_queries.QUERIES,
    "p4_found": flatten.p4_found,
    "p4_facts": flatten.p4_facts,
    "p4_record": flatten.p4_record,
    "p4_inner": flatten.p4_inner,
    "p4_tables": flatten.p4_tables,
    **flatten.LIST_QUERIES,
    "p6_found": hierarchy.p6_found,
    "p6_trees": hierarchy.p6_trees,
    "p6_descendants": hierarchy.p6_descendants,
}
SQL: dict[str, str] = {**core_queries.SQL, **lineage_sql.SQL, "fact_counts": lineage_sql.FACT_COUNTS}
