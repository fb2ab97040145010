"""Read access to the packed tables: what the web interface and the command line ask for."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import reports, search
from .operators.relational import one_hop
from .sources.io import exists

CAP_NODES = 28


class Catalog:
    """Tables ``persons, raw, postings, terms, edges, neighbours, citations, names, facts, chapters, spans, quality`` under one path; any may be missing."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    def has(self, name: str) -> bool:
        return exists(self.spark, f"{self.path}/{name}")

    def meta(self) -> DataFrame:
        """One row of counts: persons, women, letters, edges that are not by names of fathers, citations, chapters; 0 for a missing table."""
        out = self.table("persons").agg(F.count("*").alias("n_persons"), F.count_if("is_woman").alias("n_women"), F.count_distinct("letter").alias("n_letters"))
        for name in ("edges", "citations", "chapters"):
            count = self.table(name).agg(F.count("*").alias(f"n_{name}")) if self.has(name) else self.spark.range(1).select(F.lit(0).cast("long").alias(f"n_{name}"))
            out = out.crossJoin(count)  # one row each
        return out

    def search(self, **given: str) -> DataFrame:
        """A page of rows as they are shown, best match first; a frequent Latin spelling of a name stands for it."""
        found = search.search(self.table("persons"), search.Filters.parse({**given, "q": search.resolved_query(given.get("q", ""))}), self.table("postings"), self.table("terms"), ranked=True)
        return search.decorated(found)

    def letters(self) -> DataFrame:
        """Entries by letter, in the order of the alphabet; other values behind, by name."""
        order = F.create_map(*[x for i, w in enumerate(search.LETTER_ORDER) for x in (F.lit(w), F.lit(i))])
        rows = reports.distribution(self.table("persons"), F.col("letter"), "none", "letter")
        return rows.orderBy(F.asc_nulls_last(F.try_element_at(order, F.col("letter"))), "letter")

    def facets(self, kind: str, most: int = 80) -> DataFrame:
        """Values of a facet by number of postings; entries listed in error are left out, unknown parts kept."""
        kept = self.table("persons").where("qism is null or qism != 4").select("person_id")
        rows = self.table("postings").where(F.col("kind") == kind).join(kept, "person_id", "left_semi")
        return reports.top_groups(rows, ["value"], most)

    def chapters(self) -> DataFrame:
        return self.table("chapters").orderBy("id", "lvl", "ord")

    def chapter(self, ord_: int) -> DataFrame:
        return self.table("chapters").where(F.col("ord") == ord_)

    def quality(self) -> DataFrame:
        return self.table("quality")

    def person(self, person_id: str) -> DataFrame:
        return self.table("persons").where(F.col("person_id") == person_id)

    def by_number(self, number: int) -> DataFrame:
        """All entries with the printed number: more than one row asks the reader to choose."""
        return self.table("persons").where(F.col("entry_number") == number).orderBy("person_id")

    def text(self, person_id: str) -> DataFrame:
        return self.table("raw").where(F.col("person_id") == person_id).select("person_id", "text_body", "footnotes")

    def spans(self, person_id: str) -> DataFrame:
        return self.table("spans").where(F.col("person_id") == person_id).orderBy("start")

    def citations(self, person_id: str) -> DataFrame:
        return self.table("citations").where(F.col("person_id") == person_id)

    def facts(self, person_id: str) -> DataFrame:
        return self.table("facts").where(F.col("person_id") == person_id).orderBy("coll_path", "pos")

    def graph(self, person_id: str) -> DataFrame:
        pairs = self.table("neighbours").where((F.col("src") == person_id) | (F.col("dst") == person_id)).select("src", "dst")
        return one_hop(pairs, "person_id", CAP_NODES).where(F.col("person_id") == person_id)
