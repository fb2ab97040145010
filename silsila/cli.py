"""Command line: ``python -m silsila.cli VERB [--flag value]``."""
from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from .catalog import Catalog
from .operators import graph, labels, reports, search
from .operators.current import current_rows
from .operators.flatten import PERSON_LISTS, flatten_lists, pivot_fields
from .operators.persons import name_forms, samples
from .plans.graph_queries import index_of
from .session import get_session, materialize
from .sources import io
from .sources.validate import PERSON_RULES, violations


#: Lists of the nested records whose keys can be searched for.
POSTINGS = {"life.battles": "battle", "life.events": "event", "life.residences": "place", "labels": "label"}
SAMPLES = [10680, 4852, 7610]


def build(spark, source: str, target: str, limit: int = 0) -> None:
    """Packs the served tables from the persons, raw, nasab and citations tables of a folder; ``limit`` takes the first entries only."""
    persons = current_rows(spark.read.parquet(f"{source}/persons.parquet"), "person_id")
    if limit:
        persons = persons.orderBy("person_id").limit(limit)
    raw = current_rows(spark.read.parquet(f"{source}/raw.parquet"), "person_id").join(persons.select("person_id"), "person_id", "left_semi")
    cited = spark.read.parquet(f"{source}/citations.parquet").distinct().join(persons.select("person_id"), "person_id", "left_semi")
    joined = persons.join(raw.select("person_id", "text_body"), "person_id", "left")
    terms = search.index(joined, "person_id", {"display_name": "display_name", "full_name": "full_name", "name_keys": "full_name_norm", "text_body": "text_body"})
    facts = pivot_fields(flatten_lists(persons, "person_json", PERSON_LISTS), ["value", "key", "kind", "relation", "source", "evidence", "confidence"])
    postings = persons.select("person_id", F.lit("nisba").alias("kind"), F.explode("nisba").alias("value")).unionByName(
        cited.where("authority_key is not null").select("person_id", F.lit("authority").alias("kind"), F.col("authority_key").alias("value"))
    )
    for path, kind in POSTINGS.items():
        postings = postings.unionByName(facts.where((F.col("coll_path") == path) & F.col("key").isNotNull()).select("person_id", F.lit(kind).alias("kind"), F.col("key").alias("value")))
    index = index_of(spark, source).join(persons.select("person_id"), "person_id", "left_semi")
    keys = materialize(graph.name_keys(index))
    fathers = materialize(graph.genealogy(index, keys))
    references = graph.reference_edges(graph.text_references(raw, "text_body", "person_id", None), index, keys, fathers)
    edges = materialize(graph.all_edges(references, graph.fact_edges(facts, index, keys)))
    quality = reports.fill_rates(persons, {c: F.col(c).isNotNull() for c in ("full_name", "kunya", "death_year_hijri", "qism", "letter")})
    spans = labels.passages(raw, "text_body", "person_id")
    io.pack({
        "persons": persons.drop("person_json"), "raw": raw, "terms": terms, "postings": postings.dropDuplicates(), "edges": edges, "neighbours": graph.neighbour_pairs(edges, fathers), "citations": cited,
        "names": name_forms(persons, facts), "facts": facts, "quality": quality, "spans": spans,
    }, target)
    for name in ("chapters", "chapter_texts"):
        if io.exists(spark, f"{source}/{name}.parquet"):
            spark.read.parquet(f"{source}/{name}.parquet").write.mode("overwrite").parquet(f"{target}/{name}")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="silsila")
    parser.add_argument("verb", choices=["build", "validate", "stats", "get", "search", "letters", "facets", "text", "spans", "gate", "chapters", "graph", "samples"])
    parser.add_argument("--source", default=".")
    parser.add_argument("--target", default="packed")
    parser.add_argument("--q", default="")
    parser.add_argument("--limit", default="40")
    parser.add_argument("--offset", default="0")
    parser.add_argument("--id", default="")
    parser.add_argument("--kind", default="nisba")
    parser.add_argument("--entries", type=int, default=0, help="build from the first entries only")
    parser.add_argument("--master", default="local[*]")
    a = parser.parse_args(argv)
    spark = get_session(a.master)
    catalog = Catalog(spark, a.target)
    if a.verb == "build":
        build(spark, a.source, a.target, a.entries)
        return
    answers = {
        "validate": lambda: reports.first_errors(violations(catalog.table("persons"), PERSON_RULES, "person_id"), "rule", ["person_id"]),
        "stats": catalog.meta, "gate": catalog.quality, "letters": catalog.letters, "facets": lambda: catalog.facets(a.kind),
        "get": lambda: catalog.by_number(int(a.id)) if a.id.isdigit() else catalog.person(a.id), "text": lambda: catalog.text(a.id), "spans": lambda: catalog.spans(a.id),
        "search": lambda: catalog.search(q=a.q, limit=a.limit, offset=a.offset), "chapters": catalog.chapters, "graph": lambda: catalog.graph(a.id),
        "samples": lambda: samples(catalog.table("persons"), SAMPLES),
    }
    for row in answers[a.verb]().toJSON().toLocalIterator():
        print(row)


if __name__ == "__main__":
    main()
