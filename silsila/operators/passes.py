"""Passes over facts with an outside provider: selection, calls in batches, guarded application, timelines.

A provider is any callable from a list of requests to a list of replies; none is called unless it is given. Calls run
inside ``mapInPandas``, so the number of partitions is the number of calls at a time.
"""
from __future__ import annotations

import random
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import chunks, evidence_status
from ..session import materialize
from .biography import merged_chunks
from .relational import running_until, top_k_per_key

# --- fixed values -----------------------------------------------------------------------------------
ITEMS = 16
#: Fields of an extraction reply that are lists.
REPLY_LISTS = (
    "alternate_names", "name_dispute_notes", "conversion", "companionship", "battles", "offices", "family", "residences", "traits", "cited_authorities", "cross_references",
)
FIXED_TOKENS = 1200
THIN = ("name_only", "kunya_redirect")
LONGEST_QUOTE = 12
ISNAD = r"ثنا |أخبرنا |حدثنا |أنبأنا |عن [^.\n]{2,40} عن "
VERDICT = "لا يصح|لا يثبت|ليست له صحبة|ضعيف|مجهول|وهم "
# ----------------------------------------------------------------------------------------------------

Provider = Callable[[list[str]], list[str]]


@dataclass(frozen=True)
class Pass:
    """A named selection of items of a ``facts`` table joined with the text ``body``."""

    name: str
    select: Callable[[DataFrame], DataFrame]
    most: int = ITEMS
    #: Fields of each item of a reply, as a schema.
    reply: str = "field string, idx int, value string"

    def items(self, facts: DataFrame, key: str = "person_id") -> DataFrame:
        return top_k_per_key(self.select(facts), [key], [F.col("field"), F.col("idx")], self.most, "item_no")


    def requests(self, facts: DataFrame, instruction: str = "", key: str = "person_id") -> DataFrame:
        """``request_key, key, pass_name, prompt``: one request for the items of each key, as JSON behind the instruction."""
        rows = self.items(facts, key)
        listed = rows.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("item_no", "field", "idx", "value"))).alias("items"))
        prompt = F.concat(F.lit(instruction), F.to_json(F.transform("items", lambda i: F.struct(i["field"].alias("field"), i["idx"].alias("idx"), i["value"].alias("value")))))
        out = listed.select(key, F.lit(self.name).alias("pass_name"), prompt.alias("prompt"))
        return out.withColumn("request_key", request_key("pass_name", "prompt"))

    def records(self, requests: DataFrame, log: DataFrame, key: str = "person_id") -> DataFrame:
        """The items of the good replies, by key; a reply that is no list of objects of the pass's fields gives none."""
        parsed = F.from_json(strip_fences("reply"), f"array<struct<{self.reply.replace(' ', ': ').replace(',: ', ', ')}>>")
        good = requests.join(log.where("error is null").select("request_key", "reply"), "request_key").select(key, F.explode(parsed).alias("r"))
        return good.select(key, "r.*")


REPAIR = Pass("repair", lambda f: f.where((F.col("source") == "llm") & (evidence_status("body", "evidence") == "unverified")))
KINDS = Pass("kinds", lambda f: f.where(
    (F.col("field").isin("narration.praise", "narration.criticism", "narration.defenses") & (F.coalesce("kind", F.lit("other")) == "other"))
    | ((F.col("field") == "life.events") & (F.coalesce("kind", F.lit("incident")) == "incident"))
))
SPANS = Pass("spans", lambda f: f.where((F.col("field") == "span") & (F.col("kind") == "unlabeled") & (F.length("value") >= LONGEST_QUOTE) & ~F.col("entry_kind").isin(*THIN)))
VERDICTS = Pass("verdicts", lambda f: f.where((F.col("qism") == 4) | (F.col("field") == "narration.criticism") | F.regexp_like(F.coalesce("body", F.lit("")), F.lit(VERDICT))), 1, "idx int, verdict_key string")
ISNADS = Pass("isnads", lambda f: f.where((F.col("field") == "span") & F.regexp_like("value", F.lit(ISNAD))), 8, "idx int, links array<string>")
COUNTS = Pass("hadith", lambda f: f.where((F.col("field") == "narration.hadith_count") & F.col("key").isNull()))
ALL = (REPAIR, KINDS, SPANS, VERDICTS, ISNADS, COUNTS)


def request_key(*columns: str) -> Column:
    """Content address of a request: equal requests are answered once and kept."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def strip_fences(reply: Column | str) -> Column:
    """A reply without the code fence around it."""
    bare = F.btrim(F.coalesce(F.col(reply) if isinstance(reply, str) else reply, F.lit("")), F.lit(" \t\r\n"))
    inner = F.regexp_extract(bare, r"(?s)^```(?:json)?\s*(.*?)\s*```$", 1)
    return F.when(F.regexp_like(bare, F.lit(r"(?s)^```(?:json)?\s*.*```$")), inner).otherwise(bare)


def reply_problem(reply: Column | str) -> Column:
    """What is wrong with the shape of an extraction reply (JSON text): null if nothing is."""
    value = F.try_parse_json(strip_fences(reply))

    def kind(path: str) -> Column:
        return F.schema_of_variant(F.try_variant_get(value, path, "variant"))

    def given(path: str) -> Column:
        return kind(path).isNotNull() & (kind(path) != "VOID")

    checks = [(value.isNull() | ~F.startswith(F.schema_of_variant(value), F.lit("OBJECT")), "Response was not a JSON object.")]
    checks += [(given(f"$.{f}") & ~F.startswith(kind(f"$.{f}"), F.lit("ARRAY")), f'Field "{f}" must be an array.') for f in REPLY_LISTS]
    checks.append((given("$.narration") & ~F.regexp_like(kind("$.narration"), F.lit("^(OBJECT|ARRAY)")), 'Field "narration" must be an object.'))
    for f in ("birth", "death"):
        checks.append((given(f"$.{f}") & ~F.regexp_like(kind(f"$.{f}"), F.lit("^(OBJECT|ARRAY)")), f'Field "{f}" must be an object.'))
        year = kind(f"$.{f}.year_hijri")
        checks.append((given(f"$.{f}.year_hijri") & (year != "BIGINT"), f'Field "{f}.year_hijri" must be an integer Hijri year or null.'))
    return F.coalesce(*[F.when(F.coalesce(wrong, F.lit(False)), F.lit(text)) for wrong, text in checks])


def parse_duration(value: object) -> float | None:
    """Milliseconds of ``500ms``, ``2s``, ``1m30s`` or a bare number of seconds; null for anything else."""
    text = str(value if value is not None else "").strip()
    if re.fullmatch(r"[0-9]+(\.[0-9]+)?", text):
        return float(text) * 1000
    parts = re.findall(r"([0-9]+(?:\.[0-9]+)?)(ms|s|m|h)", text)
    return sum(float(n) * {"ms": 1, "s": 1000, "m": 60_000, "h": 3_600_000}[unit] for n, unit in parts) if parts else None


def retry_delay(headers: dict[str, str], attempt: int, jitter: float = 0.0) -> float:
    """Milliseconds to wait after a refused call: what the provider tells, else twice as long each time; at most 90 seconds."""
    told = parse_duration(headers.get("retry-after-ms"))
    if told is None:
        resets = [parse_duration(headers.get(f"x-ratelimit-reset-{x}")) or 0 for x in ("tokens", "requests")]
        told = parse_duration(headers.get("retry-after")) or max(resets) or None
    base = told if told is not None else min(60_000, 1000 * 2**attempt)
    return min(90_000, base + 750) + jitter


def missing(requests: DataFrame, cache: DataFrame) -> DataFrame:
    return requests.join(cache.select("request_key").distinct(), "request_key", "left_anti")


def estimated(df: DataFrame, size: str, chunk: int = 9000) -> DataFrame:
    """``requests`` and ``tokens`` of asking about texts of ``size`` characters: three to a token, and a fixed part a request."""
    requests = F.greatest(F.lit(1), F.ceil(F.col(size) / chunk)).cast("long")
    return df.withColumn("requests", requests).withColumn("tokens", (F.floor(F.col(size) / 3) + FIXED_TOKENS * F.col("requests")).cast("long"))


def within_budget(requests: DataFrame, cost: str, cap: int, order: list[str], bucket: Column) -> DataFrame:
    """Requests in order until their cost reaches the cap."""
    return running_until(requests, order, cost, cap, bucket)


class Refused(Exception):
    """Raised by a provider whose service asks to wait; ``headers`` tell how long."""

    def __init__(self, message: str, headers: dict[str, str] | None = None):
        super().__init__(message)
        self.headers = headers or {}


class Fatal(Exception):
    """Raised by a provider where trying again is of no use."""


def answered(requests: DataFrame, provider: Provider | None, at_a_time: int = 8, tries: int = 6) -> DataFrame:
    """``request_key, reply, error``; without a provider nothing is asked.

    A refused batch (``Refused``) waits as told, any other failed one is tried again at once, ``Fatal`` ones are not; what fails
    in the end is logged as an error.
    """
    if provider is None:
        return requests.sparkSession.createDataFrame([], "request_key string, reply string, error string")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            error: str | None = None
            replies: list[str | None] = [None] * len(frame)
            for attempt in range(tries):
                try:
                    replies, error = list(provider(frame["prompt"].tolist())), None
                    break
                except Fatal as e:
                    error = str(e)[:300]
                    break
                except Refused as e:
                    error = str(e)[:300]
                    if attempt + 1 < tries:
                        time.sleep(retry_delay(e.headers, attempt, random.random() * 500) / 1000)
                except Exception as e:  # noqa: BLE001 - a provider may raise anything; the row keeps it
                    error = str(e)[:300]
            yield pd.DataFrame({"request_key": frame["request_key"], "reply": replies, "error": error})

    return requests.select("request_key", "prompt").repartition(at_a_time, "request_key").mapInPandas(run, "request_key string, reply string, error string")


def repaired(facts: DataFrame, patches: DataFrame, key: str = "person_id") -> DataFrame:
    """Evidence patched where field, place and value agree: null clears (0.7), a quote that the body holds counts 0.9, others are ignored."""
    p = patches.select(key, "field", "idx", F.col("value").alias("p_value"), F.col("new_evidence"), F.lit(True).alias("__patched"))
    rows = facts.join(p, [key, "field", "idx"], "left")
    hit = F.coalesce("__patched", F.lit(False)) & (F.col("p_value") == F.col("value"))
    verified = evidence_status("body", "new_evidence") == "verified"
    clear, set_ = hit & F.col("new_evidence").isNull(), hit & verified
    return rows.withColumns({
        "evidence": F.when(clear, F.lit(None).cast("string")).when(set_, F.col("new_evidence")).otherwise(F.col("evidence")),
        "confidence": F.when(clear, 0.7).when(set_, 0.9).otherwise(F.col("confidence")),
    }).drop("p_value", "new_evidence", "__patched")


def with_kinds(facts: DataFrame, patches: DataFrame, key: str = "person_id") -> DataFrame:
    """Kinds assigned by place and value; ``other`` on an event is an incident."""
    p = patches.select(key, "field", "idx", F.col("value").alias("p_value"), "new_kind")
    rows = facts.join(p, [key, "field", "idx"], "left")
    kind = F.when((F.col("field") == "life.events") & (F.col("new_kind") == "other"), "incident").otherwise(F.col("new_kind"))
    return rows.withColumn("kind", F.when(F.col("p_value") == F.col("value"), kind).otherwise(F.col("kind"))).drop("p_value", "new_kind")


def relabelled(spans: DataFrame, replies: DataFrame, key: str = "person_id") -> DataFrame:
    """Labels set on spans with the same place that are still unlabeled."""
    p = replies.select(key, "start", "end", F.col("label").alias("new_label"), F.col("confidence").alias("new_confidence"))
    rows = spans.join(p, [key, "start", "end"], "left")
    open_ = (F.col("label") == "unlabeled") & F.col("new_label").isNotNull()
    return rows.withColumns({
        "label": F.when(open_, F.col("new_label")).otherwise(F.col("label")), "confidence": F.when(open_, F.col("new_confidence")).otherwise(F.col("confidence")),
    }).drop("new_label", "new_confidence")


def with_hadith_counts(persons: DataFrame, replies: DataFrame, key: str = "person_id") -> DataFrame:
    """``persons(key, value, count, uncertain, evidence, source, confidence)`` of counted traditions, where the reply has a count.

    Persons without one of their own are left as they are; a reply's evidence makes it more certain (0.9, else 0.7).
    """
    r = replies.where("count is not null").select(key, F.col("count").alias("r_count"), F.coalesce("uncertain", F.lit(False)).alias("r_uncertain"), F.col("evidence").alias("r_evidence"))
    rows = persons.join(r, key, "left")
    hit = F.col("r_count").isNotNull() & F.col("value").isNotNull()
    return rows.withColumns({
        "count": F.when(hit, F.col("r_count")).otherwise(F.col("count")), "uncertain": F.when(hit, F.col("r_uncertain")).otherwise(F.col("uncertain")),
        "evidence": F.when(hit, F.coalesce("r_evidence", "evidence")).otherwise(F.col("evidence")), "source": F.when(hit, "llm").otherwise(F.col("source")),
        "confidence": F.when(hit, F.when(F.col("r_evidence").isNotNull(), 0.9).otherwise(0.7)).otherwise(F.col("confidence")),
    }).drop("r_count", "r_uncertain", "r_evidence")


def with_verdicts(persons: DataFrame, replies: DataFrame, key: str = "person_id") -> DataFrame:
    """``persons(key, verdict_keys)`` with the keys of ``replies(key, idx, verdict_key)`` behind their own, each once."""
    found = replies.where("verdict_key is not null").groupBy(key).agg(F.sort_array(F.collect_list(F.struct("idx", "verdict_key"))).alias("__v"))
    own = F.coalesce("verdict_keys", F.array().cast("array<string>"))
    new = F.coalesce(F.transform("__v", lambda v: v["verdict_key"]), F.array().cast("array<string>"))
    return persons.join(found, key, "left").withColumn("verdict_keys", F.array_distinct(F.concat(own, new))).drop("__v")


def isnad_rows(replies: DataFrame, key: str = "person_id") -> DataFrame:
    """``key, isnad_no, link_no, name`` of the chains of transmission in ``replies(key, idx, links array<string>)``; empty names are left out."""
    rows = replies.select(key, F.col("idx").alias("isnad_no"), F.posexplode("links").alias("link_no", "name"))
    return rows.withColumn("name", F.btrim("name")).where("name != ''")


def pass_counters(before: DataFrame, after: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """``column_name, changed``: how many rows a pass has changed in each column."""
    b = before.select(*keys, *[F.col(c).alias(f"__b_{c}") for c in columns])
    both = after.join(b, keys)
    counts = both.agg(*[F.count_if(~F.col(c).eqNullSafe(F.col(f"__b_{c}"))).alias(c) for c in columns])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("changed")) for c in columns])).alias("r")).select("r.*")


def timelines(items: DataFrame, years: DataFrame, key: str = "person_id") -> DataFrame:
    """``items(key, kind, vocab_key, year, ord)`` as one list a person: birth, battles, events, death; the vocabulary's year
    stands in for a missing one; by year with unknown ones last, else in order. Persons without items have none."""
    rows = items.join(years.select("vocab_key", F.col("year").alias("v_year")), "vocab_key", "left")
    rows = rows.withColumn("year", F.coalesce("year", "v_year")).where(~F.col("kind").isin("birth", "death") | F.col("year").isNotNull())
    entry = F.struct(F.col("year").isNull().alias("last"), "year", "ord", "kind", "vocab_key")
    out = rows.groupBy(key).agg(F.sort_array(F.collect_list(entry)).alias("t"))
    return out.select(key, F.transform("t", lambda e: F.struct(e["year"].alias("year"), e["kind"].alias("kind"), e["vocab_key"].alias("key"))).alias("timeline"))


LOG = "request_key string, reply string, error string"


def run_passes(
    facts: DataFrame, passes: list[Pass], provider: Provider | None, log: DataFrame | None = None, cap: int | None = None, key: str = "person_id", at_a_time: int = 8
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Records of each pass by its name, and the log of all answers, those of ``log`` before included.

    Requests that the log holds are not asked again. ``cap`` bounds the tokens of all passes together: the requests of the
    first passes go first, and those of one pass in a fixed order. Each pass's answers are written before the next one asks.
    """
    spark = facts.sparkSession
    log = spark.createDataFrame([], LOG) if log is None else log.select("request_key", "reply", "error")
    records: dict[str, DataFrame] = {}
    spent = 0
    for p in passes:
        asked = materialize(estimated(p.requests(facts, key=key).withColumn("__size", F.length("prompt")), "__size"))
        open_ = missing(asked, log.where("error is null"))
        if cap is not None:
            # any fixed order will do; this one is many buckets
            open_ = open_.withColumn("__bucket", F.pmod(F.xxhash64(key), F.lit(4096)))
            open_ = within_budget(open_, "tokens", cap - spent, ["__bucket", key], F.col("__bucket")) if cap > spent else open_.limit(0)
        new = materialize(answered(open_, provider, at_a_time))
        spent += open_.join(new.select("request_key"), "request_key", "left_semi").agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n")).first()["n"]
        log = log.unionByName(new)
        records[p.name] = p.records(asked, log, key)
    return records, log


def extracted(texts: DataFrame, provider: Provider | None, fields: dict[str, str], text: str = "text_body", key: str = "person_id", at_a_time: int = 8) -> DataFrame:
    """``key, problem`` and the ``fields`` (name: SQL type; scalars, flags or lists of strings) that the provider reads from each text.

    Long texts are asked for chunk by chunk, and the replies merged in order: the first scalar that is known, any flag, lists
    without repeats. ``problem`` is the first reply's that has not the shape of an extraction.
    """
    rows = texts.select(key, F.posexplode(chunks(text, most=None)).alias("chunk_no", "prompt"))
    rows = materialize(rows.withColumn("request_key", request_key("prompt")))
    log = materialize(answered(rows.select("request_key", "prompt").dropDuplicates(["request_key"]), provider, at_a_time))
    schema = ", ".join(f"{n} {t}" for n, t in fields.items())
    both = rows.join(log, "request_key").withColumn("problem", F.coalesce("error", reply_problem("reply")))
    read = both.withColumn("r", F.when(F.col("problem").isNull(), F.from_json(strip_fences("reply"), schema))).select(key, "chunk_no", "problem", "r.*")
    kinds = {n: t.strip().lower() for n, t in fields.items()}
    lists, flags = [n for n, t in kinds.items() if t.startswith("array")], [n for n, t in kinds.items() if t == "boolean"]
    return merged_chunks(read, key, "chunk_no", ["problem", *(n for n in fields if n not in lists and n not in flags)], flags, lists)
