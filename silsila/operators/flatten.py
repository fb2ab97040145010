"""Nested JSON records as flat tables that keep parent-child links, one for each list at any depth.

Each record is read once, as a stream: the events of its text become path-value-ordinal triples, a triple goes to the
row of its nearest repeated ancestor (an item of a list), and the rows of one repeated ancestor are a table, whose
columns are pivoted from the triples. Nothing is nested on a call stack, so depth is not bounded by it.

A row has the path of its list, the positions from the outermost list down to its own (those before the last are the
parent's row), and its fields: paths and values of the scalars it holds outside of inner lists. Values are texts, numbers
as they are written.

Every array is a list. A list that is declared may also be stored as text that holds it, as an object keyed by
position, or as one object alone (position 0); whatever holds it may be stored as text, too. Defined cases: a null in
a list takes its position but gives no row; of two equal keys of an object the last counts; a record that is null or
not valid JSON (a number that is not finite included) gives none; an object without fields is a row without fields.
"""
from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from json.decoder import scanstring

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .current import latest


class NotJson(ValueError):
    pass


OBJECT, ARRAY, END, TEXT, OTHER = range(5)
_BLANK, _SIMPLE = r"[ \t\n\r]*", r'"([^"\\\x00-\x1f]*)"'
_VALUE = rf"{_BLANK}(?:{_SIMPLE}|(-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?|true|false|null)|([{{\[])|(\"))"
_ITEM = re.compile("()" + _VALUE).match
_MEMBER = re.compile(f"{_BLANK}{_SIMPLE}{_BLANK}:{_VALUE}").match
_QUOTE, _COLON, _AFTER = (re.compile(_BLANK + x).match for x in ('"', ":", r"([,}\]]|\Z)"))

#: Kind, key (of a member of an object), text (null for a null, an object, an array and an end).
Event = tuple[int, "str | None", "str | None"]


def events(text: str) -> Iterator[Event]:
    """The events of a JSON text in their order; raises ``ValueError`` where it stops being one."""
    open_: list[int] = []
    at, in_object = 0, False
    while True:
        m = (_MEMBER if in_object else _ITEM)(text, at)
        key = None
        if m is not None:
            at, kind = m.end(), m.lastindex
            if in_object:
                key = m[1]
        elif in_object and (m := _QUOTE(text, at)) is not None:  # a key with escapes
            key, at = scanstring(text, m.end(), True)
            m = _COLON(text, at)
            m = m and _ITEM(text, m.end())
            if m is None:
                raise NotJson(f"no value at {at}")
            at, kind = m.end(), m.lastindex
        else:
            raise NotJson(f"no value at {at}")
        if kind == 2:
            yield TEXT, key, m[2]
        elif kind == 3:
            yield OTHER, key, None if m[3] == "null" else m[3]
        elif kind == 5:  # a text with escapes
            value, at = scanstring(text, at, True)
            yield TEXT, key, value
        else:
            opened = OBJECT if m[4] == "{" else ARRAY
            yield opened, key, None
            m = _AFTER(text, at)
            if m is None or m[1] != ("}" if opened == OBJECT else "]"):
                open_.append(opened)
                in_object = opened == OBJECT
                continue
            at = m.end()
            yield END, None, None
        while True:
            m = _AFTER(text, at)
            if m is None:
                raise NotJson(f"no end at {at}")
            at, mark = m.end(), m[1]
            if not open_:
                if mark or at < len(text):
                    raise NotJson(f"more text at {at}")
                return
            if mark == ",":
                break
            if mark != ("}" if in_object else "]"):
                raise NotJson(f"no end at {at}")
            open_.pop()
            in_object = bool(open_) and open_[-1] == OBJECT
            yield END, None, None


class Row:
    """An item of a list: the list's path, the positions down to it, its fields."""

    __slots__ = ("path", "at", "is_object", "fields")

    def __init__(self, path: str, at: tuple[int, ...], is_object: bool):
        self.path, self.at, self.is_object = path, at, is_object
        self.fields: list[tuple[str, str | None]] = []


class _Place:
    """Where an object or array stands. Paths are put together only where a row or field needs them."""

    __slots__ = ("parent", "key", "row", "index", "is_list", "node", "seen", "_path", "_rel", "_at")

    def __init__(self, parent: _Place | None, key: str | None, row: Row | None, is_list: bool, node: dict | None):
        self.parent, self.key, self.row, self.is_list, self.node = parent, key, row, is_list, node
        self.index = -1
        self.seen: set[str] | None = None
        self._path = self._rel = self._at = None

    def path(self) -> str:
        if self._path is None:
            names, place = [], self
            while place is not None and place._path is None:
                if place.key is not None:
                    names.append(place.key)
                elif place.is_list:  # an array in an array
                    names.append("[]")
                place = place.parent
            self._path = _joined(place._path if place is not None else "", reversed(names))
        return self._path

    def rel(self) -> str:
        """The path from the row on."""
        if self._rel is None:
            names, place = [], self
            while place.parent is not None and place.parent.row is place.row and place.key is not None:
                names.append(place.key)
                place = place.parent
            self._rel = ".".join(reversed(names))
        return self._rel

    def at(self) -> tuple[int, ...]:
        """The positions of the lists around."""
        positions, place = [], self
        while place is not None:
            if place.is_list:
                positions.append(place.index)
            place = place.parent
        return tuple(reversed(positions))


def _joined(path: str, names: Iterable[str]) -> str:
    parts = [path] if path else []
    for name in names:
        if name == "[]" and parts:
            parts[-1] += "[]"
        else:
            parts.append(name)
    return ".".join(parts)


def tree_of(lists: Iterable[str]) -> dict:
    """The declared lists by the names of their paths; the key ``None`` marks a list."""
    tree: dict = {}
    for path in lists:
        node = tree
        for name in path.split("."):
            node = node.setdefault(name, {})
        node[None] = True
    return tree


def record_rows(text: str | None, declared: dict) -> list[Row]:
    """The rows of one record, the record itself first (path ``""``, no position); none if it is not a valid object."""
    if text is None:
        return []
    try:
        return _rows(text, declared)
    except ValueError:
        return []


def _inner(value: str | None) -> list[Event] | None:
    """The events of a text that holds an object or array, through any number of texts around it."""
    while value is not None and value.lstrip()[:1] in ("{", "[", '"'):
        try:
            held = list(events(value))
        except ValueError:
            return None
        if held[0][0] != TEXT:
            return held if held[0][0] in (OBJECT, ARRAY) else None
        value = held[0][2]
    return None


def _rows(text: str, declared: dict) -> list[Row]:
    out: list[Row] = []
    stream: Iterator[Event] = events(text)
    waiting: list[Iterator[Event]] = []
    place: _Place | None = None
    held_key: str | None = None  # of the value that is read from a text
    while True:
        event = next(stream, None)
        if event is None:
            if not waiting:
                return out
            stream = waiting.pop()
            continue
        kind, key, value = event
        if kind == END:
            place = place.parent
            continue
        if key is not None:
            if place.seen is None:
                place.seen = {key}
            elif key in place.seen:
                _forget(out, place, key)
            else:
                place.seen.add(key)
        elif held_key is not None:
            key, held_key = held_key, None
        in_list = place is not None and place.is_list
        if in_list:
            place.index = place.index + 1 if key is None else int(key)  # or an object keyed by position
        if place is None:
            node = declared
        elif in_list:
            node = place.node
        else:
            node = None if place.node is None else place.node.get(key)
        is_list = node is not None and None in node and not in_list
        if kind == TEXT and node is not None and (held := _inner(value)) is not None:
            waiting.append(stream)
            if in_list and key is None:
                place.index -= 1
            held_key = key
            stream = iter(held)
            continue
        if kind == TEXT or kind == OTHER:
            if place is None:
                continue
            if not in_list:
                rel = place.rel()
                place.row.fields.append((f"{rel}.{key}" if rel else key, value))
            elif value is not None:
                row = Row(place.path(), place.at(), False)
                row.fields.append(("", value))
                out.append(row)
            continue
        name = None if in_list else key
        if kind == ARRAY:
            place = _Place(place, name, None if place is None else place.row, True, node)
        elif is_list:
            held, by_position = _until_closed(stream)
            waiting.append(stream)
            place = _Place(place, name, place.row, True, node)
            # or one object alone
            stream = iter(held if by_position else [(OBJECT, None, None), *held, (END, None, None)])
        elif in_list or place is None:
            row = Row("", (), True) if place is None else Row(place.path(), place.at(), True)
            out.append(row)
            place = _Place(place, None, row, False, node)
        else:
            place = _Place(place, name, place.row, False, node)


def _until_closed(stream: Iterator[Event]) -> tuple[list[Event], bool]:
    """The events to the end of an object that has begun, and whether all its keys are positions."""
    held, depth, keys = [], 1, []
    for event in stream:
        held.append(event)
        if depth == 1 and event[0] != END:
            keys.append(event[1])
        if event[0] <= ARRAY:
            depth += 1
        elif event[0] == END:
            depth -= 1
            if not depth:
                break
    return held, bool(keys) and all(k.isascii() and k.isdigit() for k in keys)


def _forget(out: list[Row], place: _Place, key: str) -> None:
    """Takes back what an equal key before has given."""
    if place.is_list:
        path, at = place.path(), (*place.at()[:-1], int(key))
        out[:] = [r for r in out if not (r.path.startswith(path) and r.at[: len(at)] == at)]
        return
    rel, row = place.rel(), place.row
    rel = f"{rel}.{key}" if rel else key
    path = _joined(row.path, rel.split("."))
    row.fields = [f for f in row.fields if f[0] != rel and not f[0].startswith(rel + ".")]
    out[:] = [r for r in out if r is row or r.at[: len(row.at)] != row.at or not (r.path == path or r.path.startswith((path + ".", path + "[")))]


def _encodable(value):
    """Halves of surrogate pairs, which JSON can write and no text can hold, as replacement characters."""
    if isinstance(value, str):
        return value.encode("utf-8", "surrogatepass").decode("utf-8", "replace")
    if isinstance(value, dict):
        return {k: _encodable(v) for k, v in value.items()}
    return [_encodable(v) for v in value] if isinstance(value, list) else value


_FIELD = T.StructType([T.StructField("field", T.StringType()), T.StructField("value", T.StringType())])
_ROW = T.StructType([
    T.StructField("coll_path", T.StringType()), T.StructField("at", T.ArrayType(T.IntegerType())), T.StructField("is_object", T.BooleanType()),
    T.StructField("fields", T.ArrayType(_FIELD)),
])
_KIND = pa.list_(pa.struct([
    ("coll_path", pa.string()), ("at", pa.list_(pa.int32())), ("is_object", pa.bool_()), ("fields", pa.list_(pa.struct([("field", pa.string()), ("value", pa.string())]))),
]))
_FLAT = ["coll_path", "at", "pos", "is_object", "fields"]


def flatten_records(
    df: DataFrame, record: str, lists: Iterable[str] = (), only: Iterable[str] | None = None, key: str = "person_id", order: str = "ingested_at", with_fields: bool = True
) -> DataFrame:
    """``key, coll_path, at, pos, is_object, fields``: every row of each key's current record.

    ``lists`` are declared; all others are found. ``only`` keeps the rows of these paths. Records are read where they
    lie; what is shuffled to find the current one are its flat rows.
    """
    declared, wanted = tree_of(lists), None if only is None else frozenset(only)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for v in batch.column(0):
                rows = record_rows(v.as_py(), declared)
                found.append([
                    {"coll_path": r.path, "at": r.at, "is_object": r.is_object, "fields": [{"field": f, "value": x} for f, x in r.fields] if with_fields else None}
                    for r in rows if wanted is None or r.path in wanted
                ])
            try:
                rows = pa.array(found, _KIND)
            except UnicodeEncodeError:
                rows = pa.array(_encodable(found), _KIND)
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), rows], names=[key, order, "rows"])

    schema = T.StructType([df.schema[key], df.schema[order], T.StructField("rows", T.ArrayType(_ROW))])
    read = df.where(F.col(key).isNotNull()).select(record, key, order).mapInArrow(run, schema)
    rows = latest(read, key, "rows", order).select(key, F.explode("rows").alias("r"))
    pos = F.coalesce(F.try_element_at("r.at", F.lit(-1)), F.lit(0))
    return rows.select(key, "r.coll_path", "r.at", pos.alias("pos"), "r.is_object", "r.fields")


def flatten_lists(df: DataFrame, record: str, lists: list[str], key: str = "person_id", order: str = "ingested_at", with_fields: bool = True) -> DataFrame:
    """``key, coll_path, pos, fields`` of every object in the declared lists of each key's current record."""
    rows = flatten_records(df, record, lists, lists, key, order, with_fields)
    return rows.where("is_object").select(key, "coll_path", "pos", "fields")


def pivot_fields(rows: DataFrame, fields: list[str]) -> DataFrame:
    """The flat rows with a column for each of these fields, null where a row lacks it; no shuffle."""
    def value(name: str):
        hits = F.filter("fields", lambda f: f["field"] == F.lit(name))
        return F.try_element_at(hits, F.lit(1))["value"].alias(name.replace(".", "_"))

    return rows.select(*[c for c in rows.columns if c != "fields"], *[value(f) for f in fields])


#: The lists of a person record (fixed values).
PERSON_LISTS = [
    "entry.footnotes", "identity.alternate_names", "identity.name_dispute_notes", "life.birth.notes", "life.death.notes", "life.conversion",
    "life.companionship", "life.battles", "life.offices", "life.family", "life.residences", "life.traits", "life.events", "life.wounds",
    "life.ages", "narration.narrated_from", "narration.narrated_to", "narration.praise", "narration.criticism", "narration.defenses", "labels",
]
_FACT = ["value", "source", "evidence", "confidence", "page"]
_KIND_TOO = [*_FACT, "kind"]
#: The fields of the objects of each list that have a column in its table; all others come out in ``other``.
LIST_FIELDS = {
    **dict.fromkeys(PERSON_LISTS, _KIND_TOO), "entry.footnotes": ["marker", "text", "page"], "identity.alternate_names": [*_KIND_TOO, "normalized"],
    "life.battles": [*_FACT, "key"], "life.offices": [*_FACT, "role", "place"], "life.family": [*_FACT, "normalized", "relation"], "life.residences": [*_FACT, "key"],
    "life.events": [*_KIND_TOO, "key", "year_hijri", "place"], "life.ages": [*_KIND_TOO, "years"], "narration.narrated_from": [*_FACT, "normalized"],
    "narration.narrated_to": [*_FACT, "normalized"], "labels": ["key", "source", "confidence"],
}
FACT_FIELDS = ["value", "normalized", "kind", "key", "source", "evidence", "confidence", "page", "relation", "marker", "text", "year_hijri", "place", "role", "years"]
#: The fields of the record itself, outside of all lists, that have a column in its table.
RECORD_FIELDS = [
    "schema_version", "book.slug", "book.book_id", "entry.number", "entry.volume", "entry.page_start", "entry.page_end", "entry.kind", "entry.length_class",
    "identity.display_name", "identity.kunya", "identity.is_woman", "identity.nasab.full_name", "classification.qism", "classification.section_type",
    "classification.letter", "life.birth.year_hijri", "life.death.year_hijri", "narration.is_prolific",
]


def flat_table(rows: DataFrame, fields: list[str]) -> DataFrame:
    """The flat rows with a column for each of these fields; ``other`` holds the fields and values without a column."""
    other = F.filter("fields", lambda f: ~f["field"].isin(fields))
    held = rows.select("*", other.alias("other"))
    return pivot_fields(held, fields)


def _persons(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/persons.parquet")


def _list_query(name: str):
    def query(spark, sf_dir: str) -> DataFrame:
        return flat_table(flatten_lists(_persons(spark, sf_dir), "person_json", [name]), LIST_FIELDS[name])

    return query


#: A query for the flat table of each list.
LIST_QUERIES = {f"p4_{name.replace('.', '_')}": _list_query(name) for name in PERSON_LISTS}


def p4_found(spark, sf_dir: str) -> DataFrame:
    return flatten_lists(_persons(spark, sf_dir), "person_json", PERSON_LISTS, with_fields=False).select("person_id", "coll_path", "pos")


def p4_facts(spark, sf_dir: str) -> DataFrame:
    """The objects of all lists of a record in one table."""
    return flat_table(flatten_lists(_persons(spark, sf_dir), "person_json", PERSON_LISTS), FACT_FIELDS)


def p4_record(spark, sf_dir: str) -> DataFrame:
    """One row for each valid record: the root table to which ``person_id`` links all others."""
    return flat_table(flatten_records(_persons(spark, sf_dir), "person_json", PERSON_LISTS, [""]).select("person_id", "fields"), RECORD_FIELDS)


def p4_inner(spark, sf_dir: str) -> DataFrame:
    """The rows of every list inside another's items, at any depth: ``parent_pos`` are the positions down to the parent's row."""
    rows = flatten_records(_persons(spark, sf_dir), "person_json", PERSON_LISTS).where("size(at) > 1")
    return rows.select("person_id", "coll_path", F.slice("at", F.lit(1), F.size("at") - 1).alias("parent_pos"), "pos", "fields")


def p4_tables(spark, sf_dir: str) -> DataFrame:
    """The tables found: path of the list, depth of nesting, rows, and how many of them are objects."""
    rows = flatten_records(_persons(spark, sf_dir), "person_json", PERSON_LISTS, with_fields=False)
    counts = rows.groupBy("coll_path", F.size("at").alias("list_depth"))
    return counts.agg(F.count("*").alias("n_rows"), F.sum(F.col("is_object").cast("long")).alias("n_objects"))
