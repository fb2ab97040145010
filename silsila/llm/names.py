"""Linking the entries of one person under the spellings that different compilers wrote.

Merge and rematch: every distinct spelling is a profile; profiles that share a blocking key are compared; the best
mutual matches are merged, which unites their spellings and initials; merged profiles, being richer, are blocked and
compared again, until a round merges nothing. Strong matches come first. Weak ones (an initial for a name, a father
left out, a name and a father's name and nothing else) are taken afterwards, and only where each side has no other
candidate that is as good.

Defined cases: entries without any name, or with a kunya alone, are linked with none; a person has at most one entry in a book (the part
of the id before the first colon), so profiles that share a book are never merged; of equal spellings of which one
book has several entries, these are namesakes that nothing tells apart and are linked with none, while those of
other books are linked. A profile's entries are thus at most as many as there are books, and no group of equal
rows, however large, is compared with itself.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache, reduce
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.folding import fold
from ..operators.current import current_rows
from ..session import bucketed, counted, materialize, release
from .lookalike import Canonical, representatives

# --- fixed values ------------------------------------------------------------------------------------
SON, DAUGHTER = {"بن", "ابن"}, {"بنت", "ابنه"}
KUNYA_MALE, KUNYA_FEMALE = {"ابو", "ابي", "ابا"}, {"ام"}
SERVANT = "عبد"  # takes the next word with it
ARTICLE = "ال"
KNOWN_AS = re.compile(r" المعروفه? ب(\S+)")
# -----------------------------------------------------------------------------------------------------
#: A block with more profiles than this is compared in portions of about this many (see ``_blocks``).
BLOCK = 64
#: Profiles that a worker keeps taken apart, two kilobytes each.
KNOWN_PROFILES = 8_000
#: Tables of new blocking keys that are kept apart before they are written as one.
MOST_STAGES = 8

_INVERTED = re.compile(r"^(ال\S+)(?: (ال\S+))? ، (.+)$")


class Variant(NamedTuple):
    """One spelling, taken apart: own name, father, grandfather and so on; affiliations; kunya; sex."""

    line: tuple[str, ...]
    nisbas: tuple[str, ...]
    kunya: str
    female: str  # "1", "0" or "" where it is not known


@lru_cache(maxsize=1)
def _canonical() -> Canonical:
    return Canonical(representatives({}))


def spelling(name: str | None) -> str:
    """The spelling that is compared: look-alikes, vowel marks and carriers folded."""
    return " ".join(fold(_canonical()(name)).replace("ى", "ي").replace("ی", "ي").replace("ک", "ك").split()) if name else ""


def take_apart(name: str) -> Variant:
    name = " ".join(name.replace("،", " ، ").split())
    nisbas: list[str] = []
    kunya, female = "", ""
    if m := _INVERTED.match(name):
        nisbas += [x for x in (m[1], m[2]) if x]
        name = m[3]
    if m := KNOWN_AS.search(name):
        name = name[: m.start()] + name[m.end() :]
    words = name.split()
    if len(words) > 1 and words[0] in KUNYA_MALE | KUNYA_FEMALE:
        female = "1" if words[0] in KUNYA_FEMALE else "0"
        take = 3 if words[1] == SERVANT and len(words) > 2 else 2
        kunya, words = " ".join(words[1:take]), words[take:]
    segments: list[list[str]] = [[]]
    for w in words:
        if w in SON or w in DAUGHTER:
            # between two names without a link the sex is that of a forefather
            if len(segments) == 1 and len([x for x in segments[0] if not x.startswith(ARTICLE)]) < 2:
                female = "1" if w in DAUGHTER else (female or "0")
            segments.append([])
        elif segments[-1] and w.startswith(ARTICLE) and not w.endswith("ي") and 2 <= len(segments[-1][-1]) <= 4 and distance(segments[-1][-1], SERVANT, 1) <= 1:
            segments[-1][-1] = f"{SERVANT} {w}"
        elif segments[-1] and segments[-1][-1] == SERVANT:
            segments[-1][-1] += " " + w
        else:
            segments[-1].append(w)
    line: list[str] = []
    for k, segment in enumerate(segments):
        if len(segment) == 1:
            lone = segment[0]
            if lone.startswith(ARTICLE) and lone.endswith("ي") and k == len(segments) - 1 and (k or kunya):
                nisbas.append(lone)
                segment = []
        else:
            names = [w for w in segment if not w.startswith(ARTICLE)]
            if not names and segment and (k or not kunya):
                names = segment[:1]
            nisbas += [w for w in segment if w not in names]
            segment = names
        if not segment and k == 0:
            line.append("")
        line += [w.rstrip(".") for w in segment]
    if line == [""]:
        line = []
    return Variant(tuple(line), tuple(nisbas), kunya, female)


def distance(a: str, b: str, most: int = 2) -> int:
    """Edits (a swap of neighbours is one) between the names, or ``most + 1``."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    if most == 1:
        return 1 if _one_edit(a, b) else 2
    before: list[int] = []
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
        before, last = last, row
    return min(last[-1], most + 1)


def _one_edit(a: str, b: str) -> bool:
    """Whether two different names are one edit apart."""
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    if len(a) < len(b):
        return len(b) == len(a) + 1 and a[i:] == b[i + 1 :]
    return a[i + 1 :] == b[i + 1 :] or a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :]


class Profile(NamedTuple):
    own: frozenset[str]
    father: frozenset[str]
    lines: tuple[tuple[str, ...], ...]
    ends: frozenset[str]
    nisbas: frozenset[str]
    kunyas: frozenset[str]
    female: frozenset[str]


@lru_cache(maxsize=KNOWN_PROFILES)
def profile(variants: str) -> Profile:
    parsed = [Variant(tuple(a.split(";")) if a else (), tuple(b.split(";")) if b else (), c, d) for a, b, c, d in (v.split("|") for v in variants.split("\n"))]
    own = {v.line[0] for v in parsed if v.line and v.line[0]}
    father = {v.line[1] for v in parsed if len(v.line) > 1}
    # an initial that a full spelling explains says no more
    for names in (own, father):
        full = {n for n in names if len(n) > 1}
        names -= {n for n in names if len(n) == 1 and any(f[0] == n for f in full)}
    return Profile(
        frozenset(own), frozenset(father), tuple(v.line for v in parsed if len(v.line) > 2), frozenset(v.line[-1] for v in parsed if len(v.line) > 2),
        frozenset(n for v in parsed for n in v.nisbas), frozenset(v.kunya for v in parsed if v.kunya), frozenset(v.female for v in parsed if v.female),
    )


def pack(variants: list[Variant]) -> str:
    return "\n".join(sorted({"|".join((";".join(v.line), ";".join(v.nisbas), v.kunya, v.female)) for v in variants}))


_WEAK_LETTERS = str.maketrans("", "", "اويىء")


def _bare(name: str) -> str:
    """What stands behind ``عبد`` and the article; any other name as it is."""
    return name.rsplit(" ", 1)[-1].removeprefix(ARTICLE) if name.startswith(SERVANT + " ") else name


@lru_cache(maxsize=KNOWN_PROFILES)
def firm_letters(name: str) -> tuple[str, ...]:
    """The last three firm letters of a name; a feminine end counts only where fewer are left without it."""
    name = _bare(name)
    whole = name.translate(_WEAK_LETTERS)
    cut = name.removesuffix("ه").removesuffix("اء").translate(_WEAK_LETTERS)
    return tuple(dict.fromkeys(x[-3:] for x in ((cut,) if len(cut) > 2 else (cut, whole)) if x))


def _is_pet(name: str) -> bool:
    """Whether the name has the shape of a pet name: XYyZ, XaZw or XwZw."""
    return len(name) == 4 and (name[2] == "ي" or name[1] in "او" and name[3] == "و")


def _pet_form(pet: str, name: str) -> bool:
    """Pet names are made of a name's last firm letters, or of its first, some more in their order and its last."""
    if pet == name or not _is_pet(pet):
        return False
    if pet == _bare(name):
        return True
    for x in firm_letters(name):
        if pet in (f"{x[0]}ا{x[-1]}و", f"{x[0]}و{x[-1]}و") or len(x) == 3 and pet == f"{x[0]}{x[1]}ي{x[2]}":
            return True
    a, b = pet.translate(_WEAK_LETTERS), _bare(name).translate(_WEAK_LETTERS)
    if not 2 <= len(a) <= len(b) or a[0] != b[0] or a[-1] != b[-1]:
        return False
    rest = iter(b)
    return all(c in rest for c in a)


def _agree(a: frozenset[str], b: frozenset[str]) -> int:
    """3 equal, 2 one edit, 1 an initial or a pet form, 0 unknown, -1 different."""
    if not a or not b:
        return 0
    if any(len(x) > 1 for x in a & b):
        return 3
    best = -1
    for x in a:
        for y in b:
            if len(x) == 1 or len(y) == 1:
                if x[0] == y[0]:
                    best = max(best, 1)
            elif min(len(x), len(y)) > 2 and distance(x, y, 1) <= 1:
                return 2
            elif _pet_form(x, y) or _pet_form(y, x):
                best = max(best, 1)
    return best


def _near(x: str, y: str) -> bool:
    return x == y or len(x) == 1 == len(y[:1]) and x == y[0] or len(y) == 1 and x[:1] == y or distance(x, y, 1) <= 1


def _within(short: tuple[str, ...], long: tuple[str, ...]) -> bool:
    """Whether the shorter line is the longer one with forefathers left out."""
    rest = iter(long)
    return all(any(_near(x, y) for y in rest) for x in short)


def _lines_agree(a: Profile, b: Profile) -> int:
    """2 if the forefathers behind the father agree, one line leaving some out; 0 if nothing is known, -1 if they differ."""
    best = 0
    for x in a.lines:
        for y in b.lines:
            short, long = (x[2:], y[2:]) if len(x) <= len(y) else (y[2:], x[2:])
            if _within(short, long):
                return 2
            best = -1
    return best


def _father_left_out(a: Profile, b: Profile, surely: bool) -> bool:
    """Whether one line is the other without the father, two forefathers at least agreeing.

    ``surely`` if nobody but the father is left out before them, and no two lines name a father each.
    """
    found = False
    for x in a.lines:
        for y in b.lines:
            if _near(x[1], y[1]):
                continue
            held = False
            for without, other in ((x[1:], y[2:]), (y[1:], x[2:])):
                short, long = (without, other) if len(without) <= len(other) else (other, without)
                if _within(short, long) and (_near(without[0], other[0]) or short is without and not surely):
                    held = True
                    found = found or len(short) > 1
            if surely and not held:
                return False
    return found


def match(a: Profile, b: Profile) -> int:
    """Score of two profiles: 0 no match, below 100 weak, from 100 on strong."""
    if a.female and b.female and not a.female & b.female:
        return 0
    own = _agree(a.own, b.own)
    father = _agree(a.father, b.father)
    kunya = _agree(a.kunyas, b.kunyas)
    if kunya < 0 and any(distance(x, y, 2) <= 2 for x in a.kunyas for y in b.kunyas if min(len(x), len(y)) > 4):
        kunya = 1
    if kunya < 0:
        return 0
    line = _lines_agree(a, b)
    left_out = father < 0 and own >= 2 and _father_left_out(a, b, surely=kunya < 2)
    if left_out:
        father, line = 2, 2
    if line < 0 and kunya >= 2 and own >= 2 and father >= 2:
        line = 0  # lines that leave out different forefathers
    if min(father, line) < 0:
        return 0
    if own < 0:
        near = kunya >= 2 and any(distance(x, y, 2) <= 2 for x in a.own for y in b.own)
        if not near:
            return 0
        own = 1
    nisba, end = _agree(a.nisbas, b.nisbas), _agree(a.ends, b.ends)
    tribe = max(nisba, end)
    if tribe < 0 or (nisba < 0 and end == 0):
        return 0
    score = 4 * own + 4 * father + 3 * kunya + 2 * line + max(tribe, 0)
    if left_out and kunya < 2:
        return score if tribe >= 2 else 0
    known = (tribe >= 2) + (line > 0) + (kunya >= 2)
    if own >= 2 and father >= 2 and known:
        return 100 + score
    if own == 1 and father >= 2 and kunya >= 2 and (tribe >= 2 or line > 0):
        return 100 + score
    if own >= 2 and father >= 1 and kunya >= 2 and tribe >= 2:
        return 100 + score
    if own == 1 and father >= 2 and tribe >= 2 and line > 0:
        return score
    if own >= 2 and father >= 2 and not (a.nisbas or a.ends) | (b.nisbas or b.ends):
        return 0
    if own >= 2 and father >= 2:
        return score
    if father == 0 and own >= 2 and kunya >= 2 and tribe >= 2:
        return score
    if own == 0 and father >= 2 and kunya >= 2 and tribe >= 2:
        return score
    if father == 0 and (own == 3 or own == 0 and kunya >= 2) and nisba >= 2:
        return score  # one of them has an own name or a kunya and an affiliation and nothing else
    return 0


def near_of(packed: str) -> dict[str, list[str]]:
    """The labels beside themselves under which these names are blocked (see ``_with_near``)."""
    out: dict[str, list[str]] = {}
    for line in filter(None, packed.split("\n")):
        name, label = line.split("|")
        out.setdefault(name, []).append(label)
    return out


class Key(NamedTuple):
    """A blocking key. Of a key whose ``inside`` is false only profiles with different ``part`` are compared."""

    key: str
    part: int = 0
    inside: bool = True


def _labels(names, near: dict[str, list[str]]) -> list[str]:
    return sorted({label for n in names if len(n) > 1 for label in (n, *near.get(n, ()))})


def keys_of(p: Profile, near: dict[str, list[str]] | None = None) -> list[Key]:
    """Blocking keys: every two profiles that ``match`` meet under one, if ``near`` has the labels of their names.

    A match rests on parts that are equal or one edit apart, and names one edit apart share a label: own name and
    father (or, where one line leaves the father out, the grandfather); one of them and the kunya; or, where the own
    name of one is an initial or a pet form, father and tribe; or, where one has no father, own name or kunya and the
    affiliation.
    """
    near = near or {}
    own, father, kunyas = _labels(p.own, near), _labels(p.father, near), _labels(p.kunyas, near)
    tribes = [*(f"e{e}" for e in _labels(p.ends, near)), *(f"n{n}" for n in _labels(p.nisbas, near))]
    elders = _labels({x[2] for x in p.lines if len(x) > 3}, near)
    out = {Key(f"of|{o}|{f}") for o in own for f in (*father, *elders)}
    out |= {Key(f"ok|{o}|{k}") for o in own for k in kunyas}
    out |= {Key(f"fk|{f}|{k}") for f in father for k in kunyas}
    kin = [f"ft|{f}|{t}" for f in father for t in tribes]
    out |= {Key(k, 1, False) for k in kin}
    if any(len(n) == 1 or _is_pet(n) for n in p.own):
        out |= {Key(k, 0, False) for k in kin}
    # who has no father is compared with who has one
    part, nisbas = int(bool(p.father)), _labels(p.nisbas, near)
    out |= {Key(f"on|{o}|{n}", part, False) for o in p.own if len(o) > 1 for n in nisbas}
    if p.father or not p.own:
        out |= {Key(f"kn|{k}|{n}", part, False) for k in kunyas for n in nisbas}
    return sorted(out)


#: The ways to part tribe (n), line (g) and kunya (k) between two profiles of which neither tells what the other does.
_SPLITS = (("", "ngk"), ("n", "gk"), ("g", "nk"), ("k", "ng"))


def finer_keys(kind: str, p: Profile, near: dict[str, list[str]] | None = None) -> list[Key]:
    """What parts a crowded block: every two of its profiles that match meet under one of these.

    Two profiles of one own name and father match because they share a further part, or an initial of one, or because
    each leaves open what the other tells. Those that meet otherwise share a tribe or a forefather as well.
    """
    near = near or {}
    if kind in ("on", "kn"):
        return [Key("")]  # the one of them has no further part
    elders = {g for x in p.lines for g in x[2:]}
    out = [Key(f"g{g}") for g in _labels(elders, near)]
    out += [Key(f"i{x[0]}", int(len(x) > 1), False) for x in sorted({*elders, *p.nisbas, *p.kunyas})]
    if kind in ("of", "ok", "fk"):
        out += [Key(f"t{t}") for t in _labels(p.ends | p.nisbas, near)]
    if kind == "of":
        out += [Key(f"k{k}") for k in _labels(p.kunyas, near)]
        out += [Key(f"long kunya {len(k) // 3 + d}") for k in p.kunyas if len(k) > 4 for d in (0, 1)]  # two edits may lie between them
        told = {x for x, known in (("n", p.nisbas), ("g", p.lines), ("k", p.kunyas)) if known}
        for one, other in _SPLITS:
            out += [Key(f"r{one}", part, False) for part, side in ((0, one), (1, other)) if told <= set(side)]
    return list(dict.fromkeys(out))


_ENTRY = T.StructType([T.StructField("person_id", T.StringType()), T.StructField("variants", T.StringType())])


def _entries(df: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, packed = [], []
            for key, full, display, kunya in zip(*(c.to_pylist() for c in batch.columns)):
                names = [take_apart(s) for s in (spelling(full), spelling(display)) if s]
                if k := spelling(kunya):
                    names.append(take_apart(k + " "))
                names = [v for v in names if v.line or v.kunya or v.nisbas]
                if any(v.line for v in names) or any(v.nisbas for v in names) and any(v.kunya for v in names):
                    ids.append(key)
                    packed.append(pack(names))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(packed, pa.string())], names=["person_id", "variants"])

    return df.select("person_id", "full_name_norm", "display_name_norm", "kunya").mapInArrow(run, _ENTRY)


def _number(key: str) -> int:
    from xxhash import xxh3_64_intdigest

    return xxh3_64_intdigest(key.encode()) - (1 << 63)


def shortened(name: str) -> set[str]:
    """The name and what is left of it without one letter; names one edit apart share one of these."""
    return {name, *(name[:i] + name[i + 1 :] for i in range(len(name)))}


def _with_near(profiles: DataFrame) -> DataFrame:
    """``profiles`` with ``near``: lines ``name|label`` of its names that have a more frequent name one edit apart.

    Of two such names the more frequent one is the label under which both are blocked. Only distinct names are
    compared, and a shortened name is that of a bounded number of names.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, names = [], []
            for i, v in zip(*(c.to_pylist() for c in batch.columns)):
                p = profile(v)
                found = {n for n in (*p.own, *p.father, *p.kunyas, *p.nisbas, *(g for x in p.lines for g in x[2:])) if len(n) > 2}
                ids += [i] * len(found)
                names += found
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(names, pa.string())], names=["id", "name"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(name, n, short) for name, n in zip(*(c.to_pylist() for c in batch.columns)) for short in shortened(name)]
            columns = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string()))], names=["name", "n", "short"])

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([distance(a, b, 1) <= 1 for a, b in zip(*(c.to_pylist() for c in batch.columns))], pa.bool_()))

    names = materialize(profiles.select("id", "variants").mapInArrow(read, "id long, name string"))
    short = materialize(names.groupBy("name").agg(F.count("*").alias("n")).mapInArrow(cut, "name string, n long, short string"))
    more = short.select("short", F.col("name").alias("label"), F.col("n").alias("m"))
    pairs = short.join(more, "short").where(F.struct("m", "label") > F.struct("n", "name")).select("name", "label").distinct()
    labels = names.join(pairs.mapInArrow(close, "name string, label string"), "name")
    near = labels.groupBy("id").agg(F.array_join(F.array_sort(F.collect_set(F.concat_ws("|", "name", "label"))), "\n").alias("near"))
    out = bucketed(profiles.join(near, "id", "left").withColumn("near", F.coalesce("near", F.lit(""))), "id")
    release(names, short, profiles)
    return out


#: ``role`` is the kind of key, and the part of a profile in a block that is not compared inside.
_KEY_ROW = "id long, key long, role int"
_KINDS = ("of", "ok", "fk", "ft", "on", "kn")
_ALL = 2


def _role(kind: int, k: Key) -> int:
    return kind * 3 + (_ALL if k.inside else k.part)


def _key_batch(rows: list[tuple[int, str, int]]) -> pa.RecordBatch:
    ids, keys, roles = zip(*rows) if rows else ((),) * 3
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([_number(k) for k in keys], pa.int64()), pa.array(roles, pa.int32())], names=["id", "key", "role"])


def _keys(profiles: DataFrame) -> DataFrame:
    """The blocking keys of all profiles, as 64-bit hashes; a collision only adds a comparison."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, v, near in zip(*(c.to_pylist() for c in batch.columns)):
                rows += [(i, k.key, _role(_KINDS.index(k.key[:2]), k)) for k in keys_of(profile(v), near_of(near))]
            yield _key_batch(rows)

    return profiles.select("id", "variants", "near").mapInArrow(run, _KEY_ROW)


def _fresh_keys(merged: DataFrame) -> DataFrame:
    """Of merged profiles the keys that none of their parts had."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, v, near, parts in zip(*(c.to_pylist() for c in batch.columns)):
                labels = near_of(near)
                known = {k for part in parts for k in keys_of(profile(part), labels)}
                rows += [(i, k.key, _role(_KINDS.index(k.key[:2]), k)) for k in keys_of(profile(v), labels) if k not in known]
            yield _key_batch(rows)

    return merged.select("id", "variants", "near", "parts").mapInArrow(run, _KEY_ROW)


class Crowded(NamedTuple):
    """Keys of blocks with too many profiles, and the number of portions of what is still crowded behind a further part."""

    keys: DataFrame
    portions: DataFrame


def _parted(rows: DataFrame) -> DataFrame:
    """Key rows ``(.., variants, near)`` under their finer keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for i, key, role, v, near in zip(*(c.to_pylist() for c in batch.columns)):
                kind, part = divmod(role, 3)
                for k in finer_keys(_KINDS[kind], profile(v), near_of(near)):
                    if part == _ALL:
                        found.append((i, f"{key}|{k.key}", _role(kind, k)))
                    elif k.inside:
                        found.append((i, f"{key}|{k.key}", role))
                    else:  # the parts of both must differ
                        found.append((i, f"{key}|{k.key}|{(part + k.part) % 2}", role))
            yield _key_batch(found)

    return rows.select("id", "key", "role", "variants", "near").mapInArrow(run, _KEY_ROW)


def _crowded(keys: DataFrame, profiles: DataFrame, block: int) -> Crowded | None:
    """What is crowded among ``keys``, counted over all of them; none on most data."""
    many = materialize(keys.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > block).select("key"))
    if many.isEmpty():
        release(many)
        return None
    finer = _parted(keys.join(many, "key", "left_semi").join(profiles.select("id", "variants", "near"), "id"))
    counts = finer.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > block)
    return Crowded(many, materialize(counts.select("key", F.ceil(F.col("n") / block).cast("int").alias("portions"))))


def _blocks(keys: DataFrame, profiles: DataFrame, crowded: Crowded | None) -> DataFrame:
    """``id, key, role, cut`` of every profile in its blocks.

    A crowded block is parted by a further part of its names. What is crowded still is cut into portions by a hash, and
    each two of them, and each by itself, make a block: all its pairs are compared, in many tasks. ``cut`` is the portion
    where two meet.
    """
    if crowded is None:
        return keys.select("id", "key", "role", F.lit(-1).alias("cut"))
    small = keys.join(crowded.keys, "key", "left_anti")
    finer = _parted(keys.join(crowded.keys, "key", "left_semi").join(profiles.select("id", "variants", "near"), "id"))
    dealt = finer.join(crowded.portions, "key", "left").withColumn("cut", F.expr("cast(pmod(xxhash64(id), coalesce(portions, 1)) as int)"))
    met = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.coalesce("portions", F.lit(1)) - 1)))
    key = F.when(F.col("portions").isNull(), F.col("key")).otherwise(F.xxhash64("key", F.least("cut", "with"), F.greatest("cut", "with")))
    cut = F.when(F.col("cut") == F.col("with"), -1).otherwise(F.col("cut"))
    parted = met.select("id", key.alias("key"), "role", cut.alias("cut"))
    return small.select("id", "key", "role", F.lit(-1).alias("cut")).unionByName(parted)


def _pairs(left: DataFrame, *rights: DataFrame, once: bool = False) -> DataFrame:
    """``a, b`` (a < b) of the profiles that meet in a block; each side of the join keeps its buckets."""
    found = []
    for right in rights:
        other = right.select("key", F.col("id").alias("other"), F.col("role").alias("other_role"), F.col("cut").alias("other_cut"))
        pairs = left.join(other, "key").where("id < other" if once else "id != other")
        pairs = pairs.where(f"role % 3 = {_ALL} or role != other_role").where("cut = -1 or cut != other_cut")
        found.append(pairs.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")))
    return reduce(DataFrame.unionByName, found).distinct()


def _scored(pairs: DataFrame, base: DataFrame, now: DataFrame | None) -> DataFrame:
    """``a, b, score`` of the pairs that share no book, 0 where they do not match; profiles of ``now`` go before those of ``base``."""

    def beside(rows: DataFrame, side: str) -> DataFrame:
        first = base.select(F.col("id").alias(side), F.col("variants").alias("v1"), F.col("books").alias("b1"))
        if now is None:
            return rows.join(first, side).withColumnsRenamed({"v1": f"v{side}", "b1": f"b{side}"})
        later = now.select(F.col("id").alias(side), F.col("variants").alias("v2"), F.col("books").alias("b2"))
        rows = rows.join(first, side).join(later, side, "left")
        return rows.withColumns({f"v{side}": F.coalesce("v2", "v1"), f"b{side}": F.coalesce("b2", "b1")}).drop("v1", "v2", "b1", "b2")

    joined = beside(beside(pairs, "a"), "b").where(~F.arrays_overlap("ba", "bb")).select("a", "b", "va", "vb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, va, vb = (c.to_pylist() for c in batch.columns)
            scores = pa.array([match(profile(x), profile(y)) for x, y in zip(va, vb)], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), scores], names=["a", "b", "score"])

    return joined.mapInArrow(run, "a long, b long, score int")


def link_profiles(entries: DataFrame, block: int = BLOCK) -> DataFrame:
    """``person_id, group_id`` of all entries ``(person_id, variants)`` that could be read.

    Every round but the last merges profiles, so the rounds end by themselves. The profiles as they were read are written
    once, in buckets of their number, their blocking keys once in buckets of the key; a round moves only what it
    changes: merged profiles, the keys they did not have before, and the candidate pairs.
    """
    entries = entries.withColumn("book", F.substring_index("person_id", ":", 1))
    # of equal spellings in one book none can be told from the others; as many books are gathered as there are
    per_book = materialize(entries.groupBy("variants", "book").agg(F.count("*").alias("n"), F.min("person_id").alias("person_id")))
    member = F.when(F.col("n") == 1, F.struct("book", "person_id"))
    grouped = per_book.groupBy("variants").agg(F.sort_array(F.collect_list(member)).alias("m")).where(F.size("m") > 0)
    # numbers are given once and then kept in the written table
    numbered = grouped.select(F.monotonically_increasing_id().alias("id"), "variants", F.col("m.book").alias("books"), F.col("m.person_id").alias("members"))
    base = _with_near(materialize(numbered))
    keys = bucketed(_keys(base), "key")
    crowded = _crowded(keys, base, block)
    blocks = _blocks(keys, base, None) if crowded is None else bucketed(_blocks(keys, base, crowded), "key")
    scores = materialize(_scored(_pairs(blocks, blocks, once=True), base, None))
    into: DataFrame | None = None  # number of each profile that was merged, and of the one it is part of now
    now: DataFrame | None = None  # the merged profiles
    later: list[DataFrame] = []  # blocks of the keys that merged profiles did not have before
    weak = False
    while True:
        merges, found = _mutual(scores, weak)
        if not found and not weak:
            release(merges)
            weak = True
            merges, found = _mutual(scores, weak)
        if not found:
            break
        before = [x for x in (into, now, scores, merges) if x is not None]
        step = merges.select(F.explode(F.array("a", "b")).alias("id"), F.col("a").alias("into"))
        changed = materialize(_merged(base, now, step))
        now = changed if now is None else materialize(now.join(step, "id", "left_anti").unionByName(changed.select(*now.columns)))
        moved = step if into is None else into.select("id", F.col("into").alias("was")).join(step.select(F.col("id").alias("was"), F.col("into").alias("to")), "was", "left").select(
            "id", F.coalesce("to", "was").alias("into")
        ).unionByName(step.join(into, "id", "left_anti"))
        into = materialize(moved)
        fresh = materialize(_blocks(_fresh_keys(changed), now, crowded))
        met = _pairs(fresh, blocks, fresh, *later)
        later.append(fresh)
        # candidates by their present numbers; what has changed is compared again
        ordered = _renumbered(scores, step).unionByName(_renumbered(met.withColumn("score", F.lit(0)), into).withColumn("again", F.lit(True))).where("a != b")
        pairs = materialize(ordered.groupBy("a", "b").agg(F.max("again").alias("again"), F.max("score").alias("score")))
        scores = materialize(pairs.where("not again").select("a", "b", "score").unionByName(_scored(pairs.where("again").select("a", "b"), base, now)))
        if len(later) == MOST_STAGES:
            before += later
            later = [materialize(reduce(DataFrame.unionByName, later))]
        release(pairs, *before, *((changed,) if changed is not now else ()))
    linked = base.select(F.explode("members").alias("person_id"), "id")
    if into is not None:
        linked = linked.join(into, "id", "left").withColumn("id", F.coalesce("into", "id"))
    alone = per_book.where("n > 1").select("variants", "book").join(entries, ["variants", "book"])
    alone = alone.select("person_id", (-1 - F.shiftrightunsigned(F.xxhash64("person_id"), 1)).alias("group_id"))
    release(keys, scores, *later, *((blocks,) if crowded else ()))
    return linked.select("person_id", F.col("id").alias("group_id")).unionByName(alone)


def _renumbered(pairs: DataFrame, numbers: DataFrame) -> DataFrame:
    """Scored pairs (a < b) by the ``numbers(id, into)`` of their profiles; ``again`` where a number has changed."""
    for side in ("a", "b"):
        pairs = pairs.join(numbers.select(F.col("id").alias(side), F.col("into").alias(f"to_{side}")), side, "left")
    a, b = F.coalesce("to_a", "a"), F.coalesce("to_b", "b")
    again = F.col("to_a").isNotNull() | F.col("to_b").isNotNull()
    return pairs.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"), "score", again.alias("again"))


def _mutual(scores: DataFrame, weak: bool) -> tuple[DataFrame, int]:
    """Pairs that are each other's best match, and how many; weak ones only where neither has another candidate as good.

    Equal strong scores are ordered by a hash of the pair, so that of many profiles alike many pairs are mutual at once.
    """
    scores = scores.where("score > 0" if weak else "score >= 100")
    both = scores.select("a", "b", "score", F.explode(F.array("a", "b")).alias("me"))
    tied = both.groupBy("me", "score").agg(F.count("*").alias("n"), F.max(F.struct(F.xxhash64("a", "b").alias("h"), "a", "b")).alias("top"))
    best = tied.groupBy("me").agg(F.max(F.struct("score", "n", "top")).alias("best")).where("best.n = 1 or best.score >= 100")
    return counted(best.groupBy("best.top.a", "best.top.b").agg(F.count("*").alias("votes")).where("votes = 2").select("a", "b"))


def _merged(base: DataFrame, now: DataFrame | None, step: DataFrame) -> DataFrame:
    """The profiles of ``step(id, into)`` united: ``id, variants, near, books, parts``."""
    columns = ["id", "into", "variants", "near", "books"]
    parts = base.join(step, "id") if now is None else base.join(step.join(now, "id", "left_anti"), "id").select(*columns).unionByName(now.join(step, "id").select(*columns))
    lines = lambda c: F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.split(c, "\n"))))), "\n")
    return parts.groupBy("into").agg(
        lines("variants").alias("variants"), lines("near").alias("near"), F.sort_array(F.flatten(F.collect_list("books"))).alias("books"), F.collect_list("variants").alias("parts")
    ).withColumnRenamed("into", "id")


def linked_entries(persons: DataFrame, block: int = BLOCK) -> DataFrame:
    now = current_rows(persons, "person_id", ["full_name_norm", "display_name_norm", "kunya"])
    return link_profiles(materialize(_entries(now)), block)


def p3_groups(spark, sf_dir: str) -> DataFrame:
    """One row for each entry with a readable name: the group it belongs to and the group's size."""
    groups = linked_entries(spark.read.parquet(f"{sf_dir}/persons.parquet"))
    sizes = groups.groupBy("group_id").agg(F.count("*").alias("n_entries"))
    return groups.join(sizes, "group_id").select("person_id", "group_id", "n_entries")


def p3_found(spark, sf_dir: str) -> DataFrame:
    """All pairs of each group; a group has at most one entry of a book."""
    groups = linked_entries(spark.read.parquet(f"{sf_dir}/persons.parquet"))
    members = groups.groupBy("group_id").agg(F.sort_array(F.collect_list("person_id")).alias("m")).where("size(m) > 1")
    rows = members.select(F.posexplode("m").alias("i", "person_a"), "m").select("person_a", F.explode(F.slice("m", F.col("i") + 2, F.size("m"))).alias("person_b"))
    return rows.select("person_a", "person_b")
