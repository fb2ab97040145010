"""SQL equivalents of the flattening and lineage queries, built from the same lists of names."""
from __future__ import annotations

import unicodedata

from ..functions.folding import CARRIERS
from ..operators.flatten import PERSON_LISTS


def _now(table: str, columns: str) -> str:
    return f"(SELECT {columns} FROM {table} WHERE person_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY person_id ORDER BY ingested_at DESC) = 1)"


def folded(x: str) -> str:
    """The folded spelling in SQL: compatibility forms by a table made from the characters' own properties."""
    single, longer = [], []
    for code in range(0x80, 0x10000):
        char = chr(code)
        if 0xD800 <= code < 0xE000 or not unicodedata.decomposition(char).startswith("<"):
            continue
        plain = unicodedata.normalize("NFKC", char)
        if len(plain) == 1:
            single.append((char, plain.replace("'", "''")))
        elif 0xFEF5 <= code <= 0xFEFC:
            longer.append((char, plain))
    out = f"translate(coalesce({x}, ''), '{''.join(a for a, _ in single)}', '{''.join(b for _, b in single)}')"
    for a, b in longer:
        out = f"replace({out}, '{a}', '{b}')"
    out = f"translate(nfc_normalize({out}), '{''.join(map(chr, CARRIERS))}', '{''.join(CARRIERS.values())}')"
    out = "regexp_replace(" + out + r", '[\x{064b}-\x{0652}\x{0670}\x{0640}]', '', 'g')"
    blanks = r"[\s\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]+"
    return f"lower(trim(regexp_replace({out}, '{blanks}', ' ', 'g')))"


#: White space of the text functions.
BLANKS_SQL = r"[\t\n\v\f\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def squeezed_sql(x: str) -> str:
    return f"trim(regexp_replace({x}, '{BLANKS_SQL}+', ' ', 'g'))"


def flat_sql(x: str) -> str:
    """One line without note markers."""
    marks = r"«\s*[0-9]+\s*»|\[\s*\(\s*[0-9]+\s*\)\s*\]|\(\s*[0-9]+\s*\)"
    bare = squeezed_sql(f"coalesce({x}, '')")
    return squeezed_sql(f"regexp_replace(regexp_replace({bare}, '{marks}', ' ', 'g'), '[«»]', ' ', 'g')")


LINEAGE = f"""
WITH RECURSIVE n AS (SELECT *, array_to_string(list_transform(chain, lambda x: {folded('x')}), chr(31)) AS line,
                            array_to_string(list_transform(chain[2:], lambda x: {folded('x')}), chr(31)) AS tail FROM {_now('nasab', 'person_id, father_id, chain')}),
ids AS (SELECT lower(person_id) AS wanted, min(person_id) AS father FROM n GROUP BY 1),
lines AS (SELECT line, min(person_id) AS father FROM n WHERE len(chain) > 0 GROUP BY 1 HAVING count(*) = 1),
edges AS (SELECT n.person_id, i.father FROM n JOIN ids i ON lower(trim(n.father_id)) = i.wanted WHERE n.father_id IS NOT NULL
          UNION ALL SELECT n.person_id, l.father FROM n JOIN lines l ON n.tail = l.line WHERE n.father_id IS NULL AND len(n.chain) > 1),
up AS (SELECT person_id, father AS node, 1 AS depth FROM edges
       UNION ALL SELECT u.person_id, e.father, u.depth + 1 FROM up u JOIN edges e ON e.person_id = u.node WHERE u.depth <= (SELECT count(*) FROM edges)),
top AS (SELECT person_id, max(depth) AS depth, arg_max(node, depth) AS root FROM up GROUP BY 1)
SELECT person_id, CASE WHEN depth > (SELECT count(*) FROM edges) THEN 'cycle' ELSE root END AS root_id,
       CAST(CASE WHEN depth > (SELECT count(*) FROM edges) THEN -1 ELSE depth END AS INTEGER) AS tree_depth FROM top
"""


def _opened(x: str) -> str:
    return f"(CASE WHEN json_type({x}) = 'VARCHAR' AND json_valid({x} ->> '$') THEN CAST({x} ->> '$' AS JSON) ELSE {x} END)"


def _flat(columns: str = "CAST(x.pos AS INTEGER) AS pos") -> str:
    holders = sorted({p.rsplit(".", 1)[0] for p in PERSON_LISTS if "." in p}, key=lambda p: p.count("."))
    names = {"": "o"} | {h: h.replace(".", "_") for h in holders}
    steps, done = [], "r0"
    for k, h in enumerate(sorted({x for h in holders for x in (h.rsplit(".", 1)[0] if "." in h else h, h)}, key=lambda p: (p.count("."), p)), 1):
        parent, key = ("o", h) if "." not in h else (h.rsplit(".", 1)[0].replace(".", "_"), h.rsplit(".", 1)[1])
        raw = f"json_extract({parent}, '$.{key}')"
        steps.append(f"r{k} AS (SELECT *, {_opened('h')} AS {h.replace('.', '_')} FROM (SELECT * EXCLUDE (h), h FROM (SELECT *, {raw} AS h FROM {done})) )".replace("SELECT * EXCLUDE (h), h FROM", "SELECT * FROM").replace("SELECT *, (CASE", "SELECT * EXCLUDE (h), (CASE"))
        done = f"r{k}"
    lists = " UNION ALL ".join(
        f"SELECT person_id, '{p}' AS coll_path, json_extract({names[p.rsplit('.', 1)[0] if '.' in p else '']}, '$.{p.rsplit('.', 1)[-1]}') AS v FROM {done}" for p in PERSON_LISTS
    )
    items = """CASE WHEN json_type(v) = 'ARRAY' THEN list_transform(range(CAST(json_array_length(v) AS BIGINT)), lambda i: {'pos': i, 'item': json_extract(v, '$[' || i || ']')})
      WHEN json_type(v) = 'OBJECT' AND len(json_keys(v)) > 0 AND len(list_filter(json_keys(v), lambda k: NOT regexp_full_match(k, '[0-9]+'))) = 0
        THEN list_transform(json_keys(v), lambda k: {'pos': CAST(k AS BIGINT), 'item': json_extract(v, '$."' || k || '"')})
      WHEN json_type(v) = 'OBJECT' THEN [{'pos': CAST(0 AS BIGINT), 'item': v}] ELSE [] END"""
    return f"""
WITH j AS (SELECT person_id, CAST(person_json AS JSON) AS h FROM {_now('persons', 'person_id, person_json')} WHERE json_valid(person_json)),
r0 AS (SELECT person_id, {_opened('h')} AS o FROM j), {', '.join(steps)},
l AS ({lists}), v AS (SELECT person_id, coll_path, {_opened('v')} AS v FROM l WHERE v IS NOT NULL),
x AS (SELECT person_id, coll_path, unnest({items}) AS x FROM v)
SELECT person_id, coll_path, {columns} FROM x WHERE json_type(x.item) = 'OBJECT'
"""


def facts_sql(lists: list[str], fields: list[str]) -> str:
    """The objects of these lists with some of their fields as text."""
    columns = ", ".join(["CAST(x.pos AS INTEGER) AS pos", *(f"x.item ->> '$.{f}' AS \"{f}\"" for f in fields)])
    return f"SELECT * FROM ({_flat(columns)}) WHERE coll_path IN ({', '.join(repr(p) for p in lists)})"


DESCENDANTS = LINEAGE[: LINEAGE.rindex("SELECT person_id, CASE")] + "SELECT u.node AS person_id, u.person_id AS descendant_id FROM up u JOIN top t ON u.person_id = t.person_id WHERE t.depth <= (SELECT count(*) FROM edges)"
SQL = {"p6_found": LINEAGE, "p6_descendants": DESCENDANTS, "p4_found": _flat()}
FACT_COUNTS = f"""
WITH f AS ({SQL['p4_found']}), c AS (SELECT coll_path, person_id, count(*) AS n FROM f GROUP BY 1, 2)
SELECT coll_path, CAST(sum(n) AS BIGINT) AS n_facts, count(*) AS n_persons, max(n) AS most FROM c GROUP BY 1
"""
