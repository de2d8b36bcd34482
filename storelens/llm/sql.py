"""The same results as DuckDB SQL, where SQL can express them."""

import re

from storelens.llm.licenses import PHRASES, TEMPLATES

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP8 = rf"""
WITH d AS (SELECT row_number() OVER () AS u, doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS w FROM documents),
i AS (SELECT row_number() OVER () AS item_no, coalesce(CAST(item_id AS VARCHAR), '') AS item_id,
             regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS g
            FROM i, LATERAL (SELECT unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT k FROM windows),
grams AS (SELECT u, s, k, array_to_string(w[s:s + k - 1], ' ') AS g
          FROM d, sizes, LATERAL (SELECT unnest(range(1, len(w) - k + 2)) AS s)),
found AS (SELECT u, s, k, item_id FROM grams JOIN windows USING (k, g)),
hit AS (SELECT u, count(DISTINCT p) AS n_hit FROM (SELECT u, unnest(range(s, s + k)) AS p FROM found) GROUP BY u),
ids AS (SELECT u, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS l FROM found GROUP BY u)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (u) LEFT JOIN ids USING (u)
"""

_ESCAPED = r"replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '\</turn>')"
_ROLE = "CASE WHEN role IN ('system', 'user', 'assistant') THEN length(role) ELSE length(CAST(to_json(role) AS VARCHAR)) END"

OP2 = rf"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations
           UNION ALL SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '\### Assistant: </turn> ok'),
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS k FROM c)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(4 + {_ROLE} + 2 + length({_ESCAPED}) + 8) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""


def _pattern(template: str) -> str:
    """A licence template as a regular expression over words that are each led by one space."""
    out = []
    for token in re.findall(r"\[\[|\]\]|\{\{\d+\}\}|[()|]|[^\s\[\](){}|]+", template):
        if token.startswith("{{"):
            out.append(f"( [^ ]+){{0,{token[2:-2]}}}")
        else:
            out.append({"[[": "(", "]]": ")?", "(": "(", ")": ")", "|": "|"}.get(token, " " + token))
    return "".join(out) + " "


def _op3() -> str:
    places = "\nUNION ALL ".join(
        f"SELECT u, i - 1 AS i, '{label}' AS label FROM d, LATERAL (SELECT unnest(range(1, len(w) + 1)) AS i) WHERE "
        + " AND ".join(f"w[i + {k}] = '{word}'" for k, word in enumerate(phrase.split()))
        for phrase, label in PHRASES
    )
    accepted = "\nUNION ".join(f"SELECT u, '{label}' AS label FROM d WHERE regexp_matches(s, '{_pattern(t)}')" for label, t in TEMPLATES)
    return f"""
WITH x AS (SELECT row_number() OVER () AS u, doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS w FROM documents),
d AS (SELECT *, ' ' || array_to_string(w, ' ') || ' ' AS s FROM x),
places AS ({places}),
accepted AS ({accepted}),
base AS (SELECT u, count(*) AS n, min(i) AS a, max(i) AS b, string_agg(DISTINCT label, ',' ORDER BY label) AS l FROM places GROUP BY u),
every AS (SELECT u, string_agg(DISTINCT label, ',' ORDER BY label) AS l FROM (SELECT u, label FROM places UNION ALL SELECT u, label FROM accepted) GROUP BY u)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(base.n, 0) AS BIGINT) AS n_base, CAST(a AS BIGINT) AS first_word, CAST(b AS BIGINT) AS last_word,
       coalesce(base.l, '') AS base_labels, coalesce(every.l, '') AS labels,
       CAST(CASE WHEN u IN (SELECT u FROM accepted) THEN 1 WHEN base.l IS NOT NULL THEN 0.5 ELSE 0 END AS DOUBLE) AS score
FROM d LEFT JOIN base USING (u) LEFT JOIN every USING (u)
"""


OP3 = _op3()


#: CRC-32 of decimal digits, over a table of 256 entries made from its polynomial.
_CRC_TABLE = "list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END))"
_CRC = """xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)"""


def _op11(levels: int = 10) -> str:
    """Trees of eight, level by level; ``levels`` hold 8 ** levels rows a language and as many languages."""

    def written(c: str) -> str:
        return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join([*map(written, ("doc_id", "source", "lang", "n_chars")), written(text)]) + ")"

    def tree(name: str, leaves: str) -> str:
        """CTEs name_k(g, pos, m, d): the nodes of level k; and name_run_k(g, run, ds), those with siblings, in runs."""
        out = [f"{name}_0 AS ({leaves})"]
        for k in range(levels):
            out.append(f"{name}_run_{k} AS (SELECT g, pos // 8 AS run, max(m) AS m, list(d ORDER BY pos) AS ds FROM {name}_{k} WHERE m > 1 GROUP BY g, pos // 8)")
            out.append(f"{name}_{k + 1} AS (SELECT g, run AS pos, (m + 7) // 8 AS m, sha256(array_to_string(ds, '')) AS d FROM {name}_run_{k} "
                       f"UNION ALL SELECT * FROM {name}_{k} WHERE m = 1)")  # fmt: skip
        return ",\n".join(out)

    def climb(name: str, first: str) -> str:
        """CTEs up_<name>_k: every row with its digest folded up to level k, and the siblings so far."""
        out, before = [], first
        for k in range(levels):
            i, run = f"b.p // {8**k} % 8 + 1", f"b.p // {8 ** (k + 1)}"
            out.append(
                f"up_{name}_{k} AS (SELECT b.* EXCLUDE (h, proof), "
                f"CASE WHEN r.ds IS NULL THEN b.h ELSE sha256(array_to_string(r.ds[:{i} - 1], '') || b.h || array_to_string(r.ds[{i} + 1:], '')) END AS h, "
                f"CASE WHEN r.ds IS NULL THEN b.proof ELSE b.proof || array_to_string(r.ds[:{i} - 1], '') || array_to_string(r.ds[{i} + 1:], '') END AS proof "
                f"FROM {before} b LEFT JOIN {name}_run_{k} r ON r.g = b.g AND r.run = {run})"
            )
            before = f"up_{name}_{k}"
        return ",\n".join(out)

    return f"""
WITH t AS (SELECT {_CRC_TABLE} AS t),
d AS (SELECT doc_id, coalesce('=' || lang, '') AS g, {leaf("text")} AS leaf, CASE WHEN {_CRC} % 3 = 0 THEN {leaf(_LOWER.format("text"))} END AS later FROM documents, t),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, count(*) OVER (PARTITION BY g) AS m FROM d),
{tree("n", "SELECT g, p AS pos, m, leaf AS d FROM placed")},
subroots AS (SELECT g AS lang_key, d AS subroot, row_number() OVER (ORDER BY g) - 1 AS q, count(*) OVER () AS m FROM n_{levels}),
{tree("s", "SELECT '' AS g, q AS pos, m, subroot AS d FROM subroots")},
start AS (SELECT doc_id, g, p, leaf, coalesce(later, leaf) AS h, '' AS proof FROM placed),
{climb("n", "start")},
middle AS (SELECT u.doc_id, u.leaf, u.h, u.proof, s.subroot, '' AS g, s.q AS p FROM up_n_{levels - 1} u JOIN subroots s ON s.lang_key = u.g),
{climb("s", "middle")}
SELECT doc_id, leaf, subroot, s_{levels}.d AS root, sha256(proof) AS proof_sha256, h AS folded_root, h = s_{levels}.d AS verified
FROM up_s_{levels - 1}, s_{levels}
"""


OP11 = _op11()


OP13 = rf"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS u, doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT u, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
             ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM w),
c AS (SELECT list_sort(s) AS s, min(u) AS c, min(doc_id) AS least FROM s WHERE len(s) > 0 GROUP BY list_sort(s)),
p AS (SELECT c, len(s) AS n, unnest(s) AS x FROM c),
links AS (SELECT a.c AS a, b.c AS b FROM p a JOIN p b ON a.x = b.x AND a.c <> b.c GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach(a, b) AS (SELECT c, c FROM c UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
component AS (SELECT r.a, min(c.least) AS component_id FROM reach r JOIN c ON c.c = r.b GROUP BY r.a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, CASE WHEN len(s.s) = 0 THEN s.doc_id ELSE component_id END AS component_id,
       s.doc_id IS NOT DISTINCT FROM (CASE WHEN len(s.s) = 0 THEN s.doc_id ELSE component_id END) AS kept
FROM s LEFT JOIN c ON c.s = list_sort(s.s) LEFT JOIN component k ON k.a = c.c
"""


def statements() -> dict[str, str]:
    return {"op2_chat": OP2, "op3_licenses": OP3, "op8_decontaminate": OP8, "op11_merkle": OP11, "op13_minhash": OP13}
