"""The queries in SQL of another engine, where SQL can state them."""

from __future__ import annotations

from whosaid.llm.chat import CONTROL, END, TEXT, TURN


def _siblings(level: str, parent: str, nodes: str, given: str) -> str:
    """Budgets of one level's nodes, from those of the level above."""
    family = f"PARTITION BY {parent}" if parent else ""
    join = f"JOIN {given} g USING ({parent})" if parent else f", {given} g"
    path = f"{parent}, {level}" if parent else level
    return f"""
    SELECT {path}, (CASE WHEN full_up THEN cap ELSE
        ((given - taken) * w) // heavy END)::BIGINT AS given
    FROM (SELECT *,
        sum(CASE WHEN full_up THEN cap ELSE 0 END) OVER ({family}) AS taken,
        sum(CASE WHEN full_up THEN 0 ELSE w END) OVER ({family}) AS heavy
      FROM (SELECT *, (given - ahead - cap) * w >= cap * behind AS full_up
        FROM (SELECT n.*, g.given,
            coalesce(sum(cap) OVER (rising ROWS BETWEEN UNBOUNDED PRECEDING
              AND 1 PRECEDING), 0) AS ahead,
            coalesce(sum(w) OVER (rising ROWS BETWEEN 1 FOLLOWING
              AND UNBOUNDED FOLLOWING), 0) AS behind
          FROM ({nodes}) n {join}
          WINDOW rising AS ({family} ORDER BY cap::DOUBLE / w::DOUBLE, {level}))))"""


def _nodes(path: str, weight: str) -> str:
    return (
        f"SELECT {path}, sum(cap)::HUGEINT AS cap, max({weight})::HUGEINT AS w "
        f"FROM leaves GROUP BY {path}"
    )


OP10 = f"""
WITH rows AS (
  SELECT doc_id, 'd' || (n % 4) AS domain, coalesce(lang, '') AS lang,
    coalesce(source, '') AS source, 4 - n % 4 AS w_domain,
    CASE WHEN lang = 'en' THEN 5 ELSE 2 END AS w_lang, 1 + n % 3 AS w_source,
    (coalesce(strlen(text), 0) + 3) // 4 AS tokens
  FROM (SELECT *, coalesce(try_cast(regexp_extract(source, '([0-9]+)', 1) AS INT), 0) AS n
    FROM documents)),
leaves AS (
  SELECT domain, lang, source, sum(tokens) AS total, 2 * sum(tokens) AS cap,
    max(w_domain) AS w_domain, max(w_lang) AS w_lang, max(w_source) AS w_source
  FROM rows GROUP BY ALL),
top AS (SELECT least(sum(total), sum(cap))::HUGEINT AS given FROM leaves),
b1 AS ({_siblings("domain", "", _nodes("domain", "w_domain"), "top")}),
b2 AS ({_siblings("lang", "domain", _nodes("domain, lang", "w_lang"), "b1")}),
b3 AS ({_siblings("source", "domain, lang", _nodes("domain, lang, source", "w_source"), "b2")}),
plan AS (
  SELECT b3.*, CASE WHEN total > 0 THEN given // total ELSE 0 END AS whole,
    CASE WHEN total > 0 THEN given % total ELSE given END AS part
  FROM b3 JOIN leaves USING (domain, lang, source)),
placed AS (
  SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source
    ORDER BY md5('1:' || whole || ':' || coalesce(doc_id::VARCHAR, ''))) AS upto
  FROM rows JOIN plan USING (domain, lang, source))
SELECT doc_id, domain, lang, source, tokens::BIGINT AS tokens, given AS budget,
  unnest(range((whole + CASE WHEN part > 0 AND upto <= part THEN 1 ELSE 0 END)::BIGINT)) AS epoch
FROM placed"""

OP9 = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id::VARCHAR AS item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[s:s + 9], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s
    FROM items WHERE len(w) > 0)),
grams AS (
  SELECT doc_id, s, size, array_to_string(w[s:s + size - 1], ' ') AS g
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s
    FROM docs, (SELECT DISTINCT size FROM windows))),
hits AS (SELECT doc_id, s, g.size, item_id FROM grams g JOIN windows USING (size, g)),
words AS (SELECT DISTINCT doc_id, unnest(range(s, s + size)) AS p FROM hits),
counted AS (SELECT doc_id, count(*) AS n FROM words GROUP BY 1),
named AS (SELECT doc_id, count(DISTINCT item_id) AS n,
  array_to_string(list_sort(list(DISTINCT item_id)), ',') AS ids FROM hits GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(c.n, 0)::BIGINT AS n_hit,
  coalesce(i.n, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(c.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN counted c USING (doc_id) LEFT JOIN named i USING (doc_id)"""

OP1 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[s:s + 2], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS s
    FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common >= 90 * (x.n + y.n - common)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM words
  UNION
  SELECT r.a, l.b FROM reach r
  JOIN (SELECT a, b FROM links UNION ALL SELECT b, a FROM links) l ON l.a = r.b)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM words w LEFT JOIN sizes USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1) USING (doc_id)"""

#: A text as the template writes it: doubled escapes, split control strings.
def _escaped(text: str) -> str:
    out = f"replace({text}, chr(92), chr(92) || chr(92))"
    for control in CONTROL:
        out = f"replace({out}, '{control}', '{control[0]}' || chr(92) || '{control[1:]}')"
    return out


OP8 = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
joined AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn, role, text)
      FILTER (WHERE role = 'assistant'), '') AS loss,
    sum(length({_escaped("role")}) + length({_escaped("text")}) + {sum(map(len, (TURN, TEXT, END)))})
      AS formatted
  FROM turns GROUP BY 1)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
  sha256(loss) AS loss_sha256, formatted::BIGINT AS formatted_chars
FROM joined"""

OP13 = r"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id,
    coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents),
windows AS (
  SELECT r, i, array_to_string(w[i:i + 34], ' ') AS passage
  FROM split, unnest(range(1, len(w) - 33)) AS t(i)),
twice AS (SELECT passage FROM windows GROUP BY 1 HAVING count(*) > 1),
covered AS (
  SELECT DISTINCT r, i + k AS i
  FROM windows JOIN twice USING (passage), unnest(range(0, 35)) AS u(k)),
kept AS (
  SELECT r, string_agg(w[i], ' ' ORDER BY i) AS text
  FROM split, unnest(range(1, len(w) + 1)) AS t(i)
  WHERE (r, i) NOT IN (SELECT (r, i) FROM covered)
  GROUP BY 1),
removed AS (SELECT r, count(*) AS n FROM covered GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM split LEFT JOIN removed USING (r) LEFT JOIN kept USING (r)"""

#: The remainders of a CRC-32 by byte, and that of a text of ASCII characters.
CRC_TABLE = """SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS crc"""


def crc32(text: str) -> str:
    return f"""xor(list_reduce(list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT),
        lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"""


def _leaf(text: str) -> str:
    values = ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)
    spelled = (f"coalesce(octet_length(encode({v})) || ':' || {v}, '-')" for v in values)
    return f"sha256({' || '.join(spelled)})"


def _tree(name: str, leaves: str) -> str:
    """All nodes above leaves (tree, slot, total, h), and what is beside each."""
    return f"""{name} AS (
  SELECT tree, 0 AS level, slot, total, h FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, slot // 8, (total + 7) // 8, sha256(string_agg(h, '' ORDER BY slot))
  FROM {name} WHERE total > 1 GROUP BY tree, level, slot // 8, total),
{name}_beside AS (
  SELECT a.tree, a.level, a.slot,
    coalesce(string_agg(b.h, '' ORDER BY b.slot) FILTER (b.slot < a.slot), '') AS l,
    coalesce(string_agg(b.h, '' ORDER BY b.slot) FILTER (b.slot > a.slot), '') AS r
  FROM {name} a JOIN {name} b ON a.tree = b.tree AND a.level = b.level AND a.slot // 8 = b.slot // 8
  WHERE a.total > 1 GROUP BY ALL)"""


def _path(leaves: str, nodes: str) -> str:
    return f"""(SELECT v.tree, v.slot, list({{'l': l, 'r': r}} ORDER BY level) AS path
    FROM {leaves} v JOIN {nodes}_beside n ON v.tree = n.tree AND n.slot = v.slot >> (3 * level)
    GROUP BY 1, 2)"""


OP12 = f"""
WITH RECURSIVE crcs AS ({CRC_TABLE}),
rows AS (
  SELECT doc_id, coalesce('1' || lang, '0') AS tree, {_leaf("text")} AS h,
    CASE WHEN {crc32("doc_id::VARCHAR")} % 3 = 0
      THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
      ELSE {_leaf("text")} END AS changed
  FROM documents, crcs),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS slot,
    count(*) OVER (PARTITION BY tree) AS total
  FROM rows),
{_tree("nodes", "leaves")},
tops AS (
  SELECT '' AS tree, tree AS lang, row_number() OVER (ORDER BY tree) - 1 AS slot,
    count(*) OVER () AS total, h
  FROM nodes WHERE total = 1),
{_tree("upper", "tops")},
paths AS (
  SELECT doc_id, v.h AS leaf, changed, t.h AS subroot,
    coalesce(p.path, []) || coalesce(q.path, []) AS path
  FROM leaves v JOIN tops t ON v.tree = t.lang
  LEFT JOIN {_path("leaves", "nodes")} p ON v.tree = p.tree AND v.slot = p.slot
  LEFT JOIN {_path("tops", "upper")} q ON t.slot = q.slot),
folded AS (
  SELECT doc_id, leaf, subroot, (SELECT h FROM upper WHERE total = 1) AS root,
    sha256(array_to_string(list_transform(path, lambda x: x.l || x.r), '')) AS proof_sha256,
    list_reduce(path, lambda node, x: sha256(x.l || node || x.r), changed) AS folded_root
  FROM paths)
SELECT *, folded_root = root AS verified FROM folded"""

_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _step(state: str, letter: str, cost: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}'}}"


def _least(*found: str) -> str:
    return f"list_min([{', '.join(found)}])"


def _inserts(s: str, then: str) -> str:
    """``then``, with t for the four states s after inserted turns."""
    user = _least(f"{s}[3]", *(_step(f"{s}[{i}]", "I", "5") for i in (1, 2, 4)))
    return f"""list_transform([{user}], lambda u: list_transform([[{s}[1], {s}[2], u,
        {_least(f"{s}[4]", _step("u", "I", "5"))}]], lambda t: {then})[1])[1]"""


def _row(role: str, state: str) -> str:
    """What a row can add to a state that leads to one role: kept, or made so."""
    kept = f"CASE WHEN x.i = '{role}' AND x.p < 9 THEN {_step(state, 'K', 'x.p')} ELSE none END"
    made = f"CASE WHEN x.p < 9 THEN {_step(state, 'R', '1 + x.p')} ELSE none END"
    return f"{kept}, {made}"


_NONE = "{'c': 1000000000000, 'a': ''}"
_KEPT_SYSTEM = f"CASE WHEN x.i = 's' AND x.p < 9 THEN {_step('t[1]', 'K', 'x.p')} ELSE none END"
_ROW = f"""[{_step("t[1]", "D", "2")}, {_least(_step("t[2]", "D", "2"), _KEPT_SYSTEM)},
    {_least(_step("t[3]", "D", "2"), _row("u", "t[1]"), _row("u", "t[2]"), _row("u", "t[4]"))},
    {_least(_step("t[4]", "D", "2"), _row("a", "t[3]"))}]"""
_SEARCH = f"""list_reduce(rows, lambda s, x: {_inserts("s", _ROW)},
    [{{'c': 0::BIGINT, 'a': ''}}, none, none, none])"""

OP11 = f"""
WITH crcs AS ({CRC_TABLE}),
given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind
  FROM conversations, crcs),
damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM given, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END))),
placed AS (
  SELECT *, rtrim(text, {_BLANKS}) AS body,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS n
  FROM damaged),
faults AS (
  SELECT *, CASE WHEN body = '' THEN 'blank'
      WHEN n > min(n) OVER (PARTITION BY conv_id, role, text) THEN 'duplicate'
      WHEN NOT regexp_matches(body, '[.!?]$') THEN 'truncated' ELSE '' END AS fault,
    lag(role) OVER (PARTITION BY conv_id ORDER BY n) AS before
  FROM placed),
listed AS (
  SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before[1] || role[1] NOT IN ('su', 'ua', 'au'))
      AS illegal,
    list({{'i': role[1], 'r': role, 't': text, 'p': CASE WHEN fault IN ('blank', 'duplicate')
      THEN 9 WHEN fault = 'truncated' THEN 5 ELSE 0 END}} ORDER BY n) AS rows
  FROM faults GROUP BY 1),
searched AS (
  SELECT *, list_transform([{_SEARCH}], lambda s: {_inserts("s", _least("t[1]", "t[4]"))})[1] AS best
  FROM listed, (SELECT {_NONE} AS none)),
walked AS (
  SELECT *, list_reduce(string_split(best.a, ''), lambda w, e:
    list_transform([CASE WHEN w.s = 'u' THEN 'assistant' ELSE 'user' END], lambda free: CASE e
      WHEN 'D' THEN {{'k': w.k + 1, 's': w.s, 'o': w.o}}
      WHEN 'I' THEN {{'k': w.k, 's': free[1], 'o': list_append(w.o, free || ':')}}
      WHEN 'K' THEN {{'k': w.k + 1, 's': rows[w.k].i, 'o': list_append(w.o, rows[w.k].r || ':' || rows[w.k].t)}}
      WHEN 'R' THEN {{'k': w.k + 1, 's': free[1], 'o': list_append(w.o, free || ':' || rows[w.k].t)}}
      ELSE w END)[1],
    {{'k': 1, 's': '', 'o': CAST([] AS VARCHAR[])}}).o AS lines
  FROM searched),
ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.a, '') AS audit,
  sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM ids LEFT JOIN walked ON ids.conv_id IS NOT DISTINCT FROM walked.conv_id"""

SQL = {
    "op1_jaccard_join": OP1,
    "op8_chat": OP8,
    "op9_decontaminate": OP9,
    "op10_mixing": OP10,
    "op11_repair": OP11,
    "op12_merkle": OP12,
    "op13_passages": OP13,
}
