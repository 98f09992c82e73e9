"""The queries of `queries`, stated again in SQL for another engine.

The statements follow the definitions, not the plans: spans come from window
functions over marker rows, tagged content from token rows, and the joins are
the plain ones. Patterns are spelled here once more, by the rules, so that an
error in those of the library shows.
"""

from __future__ import annotations

from whosaid.workloads.adapters import ODD_MARKUP
from whosaid.workloads.queries import FRACTION, PUBLISHERS, SEED


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _replace(expr: str, pattern: str, replacement: str) -> str:
    replacement = replacement.replace("$", "\\")
    return f"regexp_replace({expr}, {text(pattern)}, {text(replacement)}, 'g')"


def _shown(expr: str, name: str) -> str:
    return f"array_to_string({expr}, ' ') AS {name}, len({expr}) AS {name}_size"


def _digested(expr: str, name: str) -> str:
    return f"md5(array_to_string({expr}, ' ')) AS {name}, len({expr}) AS {name}_size"


# Inputs, as in `adapters`.

_MARK = (
    "CASE WHEN ends_with(t, ',') THEN '``' WHEN ends_with(t, '.') THEN '''''' "
    "ELSE t END"
)
QUOTED = f"list_transform(string_split(text, ' '), lambda t: {_MARK})"
ODD = f"""list_transform({QUOTED}, lambda t, i:
    CASE WHEN (i - 1) % 101 = 0 THEN '-LRB-'
         WHEN (i - 1) % 103 = 0 THEN '<p>'
         WHEN (i - 1) % 107 = 0 THEN '<q>'
         WHEN (i - 1) % 109 = 0 THEN '</q>'
         WHEN (i - 1) % 17 = 0 THEN t || '-' || t
         WHEN (i - 1) % 19 = 0 THEN t || '-x-y'
         WHEN (i - 1) % 23 = 0 THEN t || '--'
         ELSE t END)"""

ARTICLES = f"""articles AS (
    SELECT CAST(doc_id AS VARCHAR) AS articleUID, {QUOTED} AS content
    FROM documents)"""

ATTRIBUTIONS = """occurrences AS (
    SELECT 'conversation ' || conv_id AS canonicalQuotation,
           CASE WHEN k = 1 THEN CAST(conv_id * 7 + turn AS VARCHAR)
                WHEN turn = 0 THEN 'unknown-' || conv_id
                ELSE CAST(conv_id * 3 + turn AS VARCHAR) END AS articleUID,
           text AS quotation,
           CASE WHEN k = 1 THEN role ELSE 'repeat' END AS extractedBy,
           CAST((turn + 1) / CASE WHEN k = 1 THEN 10.0 ELSE 20.0 END AS DOUBLE)
               AS patternConfidence,
           role || '_' || conv_id AS speaker
    FROM conversations, (VALUES (1), (2)) AS copies(k)
    WHERE role <> 'system')"""

MAPPING = """mapping AS (
    SELECT conv_id * 13 + turn // 4 AS articleUID,
           'conversation ' || conv_id AS canonicalQuotationDestination,
           CAST((turn + 1) / 10.0 AS DOUBLE) AS confidence,
           text AS canonicalQuotationSource
    FROM conversations)"""


# Text functions, as expressions.

_SPACE = r"\s\x0B\p{Z}"
_LETTERS = r"[\p{L}\p{N}\p{M}]"
#: Entities, then typographic characters, in the order in which they are read:
#: (pattern, what it becomes).
_READ = (
    ("&nbsp;", " "), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"),
    ("[“„‟«]", " `` "), ("[”»]", " '' "), ("…", " ... "), ("[–—]", " -- "),
    ("[‘‚‛]", "`"), ("’", "'"),
)
#: A straight double quote opens at the start and after space or brackets, and
#: closes elsewhere; a single one opens there before a letter; contractions are
#: set apart.
_QUOTES = (
    (rf'(^|[{_SPACE}([{{`])"', "$1 `` "),
    ('"', " '' "),
    (rf"(^|[{_SPACE}([{{])'([^'{_SPACE}])", "$1` $2"),
    (r"(\p{L})([nN]'[tT])([^\p{L}\p{N}\p{M}'-]|$)", "$1 $2$3"),
    (
        rf"({_LETTERS})('(?i:s|m|d|re|ve|ll))([^\p{{L}}\p{{N}}\p{{M}}'-]|$)",
        "$1 $2$3",
    ),
)
#: Tokens: web and mail addresses, initials, titles, numbers, words with inner
#: dashes and apostrophes, quotes, dots, dashes, and any other character.
_TOKEN = "|".join(
    (
        rf'https?://[^{_SPACE}"<>]*[\p{{L}}\p{{N}}/]',
        r"[\p{L}\p{N}._%+-]+@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)+",
        r"(?:\p{L}\.){2,}",
        r"(?:Mrs?|Ms|Dr|Prof|Sen|Rep|Gov|Gen|Col|Lt|Sgt|St|[JS]r|vs)\.",
        rf"\p{{N}}+(?:[.,:/]\p{{N}}+)+(?:-{_LETTERS}+)*",
        rf"'?{_LETTERS}+(?:['-]{_LETTERS}+)*",
        "``|''",
        r"\.{3}|-{2,}",
        rf"[^{_SPACE}]",
    )
)
_PIECES = r"""</?[a-zA-Z](?:[^<>"'=]|=\s*"[^"]*"|=\s*'[^']*'|=|["'])*>|[^<]+|<"""


def tokens_raw(expr: str) -> str:
    run = "r"
    for pattern, replacement in (*_READ, *_QUOTES):
        run = _replace(run, pattern, replacement)
    return f"""flatten(list_transform(regexp_extract_all({expr}, {text(_PIECES)}),
        lambda r: CASE WHEN starts_with(r, '<') AND length(r) > 1 THEN [r]
                       ELSE regexp_extract_all({run}, {text(_TOKEN)}) END))"""


def repaired(expr: str, bracket: str, every_part: bool = False) -> str:
    """``bracket``: "only" its character, or "then split" as well."""
    parts = "string_split(regexp_replace(t, '-+\\z', ''), '-')"
    if every_part:
        dashed = (
            f"flatten(list_transform({parts}, lambda p, i: "
            "CASE WHEN i = 1 THEN [p] ELSE ['-', p] END))"
        )
    else:
        dashed = f"[{parts}[1], '-', {parts}[2]]"
    split = f"CASE WHEN len({parts}) > 1 THEN {dashed} ELSE [t] END"
    char = (
        "CASE t WHEN '-LRB-' THEN '(' WHEN '-RRB-' THEN ')' "
        "WHEN '-LSB-' THEN '[' WHEN '-RSB-' THEN ']' END"
    )
    escaped = f"[{char}]" if bracket == "only" else f"[{char}] || ({split})"
    return f"""flatten(list_transform({expr}, lambda t: CASE
        WHEN t IN ('-LRB-', '-RRB-', '-LSB-', '-RSB-') THEN {escaped}
        WHEN t IN ('<q>', '</q>', '<blockquote>', '</blockquote>') THEN [t]
        WHEN starts_with(t, '<') THEN CAST([] AS VARCHAR[])
        WHEN contains(t, '-') AND length(t) > 1 THEN {split}
        ELSE [t] END))"""


def fixed(expr: str) -> str:
    return repaired(expr, "then split")


def tokenized(expr: str) -> str:
    return repaired(tokens_raw(expr), "only")


# Cleaning, stated by its own patterns; of named entities it has those that the
# pages use.

#: What stands in a tag behind its name, and the pieces of a page: parts without
#: text, tags, runs of text, and a lone "<".
_IN_TAG = r"""(?:[^<>"'=]|=\s*"[^"]*"|=\s*'[^']*'|=|["'])*"""
_PARTS = "|".join(
    (
        rf"(?is)<head(?:[^a-z<>]{_IN_TAG})?>.*?</head\s*>",
        *(
            rf"<{t}(?:[^a-z<>]{_IN_TAG})?>.*?(?:</{t}\s*>|\z)"
            for t in ("script", "style", "title")
        ),
        r"<!--.*?(?:-->|\z)",
        r"<[!?][^>]*(?:>|\z)",
        rf"</?[a-z]{_IN_TAG}>|[^<]+|<",
    )
)
# Which elements nest how; only those that the pages and the odd markup have.
_BOUNDS = "button caption table td th".split()
_BLOCK_NAMES = (
    "article aside blockquote div dl dd dt footer form h1 h2 h3 h4 h5 h6 header li main "
    "nav ol p pre section tr ul"
).split() + _BOUNDS
_INLINE_NAMES = "a b cite em i q small span strong u".split()
_END_P = [n for n in _BLOCK_NAMES if n not in ("button", "caption", "td", "th", "tr")]
_NAMES = {
    "amp": "&", "lt": "<", "gt": ">", "quot": '"', "nbsp": "\xa0", "copy": "©",
    "middot": "·", "eacute": "é",
}
_KEPT = "a blockquote br caption cite h1 h2 h3 h4 h5 h6 p q".split()


def _list(values) -> str:
    return ", ".join(map(text, values))


def _entities_read(expr: str) -> str:
    open_names = "|".join(n for n in _NAMES if n not in ("eacute",))
    cut = rf"&#[xX][0-9A-Fa-f]+;?|&#[0-9]+;?|&[a-zA-Z0-9]+;|&(?:{open_names})|[^&]+|&"
    name = "regexp_extract(e, '^&([a-zA-Z0-9]+);?$', 1)"
    named = " ".join(f"WHEN {text(n)} THEN {text(c)}" for n, c in _NAMES.items())
    return f"""array_to_string(list_transform(regexp_extract_all({expr}, {text(cut)}),
        lambda e: CASE
          WHEN regexp_matches(e, '^&#[xX]')
            THEN chr(CAST('0x' || rtrim(regexp_extract(e, '[0-9A-Fa-f]+;?$'), ';') AS INT))
          WHEN regexp_matches(e, '^&#') THEN chr(CAST(regexp_extract(e, '[0-9]+') AS INT))
          WHEN starts_with(e, '&') THEN CASE {name} {named} ELSE e END
          ELSE e END), '')"""


def _swapped(expr: str, *pairs: tuple[str, str]) -> str:
    for old, new in pairs:
        expr = f"replace({expr}, {text(old)}, {text(new)})"
    return expr


def _link(value: str) -> str:
    """A link against the base ``url``, http://host/folder/page in all pages."""
    host = "regexp_extract(url, '^https?://[^/]+')"
    folder = "regexp_extract(url, '^https?://[^/]+(/[^?#]*/)', 1)"
    path = f"{host} || regexp_replace(regexp_replace(regexp_replace({folder} || {value}, "
    path += "'/\\./', '/', 'g'), '/[^/]+/\\.\\./', '/'), '^/\\.\\./', '/')"
    return f"""CASE WHEN regexp_matches({value}, '^[a-zA-Z]+:') THEN {value}
        WHEN starts_with({value}, '//') THEN regexp_extract(url, '^[a-z]+:') || {value}
        WHEN starts_with({value}, '/') THEN {host} || {value}
        WHEN starts_with({value}, '#') THEN regexp_replace(url, '#.*', '') || {value}
        ELSE {path} END"""


def _html_cleaned(html: str) -> str:
    """The cleaned markup of an expression, next to a column ``url``."""
    escaped = _swapped(
        _entities_read("r"), ("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\xa0", "&nbsp;")
    )
    name = "lower(regexp_extract(r, '^</?([A-Za-z][A-Za-z0-9]*)', 1))"
    value = "regexp_replace(m, '^[^=]*=\\s*[\"'']?|[\"'']$', '', 'g')"
    key = "lower(regexp_extract(m, '^[a-zA-Z]+'))"
    read = _entities_read(value)
    quoted = ("&", "&amp;"), ('"', "&quot;")
    link = _link("v")
    # Each attribute as (key, value read, link resolved).
    attributes = f"""array_to_string(list_transform(list_transform(list_transform(
        regexp_extract_all(r, '[a-zA-Z]+\\s*=\\s*(?:"[^"]*"|''[^'']*''|[^\\s"''<>]+)'),
        lambda m: {{'k': {key}, 'v': {read}}}),
        lambda p: list_transform([p.v], lambda v: {{'k': p.k, 'v': v, 'l': {link}}})[1]),
        lambda p: CASE
          WHEN {name} = 'a' AND p.k IN ('title', 'target', 'rel')
            THEN ' ' || p.k || '="' || {_swapped("p.v", *quoted)} || '"'
          WHEN {name} = 'a' AND p.k = 'href' AND regexp_matches(p.l, '^(?i)(ftp|https?|mailto):')
            OR {name} IN ('q', 'blockquote') AND p.k = 'cite' AND regexp_matches(p.l, '^(?i)https?:')
            THEN ' ' || p.k || '="' || {_swapped("p.l", *quoted)} || '"'
          ELSE '' END), '')"""
    # Each piece as its text in the output, the element's name if it nests, and
    # whether it is an end tag.
    pieces = f"""list_transform(
        regexp_extract_all({html}, {text(_PARTS)}),
        lambda r: CASE
          WHEN NOT (starts_with(r, '<') AND length(r) > 1)
            THEN {{'t': {escaped}, 'n': '', 'e': false}}
          ELSE {{'t': CASE WHEN {name} NOT IN ({_list(_KEPT)}) THEN ''
                          WHEN {name} = 'br' THEN '<br>'
                          ELSE '<' || {name} || {attributes} || '>' END,
                'n': CASE WHEN {name} IN ({_list(_BLOCK_NAMES + _INLINE_NAMES)})
                          THEN {name} ELSE '' END,
                'e': starts_with(r, '</')}} END)"""
    return _nested(pieces)


def _nested(pieces: str) -> str:
    """The pieces as one text in which each open element is closed: a list of open
    names, the innermost first, goes along the page."""

    def ends(names: str) -> str:
        return (
            f"array_to_string(list_transform({names}, lambda n: CASE WHEN n IN "
            f"({_list(_KEPT)}) THEN '</' || n || '>' ELSE '' END), '')"
        )

    def depth(stack: str, wanted: str, walls: str) -> str:
        """How far down the first wanted name is, 0 if a wall is nearer."""
        found = f"coalesce(list_position(list_transform({stack}, lambda n: {wanted}), true), 0)"
        wall = f"list_position(list_transform({stack}[:{found} - 1], lambda n: {walls}), true)"
        return f"CASE WHEN {found} > 0 AND coalesce({wall}, 0) = 0 THEN {found} ELSE 0 END"

    def one_of(names) -> str:
        return f"n IN ({_list(names)})"

    item = depth("s.o", "n = 'li'", one_of([*_BOUNDS, "ul", "ol"]))
    cell = depth("s.o", one_of(("td", "th", "caption")), "n = 'table'")
    row = depth("s.o", one_of(("tr", "caption")), "n = 'table'")
    term = depth("s.o", one_of(("dd", "dt")), one_of([*_BOUNDS, "dl"]))
    link = depth("s.o", "n = 'a'", one_of(_BLOCK_NAMES))
    own = (
        f"CASE WHEN p.n = 'li' THEN {item} WHEN p.n IN ('td', 'th') THEN {cell} "
        f"WHEN p.n = 'tr' THEN {row} WHEN p.n IN ('dd', 'dt') THEN {term} "
        f"WHEN p.n = 'a' THEN {link} ELSE 0 END"
    )
    paragraph = (
        f"k + CASE WHEN p.n IN ({_list(_END_P)}) "
        f"THEN {depth('s.o[k + 1:]', one_of(['p']), one_of(_BOUNDS))} ELSE 0 END"
    )
    heads = "('h1', 'h2', 'h3', 'h4', 'h5', 'h6')"
    heading = f"k + CASE WHEN p.n IN {heads} AND s.o[k + 1] IN {heads} THEN 1 ELSE 0 END"
    started = (
        f"list_transform(list_transform(list_transform([{own}], lambda k: {paragraph}), "
        f"lambda k: {heading}), lambda k: {{'x': s.x || {ends('s.o[:k]')} || p.t, "
        "'o': [p.n] || s.o[k + 1:]})[1]"
    )
    in_table = "('td', 'th', 'tr', 'caption')"
    at_end = f"""CASE
        WHEN p.n IN {in_table} THEN {depth("s.o", "n = p.n", "n = 'table'")}
        WHEN p.n IN {heads} THEN {depth("s.o", f"n IN {heads}", one_of(_BOUNDS))}
        WHEN p.n = 'li' THEN {depth("s.o", "n = 'li'", one_of([*_BOUNDS, "ol", "ul"]))}
        WHEN p.n = 'table' THEN {depth("s.o", "n = 'table'", "false")}
        WHEN p.n IN ({_list([*_BLOCK_NAMES, "a"])})
          THEN {depth("s.o", "n = p.n", one_of(_BOUNDS))}
        ELSE {depth("s.o", "n = p.n", one_of(_BLOCK_NAMES))} END"""
    ended = (
        f"list_transform([{at_end}], lambda k: {{'x': s.x || {ends('s.o[:k]')}, "
        "'o': s.o[k + 1:]})[1]"
    )
    walked = f"""list_reduce({pieces}, lambda s, p: CASE
        WHEN p.n = '' THEN {{'x': s.x || p.t, 'o': s.o}}
        WHEN p.e THEN {ended}
        ELSE {started} END, {{'x': '', 'o': CAST([] AS VARCHAR[])}})"""
    return f"list_transform([{walked}], lambda s: s.x || {ends('s.o')})[1]"


_ODD = " ".join(f"WHEN {i} THEN {text(m)}" for i, m in enumerate(ODD_MARKUP))
ODD_PAGES = f"(SELECT page_id, url, html || CASE page_id % {len(ODD_MARKUP)} {_ODD} END AS html FROM pages)"


# Relations.


def token_rows(articles: str, content: str) -> str:
    """``tokens(id, pos, tok)``, with positions from 0, from CTE ``articles``."""
    return f"""lists AS MATERIALIZED (
        SELECT articleUID AS id, {content} AS list FROM {articles}),
    tokens AS MATERIALIZED (
        SELECT id, unnest(list) AS tok,
               unnest(range(len(list))) AS pos FROM lists)"""


SPANS = """marks AS (
        SELECT id, pos, tok IN ('``', '<q>', '<blockquote>') AS opens
        FROM tokens
        WHERE tok IN ('``', '<q>', '<blockquote>',
                      '''''', '</q>', '</blockquote>')),
    pairs AS (
        SELECT id, opens, pos,
               lag(opens) OVER w AS before_opens, lag(pos) OVER w AS before_pos
        FROM marks WINDOW w AS (PARTITION BY id ORDER BY pos)),
    spans AS MATERIALIZED (
        SELECT id, before_pos AS s, pos AS e FROM pairs
        WHERE NOT opens AND before_opens
          AND pos - before_pos >= 8 AND pos - before_pos < 100)"""

TAGGED = """roles AS (
        SELECT t.id, t.pos, t.tok, p.s
        FROM tokens t LEFT JOIN spans p
          ON t.id = p.id AND t.pos BETWEEN p.s AND p.e),
    outline AS MATERIALIZED (
        SELECT id, pos, tok, s FROM roles WHERE s IS NULL OR pos = s),
    contents AS (
        SELECT p.id, p.s,
               string_agg(CASE WHEN o.s IS NULL THEN o.tok
                               WHEN o.s = p.s THEN '<INPUT_QUOTATION>'
                               ELSE '<QUOTATION>' END, ' ' ORDER BY o.pos)
                   AS content,
               count(*) AS content_size
        FROM spans p JOIN outline o ON o.id = p.id GROUP BY p.id, p.s),
    inner_texts AS (
        SELECT p.id, p.s, string_agg(t.tok, ' ' ORDER BY t.pos) AS quotation,
               count(*) AS quotation_size
        FROM spans p JOIN tokens t
          ON t.id = p.id AND t.pos > p.s AND t.pos < p.e GROUP BY p.id, p.s)
    SELECT c.id AS articleUID, md5(content) AS content, content_size,
           quotation, quotation_size
    FROM contents c JOIN inner_texts q ON c.id = q.id AND c.s = q.s"""


def tagged(articles: str) -> str:
    rows = token_rows("articles", fixed("content"))
    return f"WITH {articles}, {rows}, {SPANS}, {TAGGED}"


_IN = ", ".join(text(p) for p in PUBLISHERS)


def _sampled(key: str, fraction: float) -> str:
    return (
        f"CAST('0x' || substr(md5('{SEED}:' || {key}), 1, 8) AS BIGINT) "
        f"< {int(fraction * 2**32)}"
    )


_ODD_ARTICLES = f"""articles AS (
    SELECT CAST(doc_id AS VARCHAR) AS articleUID, {ODD} AS content
    FROM documents)"""
_SAMPLED_ARTICLES = f"""articles AS (
    SELECT CAST(doc_id AS VARCHAR) AS articleUID, {QUOTED} AS content
    FROM documents WHERE {_sampled("doc_id", FRACTION)})"""

# Ingested records: Spanish ones have no extract, German ones one that is not
# read.
_INGESTED = f"""SELECT source AS publisher,
        CAST(doc_id AS VARCHAR) AS feed_id,
        CAST(doc_id * 2 + 1 AS VARCHAR) AS permalink_id,
        {tokens_raw("text")} AS feed,
        CASE lang WHEN 'es' THEN CAST([] AS VARCHAR[])
                  WHEN 'de' THEN CAST([] AS VARCHAR[])
                  ELSE {tokens_raw("text")} END AS permalink
    FROM documents"""
_INGESTED_COLUMNS = f"""publisher, feed_id, {_digested("feed", "feed_content")},
    permalink_id, {_digested("permalink", "permalink_content")}"""

_MAP_ROWS = f"""{ARTICLES}, {ATTRIBUTIONS}, {MAPPING},
    numbered AS (
        SELECT TRY_CAST(articleUID AS BIGINT) AS uid, content FROM articles),
    pairs AS (
        SELECT m.articleUID AS uid, o.speaker, m.canonicalQuotationSource AS quote,
               max(m.confidence) AS confidence
        FROM numbered a
        JOIN mapping m ON m.articleUID = a.uid
        JOIN occurrences o
          ON o.canonicalQuotation = m.canonicalQuotationDestination
        GROUP BY ALL)"""

_ARTICLE_TEXTS = (
    f"WITH {ARTICLES} SELECT articleUID, {_shown('content', 'content')} FROM articles"
)


def _tokens_query(expr: str, table: str = "documents", key: str = "doc_id") -> str:
    return (
        f"SELECT {key}, {_shown('tokens', 'tokens')} "
        f"FROM (SELECT {key}, {expr} AS tokens FROM {table})"
    )


def _body_columns(record: str, identifier: str, content: str) -> str:
    """An ingested body, untokenized: one token with the whole text, or none."""
    return f"""CAST({identifier} AS VARCHAR) AS {record}_identifier,
        'http://news.example/' || doc_id AS {record}_url, '' AS {record}_title,
        CASE WHEN lang = 'es' THEN '' ELSE lang END AS {record}_language,
        CASE WHEN lang = 'de' THEN '' ELSE source END AS {record}_authorName,
        CASE WHEN lang = 'de' THEN '' ELSE source || '@news.example' END
            AS {record}_authorEmail,
        '' AS {record}_lastPublished, '' AS {record}_dateFound,
        {content}"""


_NORMALIZED = f"""SELECT
    'http://news.example/' || doc_id AS source_url, source AS source_title,
    CASE WHEN lang = 'es' THEN '' ELSE lang END AS source_language,
    '' AS source_description, '' AS source_lastPosted,
    '' AS source_lastPublished, '' AS source_dateFound,
    source AS source_publisherType,
    'http://news.example/' || doc_id AS feed_url, '' AS feed_title,
    CASE WHEN lang = 'es' THEN '' ELSE lang END AS feed_language,
    '' AS feed_lastPosted, '' AS feed_lastPublished, '' AS feed_dateFound,
    'http://news.example/' || doc_id AS feed_channelUrl,
    {_body_columns("feedEntry", "doc_id",
        "text AS feedEntry_content, CAST(1 AS BIGINT) AS feedEntry_content_size")},
    {_body_columns("permalinkEntry", "doc_id * 2 + 1",
        "CASE WHEN lang IN ('es', 'de') THEN '' ELSE text END "
        "AS permalinkEntry_content, "
        "CAST(CASE WHEN lang = 'es' THEN 0 ELSE 1 END AS BIGINT) "
        "AS permalinkEntry_content_size")}
FROM documents"""

#: Tokens as text again: quotes lose their inner space, then contractions, stops
#: and brackets theirs.
_RESTORED = f"array_to_string({tokens_raw('text')}, ' ')"
for _pattern, _replacement in (
    ("`` ?", '"'),
    (" ?''", '"'),
    ("` ?", "'"),
    (" ([nN]'[tT])( |$)", "$1$2"),
    (" ('[a-zA-Z])", "$1"),
    (r" +([,.;:!?%)\]}])", "$1"),
    (r"([(\[{$#]) +", "$1"),
):
    _RESTORED = _replace(_RESTORED, _pattern, _replacement)

_QUOTED_HTML = "replace(replace(html, '<b>', '<q>'), '<br>', '</q>')"

_NONE = ", ".join(f"'' AS {{0}}_{f}" for f in ("title", "authorName", "authorEmail", "lastPublished", "dateFound"))
_ENTRIES = f"""SELECT
    'http://news.example/' || doc_id AS source_url, '' AS source_title,
    lang AS source_language, '' AS source_description, '' AS source_lastPosted,
    '' AS source_lastPublished, '' AS source_dateFound,
    source AS source_publisherType,
    'http://news.example/' || doc_id AS feed_url, '' AS feed_title,
    lang AS feed_language, '' AS feed_lastPosted, '' AS feed_lastPublished,
    '' AS feed_dateFound, '' AS feed_channelUrl,
    CAST(doc_id AS VARCHAR) AS feedEntry_identifier,
    'http://news.example/' || doc_id AS feedEntry_url,
    lang AS feedEntry_language, {_NONE.format("feedEntry")},
    text AS feedEntry_content, CAST(1 AS BIGINT) AS feedEntry_content_size,
    CAST(doc_id * 2 + 1 AS VARCHAR) AS permalinkEntry_identifier,
    'http://news.example/' || doc_id AS permalinkEntry_url,
    lang AS permalinkEntry_language, {_NONE.format("permalinkEntry")},
    {_shown(QUOTED, "permalinkEntry_content")}
FROM documents"""

ORACLES: dict[str, str] = {
    "tag_corpus": tagged(ARTICLES),
    "tag_corpus_odd_tokens": tagged(_ODD_ARTICLES),
    "tag_corpus_sample": tagged(_SAMPLED_ARTICLES),
    "extract_articles": f"""WITH {ARTICLES}, {ATTRIBUTIONS},
        joined AS (
            SELECT articleUID, extractedBy, patternConfidence, speaker,
                   {fixed("content")} AS content,
                   {tokenized("quotation")} AS quotation
            FROM articles JOIN occurrences USING (articleUID))
        SELECT articleUID, extractedBy, patternConfidence, speaker,
               {_digested("content", "content")}, {_shown("quotation", "quotation")}
        FROM joined""",
    "map_discarded": f"""WITH {_MAP_ROWS},
        joined AS (
            SELECT uid, confidence, speaker, {fixed("content")} AS content,
                   {tokenized("quote")} AS quotation
            FROM pairs JOIN numbered USING (uid))
        SELECT uid AS articleUID, confidence, speaker,
               {_digested("content", "content")}, {_shown("quotation", "quotation")}
        FROM joined""",
    "ingest_entries": f"SELECT {_INGESTED_COLUMNS} FROM ({_INGESTED})",
    "ingest_entries_filtered": f"""SELECT {_INGESTED_COLUMNS}
        FROM ({_INGESTED} WHERE source IN ({_IN}))""",
    "ingest_entries_sampled": f"""SELECT {_INGESTED_COLUMNS}
        FROM ({_INGESTED} WHERE {_sampled("doc_id", FRACTION)})""",
    "ingest_html": f"""SELECT {_INGESTED_COLUMNS} FROM (
        SELECT 'web' AS publisher, CAST(page_id AS VARCHAR) AS feed_id,
               CAST(page_id * 2 + 1 AS VARCHAR) AS permalink_id,
               {tokens_raw(_html_cleaned("html"))} AS feed,
               {tokens_raw(_html_cleaned(_QUOTED_HTML))} AS permalink FROM {ODD_PAGES})""",
    "ingest_entries_distinct": f"""SELECT {_INGESTED_COLUMNS} FROM ({_INGESTED})
        QUALIFY row_number() OVER (
            PARTITION BY permalink ORDER BY CAST(permalink_id AS BIGINT)) = 1""",
    "ingest_archives": f"SELECT {_INGESTED_COLUMNS} FROM ({_INGESTED})",
    "scan_articles": _ARTICLE_TEXTS,
    "scan_attributions": f"WITH {ATTRIBUTIONS} SELECT * FROM occurrences",
    "scan_mapping": f"WITH {MAPPING} SELECT * FROM mapping",
    "scan_attributions_quoted": f"WITH {ATTRIBUTIONS} SELECT * FROM occurrences",
    "scan_mapping_quoted": f"WITH {MAPPING} SELECT * FROM mapping",
    "scan_articles_kept": f"""SELECT * FROM ({_ARTICLE_TEXTS})
        UNION ALL SELECT 'corrupt', '', count_if(doc_id % 7 = 3) FROM documents""",
    "scan_mapping_kept": f"""WITH {MAPPING} SELECT * FROM mapping
        UNION ALL SELECT count_if(articleUID % 5 = 2), 'corrupt', 0, '' FROM mapping""",
    "scan_archives": "SELECT doc_id, text FROM documents",
    "inflate_content": "SELECT doc_id, CASE WHEN lang = 'fr' THEN '' ELSE text END "
    "AS text FROM documents",
    "write_parquet": _ARTICLE_TEXTS,
    "write_json": _ENTRIES,
    "write_json_gzip": _ARTICLE_TEXTS,
    "write_json_lz4": _ARTICLE_TEXTS,
    "write_json_bzip2": _ARTICLE_TEXTS,
    "write_json_snappy": _ARTICLE_TEXTS,
    "write_json_single_file": "SELECT lang, source, count(*) AS documents "
    "FROM documents GROUP BY lang, source",
    "repartition_rows": "SELECT doc_id, text FROM documents",
    "project_articles": _ARTICLE_TEXTS,
    "normalize_entries": _NORMALIZED,
    "cast_id": f"""WITH {ATTRIBUTIONS} SELECT articleUID,
        TRY_CAST(articleUID AS BIGINT) AS number, extractedBy FROM occurrences""",
    "filter_publisher": f"""SELECT CAST(doc_id AS VARCHAR) AS articleUID,
        source AS publisher FROM documents WHERE source IN ({_IN})""",
    "sample_rows": f"""SELECT doc_id, text FROM documents
        WHERE {_sampled("doc_id", FRACTION)}""",
    "explode_occurrences": f"WITH {ATTRIBUTIONS} SELECT * FROM occurrences",
    "explode_quotations": f"""WITH {ARTICLES},
        {token_rows("articles", fixed("content"))}, {SPANS}
        SELECT id AS articleUID, s AS start, e AS "end",
               count(*) OVER (PARTITION BY id) AS spans FROM spans""",
    "join_articles": f"""WITH {ARTICLES}, {ATTRIBUTIONS}
        SELECT articleUID, speaker, extractedBy, patternConfidence, quotation,
               {_digested("content", "content")}
        FROM articles JOIN occurrences USING (articleUID)""",
    "join_mapping": f"""WITH {ARTICLES}, {MAPPING}
        SELECT m.articleUID, canonicalQuotationDestination,
               canonicalQuotationSource, confidence, {_digested("content", "content")}
        FROM articles a JOIN mapping m
          ON m.articleUID = TRY_CAST(a.articleUID AS BIGINT)""",
    "join_speakers": f"""WITH {ARTICLES}, {ATTRIBUTIONS}, {MAPPING}
        SELECT m.articleUID, speaker, canonicalQuotation, canonicalQuotationSource,
               confidence, o.articleUID AS seen_in, extractedBy,
               {_digested("content", "content")}
        FROM occurrences o
        JOIN mapping m ON o.canonicalQuotation = m.canonicalQuotationDestination
        JOIN articles a ON m.articleUID = TRY_CAST(a.articleUID AS BIGINT)""",
    "dedupe_pairs": f"""WITH {_MAP_ROWS}
        SELECT uid AS articleUID, speaker, quote AS quotation, confidence,
               {_digested("content", "content")}
        FROM pairs JOIN numbered USING (uid)""",
    "dedupe_content": f"""SELECT CAST(min(doc_id * 2 + 1) AS VARCHAR) AS identifier,
        {_shown("content", "content")}
        FROM (SELECT doc_id, {QUOTED} AS content FROM documents) GROUP BY content""",
    "run_metrics": """SELECT count(*) AS documents,
        count_if(lang = 'de') AS unread FROM documents""",
    "committed_rows": """SELECT 'json' AS form, count(*) AS documents FROM documents
        UNION ALL SELECT 'parquet', count_if(source <> 'src0') FROM documents""",
    "tokenize_raw": _tokens_query(tokens_raw("text")),
    "tokenize": _tokens_query(tokenized("text")),
    "fix_content": _tokens_query(fixed(ODD)),
    "fix_content_clean": _tokens_query(repaired(ODD, "only", every_part=True)),
    "find_quotations": f"""WITH {ARTICLES}, {token_rows("articles", "content")}, {SPANS}
        SELECT id AS articleUID, s AS start, e AS "end" FROM spans""",
    "tag_quotation": tagged(ARTICLES),
    "clean_html": f"SELECT page_id, {_html_cleaned('html')} AS html FROM {ODD_PAGES}",
    "clean_html_tokens": _tokens_query(
        fixed(tokens_raw(_html_cleaned("html"))), ODD_PAGES, "page_id"
    ),
    "html_tokens": _tokens_query(
        fixed(tokens_raw(_html_cleaned(_QUOTED_HTML))), ODD_PAGES, "page_id"
    ),
    "untokenize": f"SELECT doc_id, {_RESTORED} AS text FROM documents",
}
