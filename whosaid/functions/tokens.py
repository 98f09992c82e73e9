"""Tokens: from text, per-token repairs, and back to text.

All functions take and return columns and stay in the JVM. The patterns use
only what Java's and RE2's regular expressions have in common, so that another
engine can check the results.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from whosaid.functions.binding import bind

# Quotation tags that survive, and the bracket escapes.
KEPT_TAGS = ("<q>", "<blockquote>", "</q>", "</blockquote>")
BRACKETS = {"-LRB-": "(", "-RRB-": ")", "-LSB-": "[", "-RSB-": "]"}

#: The rest of a tag behind its name; a quoted value may hold any character.
TAG_TAIL = r"""(?:[^<>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')|[="'])*+"""
#: A tag, a run of text between tags, or a stray "<".
RUN = rf"</?[A-Za-z]{TAG_TAIL}>|[^<]+|<"

_SPACE = r"\s\x0B\p{Z}"
_WORD = r"[\p{L}\p{N}\p{M}]"

#: Replacements in a run of text, in order: first the entities that HTML
#: cleaning leaves ("&amp;" last), then the typographic characters.
ENTITIES = (
    ("&nbsp;", " "),
    ("&quot;", '"'),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&amp;", "&"),
)
TYPOGRAPHY = (
    ("“", " `` "),
    ("„", " `` "),
    ("‟", " `` "),
    ("«", " `` "),
    ("”", " '' "),
    ("»", " '' "),
    ("…", " ... "),
    ("–", " -- "),
    ("—", " -- "),
    ("‘", "`"),
    ("‚", "`"),
    ("‛", "`"),
    ("’", "'"),
)

#: Rewrites after them, in order: (character that must occur, pattern,
#: replacement with $n groups). They give straight quotes a direction and set
#: contractions apart.
REWRITES = (
    ('"', rf'(^|[{_SPACE}(\[{{`])"', "$1 `` "),
    ('"', '"', " '' "),
    ("'", rf"(^|[{_SPACE}(\[{{])'([^'{_SPACE}])", "$1` $2"),
    ("'", r"(\p{L})([nN]'[tT])([^\p{L}\p{N}\p{M}'-]|$)", "$1 $2$3"),
    (
        "'",
        rf"({_WORD})('(?:[sSmMdD]|[rR][eE]|[vV][eE]|[lL][lL]))"
        r"([^\p{L}\p{N}\p{M}'-]|$)",
        "$1 $2$3",
    ),
)


#: Titles that keep their full stop.
TITLES = "Mr|Mrs|Ms|Dr|Prof|Sen|Rep|Gov|Gen|Col|Lt|Sgt|St|Jr|Sr|vs"


def token_pattern(addresses: bool = True, for_java: bool = False) -> str:
    """The token pattern, as alternatives in order.

    ``addresses`` has web and mail addresses as one token; text without "://"
    and "@" has none, and is faster without. ``for_java`` gives the same tokens:
    repeated groups never backtrack, which Java runs in a loop instead of by
    recursion, so that long chains cannot overflow the stack, and one look at
    the next letter spares most words the list of titles.
    """
    once = "+" if for_java else ""
    title_ahead = "(?=[CDGJLMPRSv])" if for_java else ""
    address = (
        rf'https?://[^{_SPACE}"<>]*[\p{{L}}\p{{N}}/]',
        rf"[\p{{L}}\p{{N}}._%+-]+{once}@[\p{{L}}\p{{N}}-]+"
        rf"(?:\.[\p{{L}}\p{{N}}-]+)+{once}",
    )
    return "|".join(
        (
            *(address if addresses else ()),
            rf"(?:\p{{L}}\.){{2,}}{once}",
            rf"{title_ahead}(?:{TITLES})\.",
            rf"\p{{N}}+(?:[.,:/]\p{{N}}+)+{once}(?:-{_WORD}+)*{once}",
            rf"'?{_WORD}+(?:[-']{_WORD}+)*{once}",
            "``",
            "''",
            r"\.\.\.",
            "--+",
            rf"[^{_SPACE}]",
        )
    )


def replace_literals(text: Column, literals: Sequence[tuple[str, str]]) -> Column:
    for old, new in literals:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def _entities(text: Column) -> Column:
    out = replace_literals(text, ENTITIES)
    return F.when(text.contains("&"), out).otherwise(text)


def _typography(text: Column) -> Column:
    # But for the guillemets, all these characters start with the same two
    # bytes in UTF-8, so that one search tells whether a text has any.
    shared_bytes = F.contains(text.cast("binary"), F.lit(b"\xe2\x80"))
    found = shared_bytes | text.contains("«") | text.contains("»")
    return F.when(found, replace_literals(text, TYPOGRAPHY)).otherwise(text)


def _rewrite(needle: str) -> Callable[[Column], Column]:
    """The rewrites for one character, skipped for text without it."""

    def apply(text: Column) -> Column:
        out = text
        for char, pattern, replacement in REWRITES:
            if char == needle:
                out = F.regexp_replace(out, pattern, replacement)
        return F.when(text.contains(needle), out).otherwise(text)

    return apply


def _run_tokens(text: Column) -> Column:
    for step in (_entities, _typography, _rewrite('"'), _rewrite("'")):
        text = bind(text, step)

    def matches(text: Column, addresses: bool) -> Column:
        pattern = token_pattern(addresses, for_java=True)
        return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def extract(text: Column) -> Column:
        addressed = text.contains("@") | text.contains("://")
        return F.when(addressed, matches(text, True)).otherwise(matches(text, False))

    return bind(text, extract)


def tokenize_raw(text: Column) -> Column:
    """Text to tokens, nothing dropped; a tag is one token.

    Straight and curly double quotes become the directional tokens `` `` `` and
    ``''``. Quotes inside tags are left alone, since tags are split off first.
    """

    def run(piece: Column) -> Column:
        is_tag = piece.startswith("<") & (F.length(piece) > 1)
        return F.when(is_tag, F.array(piece)).otherwise(_run_tokens(piece))

    def tokens(text: Column) -> Column:
        runs = F.regexp_extract_all(text, F.lit(RUN), F.lit(0))
        with_tags = F.flatten(F.transform(runs, run))
        return F.when(text.contains("<"), with_tags).otherwise(_run_tokens(text))

    return bind(text, tokens)


def _dash_parts(token: Column, every_part: bool) -> Column:
    """``a-b`` as ``a``, ``-``, ``b``; trailing dashes make no part."""
    parts = F.split(F.regexp_replace(token, r"-+\z", ""), "-")

    def spell(p: Column) -> Column:
        if every_part:
            pieces = F.flatten(
                F.transform(
                    p,
                    lambda part, i: F.when(i == 0, F.array(part)).otherwise(
                        F.array(F.lit("-"), part)
                    ),
                )
            )
        else:
            pieces = F.array(F.get(p, F.lit(0)), F.lit("-"), F.get(p, F.lit(1)))
        return F.when(F.size(p) > 1, pieces).otherwise(F.array(token))

    return bind(parts, spell)


def _is_odd(token: Column) -> Column:
    return token.startswith("<") | token.contains("-")


def _repaired(tokens: Column, rule: Callable[[Column], Column]) -> Column:
    """The rule for each token; a list without odd ones is left as it is."""

    def apply(tokens: Column) -> Column:
        repaired = F.flatten(F.transform(tokens, rule))
        return F.when(F.exists(tokens, _is_odd), repaired).otherwise(tokens)

    return bind(tokens, apply)


def _repair(mode: str, bracket_only: bool) -> Callable[[Column], Column]:
    if mode not in ("reference", "clean"):
        raise ValueError(f"mode must be 'reference' or 'clean', not {mode!r}")
    every_part = mode == "clean"

    def rule(token: Column) -> Column:
        bracket = F.lit(None).cast("string")
        for escape, char in BRACKETS.items():
            bracket = F.when(token == escape, char).otherwise(bracket)
        if bracket_only:
            bracket_tokens = F.array(bracket)
        else:
            bracket_tokens = F.concat(
                F.array(bracket), _dash_parts(token, every_part)
            )
        return (
            F.when(~_is_odd(token), F.array(token))
            .when(token.isin(*KEPT_TAGS), F.array(token))
            .when(token.startswith("<"), F.array().cast("array<string>"))
            .when(token.isin(*BRACKETS), bracket_tokens)
            .when(F.length(token) > 1, _dash_parts(token, every_part))
            .otherwise(F.array(token))
        )

    return rule


def fix_content(tokens: Column, mode: str = "reference") -> Column:
    """Repair article tokens: brackets, tags, dashes.

    Tags other than <q> and <blockquote> go, and a word with a dash becomes
    three tokens. ``mode="reference"`` keeps two known oddities: a bracket
    escape is also split at its dashes, and only the first two parts of a word
    stay. ``mode="clean"`` has neither. Empty tokens are tokens.
    """
    return _repaired(tokens, _repair(mode, bracket_only=mode == "clean"))


def tokenize(text: Column, mode: str = "reference") -> Column:
    """Text to repaired tokens; a bracket escape becomes its bracket only."""
    return _repaired(tokenize_raw(text), _repair(mode, bracket_only=True))


#: How tokens become text again: quotes first, then the spaces to close, as
#: (pattern, replacement).
CLOSE_QUOTES = (
    ("`` ", '"'),
    ("``", '"'),
    (" ''", '"'),
    ("''", '"'),
    ("` ", "'"),
    ("`", "'"),
)
CLOSE_UP = (
    (" ([nN]'[tT])( |$)", "$1$2"),
    (" ('[a-zA-Z])", "$1"),
    (r" +([,.;:!?%)\]}])", "$1"),
    (r"([(\[{$#]) +", "$1"),
)


def untokenize(tokens: Column) -> Column:
    """Tokens to readable text."""
    text = replace_literals(F.array_join(tokens, " "), CLOSE_QUOTES)
    for pattern, replacement in CLOSE_UP:
        text = F.regexp_replace(text, pattern, replacement)
    return text
