"""HTML to clean HTML, and HTML to tokens, as column expressions.

A page is cut into tags and runs of text, and each piece is rewritten by itself.
One fold over the pieces then keeps the stack of open elements, so that every
element of the output is closed where the page's own structure ends it.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from whosaid.functions.binding import bind
from whosaid.functions.tokens import RUN, TAG_TAIL, fix_content, tokenize_raw

# The tags, attributes and link schemes that may reach the
# output. Any other tag goes and its content stays.
RETAINED_TAGS = (
    "a", "blockquote", "br", "caption", "cite",
    "h1", "h2", "h3", "h4", "h5", "h6", "p", "q",
)
ATTRIBUTES = {
    "a": ("href", "title", "target", "rel"),
    "blockquote": ("cite",),
    "q": ("cite",),
}
SCHEMES = {
    "href": ("ftp:", "http:", "https:", "mailto:"),
    "cite": ("http:", "https:"),
}

#: A piece of a page: a part that holds no text of its body (one that is never
#: closed goes on to the end of the page), a tag, a run of text or a stray "<".
PIECE = (
    rf"(?is)<head(?:\s{TAG_TAIL})?>.*?</head\s*>"
    rf"|<script(?:[\s/]{TAG_TAIL})?>.*?(?:</script\s*>|\z)"
    rf"|<style(?:[\s/]{TAG_TAIL})?>.*?(?:</style\s*>|\z)"
    rf"|<title(?:[\s/]{TAG_TAIL})?>.*?(?:</title\s*>|\z)"
    rf"|<!--.*?(?:-->|\z)|<[!?][^>]*(?:>|\z)|{RUN}"
)

# How HTML nests. An end tag looks for its start up to a wall:
# the innermost table cell or the like for a block, any block for other elements.
_WALLS = ("applet", "button", "caption", "marquee", "object", "table", "td", "template", "th")
_HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
_TABLE_PARTS = ("caption", "tbody", "td", "tfoot", "th", "thead", "tr")
#: Blocks whose start tag ends an open paragraph.
_ENDS_P = (
    "address", "article", "aside", "blockquote", "center", "dd", "details", "dir", "div",
    "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "header", "hgroup",
    "hr", "li", "listing", "main", "menu", "nav", "ol", "p", "pre", "section", "summary",
    "table", "ul", *_HEADINGS,
)
_BLOCKS = {*_ENDS_P, *_WALLS, *_TABLE_PARTS, "select", "textarea"} - {"hr"}
_INLINE = (
    "a", "abbr", "acronym", "audio", "b", "bdi", "bdo", "big", "canvas", "cite", "code",
    "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "legend", "map",
    "mark", "meter", "nobr", "output", "progress", "q", "rp", "rt", "ruby", "s", "samp",
    "small", "span", "strike", "strong", "sub", "sup", "svg", "time", "tt", "u", "var",
    "video",
)
#: Elements whose start tag ends an open one of these names, up to these walls.
_ENDS_OWN = {
    "li": (("li",), ("ol", "ul", "menu", "dir", *_WALLS)),
    "dd": (("dd", "dt"), ("dl", *_WALLS)),
    "dt": (("dd", "dt"), ("dl", *_WALLS)),
    "td": (("td", "th", "caption"), ("table",)),
    "th": (("td", "th", "caption"), ("table",)),
    "tr": (("tr", "caption"), ("table",)),
    "a": (("a",), tuple(_BLOCKS)),
}

#: Each element is one character of the stack.
_CODES = {name: chr(33 + i) for i, name in enumerate(sorted({*_BLOCKS, *_INLINE}) + ["hr"])}
_FOUND = "\x01"


def _codes(names: Iterable[str]) -> str:
    return "".join(sorted(_CODES[n] for n in names))


def _nesting(name: str) -> dict:
    """What a start tag ends, and where an end tag looks for its start."""
    ends, walls = _ENDS_OWN.get(name, ((), ()))
    if name in _TABLE_PARTS:
        within = ("table",)
    elif name in _BLOCKS or name == "a":
        within = {"table": ("template",), "li": (*_WALLS, "ol", "ul")}.get(name, _WALLS)
    else:
        within = _BLOCKS
    return {
        "code": _CODES[name],
        "ends_p": name in _ENDS_P,
        "heading": name in _HEADINGS,
        "starts": _codes(ends),
        "start_walls": _codes(walls),
        "own": _codes(_HEADINGS if name in _HEADINGS else [name]),
        "walls": _codes(within),
    }


_NESTING = json.dumps({name: _nesting(name) for name in _CODES})
_NESTING_TYPE = (
    "map<string,struct<code:string,ends_p:boolean,heading:boolean,"
    "starts:string,start_walls:string,own:string,walls:string>>"
)
_END_TAGS = json.dumps({_CODES[n]: f"</{n}>" for n in RETAINED_TAGS if n in _CODES})
#: Pieces that are folded into one text at a time: arrays are copied when they grow.
_CHUNK = 128

TAG_NAME = r"^</?([A-Za-z][A-Za-z0-9]*)"
#: An attribute's name, and its value as it is written.
ATTRIBUTE = r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'<>]+))?"""

#: The entities that are read without their semicolon too, longest first.
OPEN_NAMES = "|".join(
    sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
)
#: A numbered, a named or an open entity, other text, or a lone ampersand.
ENTITY = (
    rf"&#[xX][0-9A-Fa-f]{{1,7}};?|&#[0-9]{{1,8}};?|&[A-Za-z][A-Za-z0-9]*;"
    rf"|&(?:{OPEN_NAMES})|[^&]+|&"
)
_NAMED = json.dumps({f"&{name}": text for name, text in html5.items()})

#: Numbers that stand for characters of an old code page.
_OLD_PAGE = {
    str(n): bytes([n]).decode("cp1252", "replace")
    for n in range(128, 160)
    if bytes([n]).decode("cp1252", "ignore")
}
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"
_ORIGIN = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)"


def _numbered(piece: Column) -> Column:
    """The character of a numbered entity; no character for what is none."""
    hexadecimal = F.regexp_extract(piece, r"^&#[xX]([0-9A-Fa-f]+)", 1)
    decimal = F.regexp_extract(piece, r"^&#([0-9]+)", 1)
    number = F.when(
        hexadecimal != "", F.conv(hexadecimal, 16, 10).cast("bigint")
    ).otherwise(decimal.try_cast("bigint"))

    def character(n: Column) -> Column:
        old = F.try_element_at(
            F.from_json(F.lit(json.dumps(_OLD_PAGE)), "map<string,string>"), n.cast("string")
        )
        is_one = (n > 0) & (n <= 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
        bytes_ = F.unhex(F.lpad(F.hex(n), 8, "0"))
        return F.coalesce(
            F.when(n.between(128, 159), old),
            F.when(is_one, F.decode(bytes_, "UTF-32")),
            F.lit("�"),
        )

    return bind(number, character)


def decode_entities(text: Column) -> Column:
    """Text with its entities read; what is no entity stays as it is."""

    def piece(p: Column) -> Column:
        named = F.try_element_at(F.from_json(F.lit(_NAMED), "map<string,string>"), p)
        return (
            F.when(~p.startswith("&"), p)
            .when(p.startswith("&#"), _numbered(p))
            .otherwise(F.coalesce(named, p))
        )

    def decoded(text: Column) -> Column:
        pieces = F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))
        read = F.array_join(F.transform(pieces, piece), "")
        return F.when(text.contains("&"), read).otherwise(text)

    return bind(text, decoded)


def _replaced(text: Column, *pairs: tuple[str, str]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def _escape_text(text: Column) -> Column:
    return _replaced(text, ("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\xa0", "&nbsp;"))


def _escape_attribute(text: Column) -> Column:
    return _replaced(text, ("&", "&amp;"), ('"', "&quot;"), ("\xa0", "&nbsp;"))


def _without_dots(path: Column) -> Column:
    """A path without its ``.`` and ``..`` steps."""

    def step(done: Column, part: Column) -> Column:
        up = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1)))
        return (
            F.when(part == "..", up)
            .when(part == ".", done)
            .otherwise(F.concat(done, F.array(part)))
        )

    # A last step that is dots leaves its slash.
    spelled = F.regexp_replace(path, r"/(\.\.?)$", "/$1/")
    parts = F.split(spelled, "/")
    start = F.slice(parts, 1, 1)
    rest = F.slice(parts, F.lit(2), F.size(parts))
    short = F.array_join(F.aggregate(rest, start, step), "/")
    return F.when(path.contains("/."), short).otherwise(path)


def resolve_link(base: Column, link: Column) -> Column:
    """A link made absolute; as it is where the base has no host."""
    origin = F.regexp_extract(base, _ORIGIN, 1)
    path = F.regexp_extract(base, _ORIGIN + r"([^?#]*)", 2)
    folder = F.coalesce(F.nullif(F.regexp_extract(path, r"^(.*/)", 1), F.lit("")), F.lit("/"))
    own_path = F.regexp_extract(link, r"^([^?#]*)", 1)
    own_rest = F.regexp_extract(link, r"^[^?#]*(.*)$", 1)

    def absolute(prefix: Column) -> Column:
        return F.concat(origin, _without_dots(F.concat(prefix, own_path)), own_rest)

    return (
        F.when(link.rlike(_SCHEME) | (origin == ""), link)
        .when(link == "", base)
        .when(link.startswith("//"), F.concat(F.regexp_extract(base, _SCHEME, 0), link))
        .when(link.startswith("/"), absolute(F.lit("")))
        .when(link.startswith("?"), F.concat(origin, path, link))
        .when(link.startswith("#"), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), link))
        .otherwise(absolute(folder))
    )


def _attributes(piece: Column, name: Column, base: Column) -> Column:
    """The allowed attributes of a start tag, as they are spelled in the output."""
    rest = F.regexp_replace(piece, TAG_NAME, "")
    pairs = F.arrays_zip(
        F.regexp_extract_all(rest, F.lit(ATTRIBUTE), F.lit(1)).alias("key"),
        F.regexp_extract_all(rest, F.lit(ATTRIBUTE), F.lit(2)).alias("value"),
    )

    def pair_key(pair: Column) -> Column:
        return F.lower(pair["key"])

    def is_allowed(pair: Column) -> Column:
        found = F.lit(False)
        for tag, keys in ATTRIBUTES.items():
            found = found | ((name == tag) & pair_key(pair).isin(*keys))
        return found

    def spelled(pair: Column) -> Column:
        value = F.regexp_replace(pair["value"], r"""^["']|["']$""", "")
        key = pair_key(pair)

        def written(value: Column) -> Column:
            return F.concat(F.lit(" "), key, F.lit('="'), _escape_attribute(value), F.lit('"'))

        def checked(link: Column) -> Column:
            fits = F.lit(False)
            for field, schemes in SCHEMES.items():
                for scheme in schemes:
                    fits = fits | ((key == field) & F.lower(link).startswith(scheme))
            anchor = (key == "href") & link.rlike(r"^#\S*$")
            return F.when(fits | anchor, written(link)).otherwise("")

        def either(value: Column) -> Column:
            link = bind(resolve_link(base, F.trim(value)), checked)
            return F.when(key.isin(*SCHEMES), link).otherwise(written(value))

        return bind(decode_entities(value), either)

    return F.array_join(F.transform(F.filter(pairs, is_allowed), spelled), "")


def _tag(piece: Column, base: Column) -> Column:
    """A tag as it is spelled in the output, the element, and the kind of tag."""

    def rewritten(name: Column) -> Column:
        end = F.when(name == "br", "<br>").otherwise(F.concat(F.lit("</"), name, F.lit(">")))
        attributes = F.when(name.isin(*ATTRIBUTES), _attributes(piece, name, base)).otherwise("")
        start = F.concat(F.lit("<"), name, attributes, F.lit(">"))
        is_end = piece.startswith("</")
        spelled = F.when(~name.isin(*RETAINED_TAGS), "").when(is_end, end).otherwise(start)
        closed = piece.rlike(r"/>$") & ~piece.rlike(r"""=\s*[^\s"'<>]*/>$""")
        kind = F.when(is_end, "end").when(closed | (name == "hr"), "empty").otherwise("start")
        element = F.try_element_at(F.from_json(F.lit(_NESTING), _NESTING_TYPE), name)
        return _piece(spelled, element, kind)

    return bind(F.lower(F.regexp_extract(piece, TAG_NAME, 1)), rewritten)


def _piece(text: Column, element: Column, kind: Column) -> Column:
    return F.struct(text.alias("text"), element.alias("element"), kind.alias("kind"))


def _nearest(stack: Column, codes: Column) -> Column:
    """The place of the innermost of some elements, 0 for none."""
    marks = F.repeat(F.lit(_FOUND), F.length(codes))
    return F.position(F.lit(_FOUND), F.call_function("translate", stack, codes, marks))


def _within(stack: Column, codes: Column, walls: Column) -> Column:
    """The place of the innermost of some elements, 0 if a wall stands before it."""

    def checked(place: Column) -> Column:
        wall = F.when(place > 1, _nearest(F.substring(stack, F.lit(1), place - 1), walls))
        return F.when(F.coalesce(wall, F.lit(0)) == 0, place).otherwise(0)

    return bind(_nearest(stack, codes), checked)


def _ended_by_start(stack: Column, element: Column) -> Column:
    """How many open elements a start tag ends: its own kind, then a paragraph,
    then a heading right around it."""
    walls = F.lit(_codes(_WALLS))

    def paragraph(own: Column) -> Column:
        rest = F.substring(stack, own + 1, F.length(stack))
        p = F.when(
            element["ends_p"] & rest.contains(_CODES["p"]),
            _within(rest, F.lit(_CODES["p"]), walls),
        )
        return F.coalesce(p, F.lit(0)) + own

    def heading(count: Column) -> Column:
        top = F.substring(stack, count + 1, F.lit(1))
        return F.when(
            element["heading"] & top.isin(*_codes(_HEADINGS)), count + 1
        ).otherwise(count)

    own = F.when(
        element["starts"] != "", _within(stack, element["starts"], element["start_walls"])
    ).otherwise(0)
    return bind(bind(own, paragraph), heading)


def _end_tags(codes: Column) -> Column:
    """The end tags of some elements that were open, the innermost first."""
    tags = F.from_json(F.lit(_END_TAGS), "map<string,string>")
    spelled = F.transform(
        F.split(codes, ""), lambda c: F.coalesce(F.try_element_at(tags, c), F.lit(""))
    )
    return F.when(codes == "", "").otherwise(F.array_join(spelled, ""))


def _balanced(pieces: Column) -> Column:
    """The text of the pieces, with every open element closed and stray ends left out."""

    def state(stack: Column, out: Column) -> Column:
        return F.struct(stack.alias("stack"), out.alias("out"))

    nothing = F.array().cast("array<string>")

    def step(acc: Column, piece: Column) -> Column:
        stack, element = acc["stack"], piece["element"]

        def put(*texts: Column) -> Column:
            return F.concat(acc["out"], F.array(F.concat(*texts)))

        def opened(count: Column) -> Column:
            ended = F.substring(stack, F.lit(1), count)
            rest = F.substring(stack, count + 1, F.length(stack))
            own_end = F.when(piece["kind"] == "empty", _end_tags(element["code"])).otherwise("")
            pushed = F.when(piece["kind"] == "empty", rest).otherwise(
                F.concat(element["code"], rest)
            )
            return state(pushed, put(_end_tags(ended), piece["text"], own_end))

        def closed(count: Column) -> Column:
            ended = F.substring(stack, F.lit(1), count)
            rest = F.substring(stack, count + 1, F.length(stack))
            return F.when(count == 0, acc).otherwise(state(rest, put(_end_tags(ended))))

        return (
            F.when(element.isNull(), state(stack, put(piece["text"])))
            .when(
                piece["kind"] == "end",
                bind(_within(stack, element["own"], element["walls"]), closed),
            )
            .otherwise(bind(_ended_by_start(stack, element), opened))
        )

    def chunk(acc: Column, number: Column) -> Column:
        some = F.slice(pieces, number * _CHUNK + 1, F.lit(_CHUNK))
        folded = F.aggregate(some, state(acc["stack"], nothing), step)
        return bind(
            folded,
            lambda f: state(
                f["stack"], F.concat(acc["out"], F.array(F.array_join(f["out"], "")))
            ),
        )

    last = F.floor(F.greatest(F.size(pieces) - 1, F.lit(0)) / _CHUNK).cast("int")
    numbers = F.when(pieces.isNotNull(), F.sequence(F.lit(0), last))
    return F.aggregate(
        numbers,
        state(F.lit(""), nothing),
        chunk,
        lambda acc: F.concat(F.array_join(acc["out"], ""), _end_tags(acc["stack"])),
    )


def clean_html(html: Column, base_url: Column) -> Column:
    """The body of a page, with the allowed tags and attributes only, balanced.

    Links become absolute, and those of other schemes go; head, script, style
    and comments go; the text of every other element stays, its entities read
    and escaped again. A quoted value may hold ``<`` and ``>``. Null gives null.

    Open elements are closed as HTML nests them, those that do not reach the
    output included: a paragraph ends at the next block, a list item, cell or
    link at the next one, any element at the end of the block around it, and the
    rest at the end of the page. An end tag without a start goes. A link that a
    block ends is not opened again behind it, and elements that HTML does not
    know neither open nor end anything.
    """

    def piece(p: Column) -> Column:
        is_tag = p.startswith("<") & (F.length(p) > 1)
        none = F.lit(None).cast(_NESTING_TYPE[len("map<string,") : -1])
        text = _piece(_escape_text(decode_entities(p)), none, F.lit("text"))
        return F.when(is_tag, _tag(p, base_url)).otherwise(text)

    pieces = F.regexp_extract_all(html, F.lit(PIECE), F.lit(0))
    return bind(F.transform(pieces, piece), _balanced)


def html_tokens(html: Column, base_url: Column, mode: str = "reference") -> Column:
    """HTML to repaired tokens: cleaned, tokenized and repaired.

    Inline tags are taken out without a gap, so that a word with a bold letter
    stays one word; the tags that remain are tokens.
    """
    return fix_content(tokenize_raw(clean_html(html, base_url)), mode)
