"""The token rules stated once more, to check the column expressions against.

A token belongs to the first class whose pattern it matches whole; the class
says what it becomes. Spans are read off a string with one letter per token, and
tagging is a matter of which positions a span covers.
"""

import re

# What brackets escape, and the letter of each marker.
OPENED = {"L": {"R": "(", "S": "["}, "R": {"R": ")", "S": "]"}}
MARKERS = {**dict.fromkeys(("``", "<q>", "<blockquote>"), "s"),
           **dict.fromkeys(("''", "</q>", "</blockquote>"), "e")}

#: (class, pattern): a tag that stays, a tag that goes, an escaped bracket, a
#: word with something behind a dash, and any other token.
CLASSES = (
    ("kept tag", r"</?(?:q|blockquote)>"),
    ("tag", r"<.*"),
    ("bracket", r"-(?P<side>[LR])(?P<kind>[RS])B-"),
    ("dashed", r"(?P<first>[^-]*)-(?P<second>[^-]*)(?P<more>.*?)(?<!-)-*"),
    ("other", r".*"),
)


def bracket(match):
    return OPENED[match["side"]][match["kind"]]


def escape_parts(match):
    """An escape read as a dashed word: nothing, a dash, the letters."""
    return ["", "-", f"{match['side']}{match['kind']}B"]


def two_parts(match):
    return [match["first"], "-", match["second"]]


def all_parts(match):
    return re.split("(-)", match[0].rstrip("-"))


#: What a class becomes: for tokens of text, for tokens of articles in the
#: reference mode, and in the clean mode.
OUTPUT = {
    "kept tag": lambda m: [m[0]],
    "tag": lambda m: [],
    "other": lambda m: [m[0]],
    "text": {"bracket": lambda m: [bracket(m)], "dashed": two_parts},
    "article": {"bracket": lambda m: [bracket(m), *escape_parts(m)], "dashed": two_parts},
    "clean": {"bracket": lambda m: [bracket(m)], "dashed": all_parts},
}


def class_of(token):
    for name, pattern in CLASSES:
        match = re.fullmatch(pattern, token, re.DOTALL)
        if match:
            return name, match


def repair(tokens, bracket_ends, every_part=False):
    """``bracket_ends``: an escaped bracket is nothing but the bracket."""
    mode = "clean" if every_part else "text" if bracket_ends else "article"
    rules = OUTPUT | OUTPUT[mode]
    return [part for name, m in map(class_of, tokens) for part in rules[name](m)]


def spans(tokens, shortest=8, longest=100):
    """Neighbouring start and end markers with that many steps between them."""
    letters = "".join(MARKERS.get(token, ".") for token in tokens)
    inner = f"s[.]{{{shortest - 1},{longest - 2}}}e"
    return [(m.start(), m.end() - 1) for m in re.finditer(inner, letters)]


def tag(tokens, all_spans, own):
    """The tokens no span covers, a tag at each span's start; the own span's words."""
    covered = {i for start, end in all_spans for i in range(start + 1, end + 1)}
    tags = {start: "<QUOTATION>" for start, _ in all_spans}
    tags[own[0]] = "<INPUT_QUOTATION>"
    content = [tags.get(i, t) for i, t in enumerate(tokens) if i not in covered]
    return content, tokens[own[0] + 1 : own[1]]
