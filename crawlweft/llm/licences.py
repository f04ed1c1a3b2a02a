"""Licence scan: Aho-Corasick over a text's words, and a shunting-yard parser for licence expressions.

One automaton holds notice phrases and identifier tags.  Words are set apart by single
blanks, so a phrase with a blank at either end matches whole words only, and phrases
that share words are all found.  Behind an identifier tag the rest of the line is read
as an expression over licence names with AND, OR, WITH and brackets.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlweft.llm.texts import WORDS, as_bytes, map_rows

# The phrases that every scan looks for, with their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Notice phrases that name a licence or a claim, with their labels.
NOTICES = {
    "apache license": "apache",
    "mit license": "mit",
    "bsd license": "bsd",
    "mozilla public license": "mpl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "cc0": "cc0",
    "public domain": "public-domain",
    "isc license": "isc",
    "eclipse public license": "epl",
    "boost software license": "bsl",
    "the unlicense": "unlicense",
    "proprietary and confidential": "proprietary",
}

#: Words that open an expression.
TAGS = ("spdx license identifier", "license expression")

#: How freely text under a label may be used, 0 to 1; names not listed count as UNKNOWN.
FREEDOM = {
    **dict.fromkeys(("cc0", "public-domain", "unlicense"), 1.0),
    **dict.fromkeys(("mit", "apache", "bsd", "isc", "bsl", "cc-by"), 0.9),
    **dict.fromkeys(("mpl", "epl", "lgpl", "cc-by-sa"), 0.6),
    **dict.fromkeys(("gpl", "agpl"), 0.4),
    **dict.fromkeys(("cc-by-nc", "cc-by-nd", "cc-by-nc-sa", "cc-by-nc-nd"), 0.2),
    **dict.fromkeys(("reserved", "proprietary"), 0.0),
}
UNKNOWN = 0.3
NO_NOTICE = 0.5

# Licence families by the start of their identifiers, the longest first.
FAMILIES = (
    ("cc-by-nc-sa", "cc-by-nc-sa"), ("cc-by-nc-nd", "cc-by-nc-nd"), ("cc-by-nc", "cc-by-nc"), ("cc-by-nd", "cc-by-nd"), ("cc-by-sa", "cc-by-sa"),
    ("cc-by", "cc-by"), ("cc0", "cc0"), ("apache", "apache"), ("unlicense", "unlicense"), ("agpl", "agpl"), ("lgpl", "lgpl"),
    ("gpl", "gpl"), ("mpl", "mpl"), ("epl", "epl"), ("mit", "mit"), ("bsd", "bsd"), ("bsl", "bsl"), ("isc", "isc"),
)

_SYMBOL = re.compile(r"\(|\)|[A-Za-z0-9.+:\-]+")
_TAG_LINE = re.compile(rb"(?i)(?:spdx[^0-9a-z\x80-\xff\n]+license[^0-9a-z\x80-\xff\n]+identifier|license[^0-9a-z\x80-\xff\n]+expression)[ \t]*[:=]?[ \t]*([^\r\n]*)")
_BINDS = {"OR": 1, "AND": 2, "WITH": 3}


def family(name: str) -> str:
    """The label of a licence identifier; the identifier itself in lower case where no family is known."""
    low = name.lower()
    return next((label for start, label in FAMILIES if low.startswith(start)), low.rstrip("+."))


@dataclass
class Expression:
    """A parsed licence expression: its names in order, the postfix form, and how freely it may be used."""

    names: list[str]
    postfix: list[str]
    freedom: float


def parse_expression(line: str) -> Expression | None:
    """Shunting-yard parse of the longest well-formed start of a line; None when it does not start with a licence.

    OR takes the freer side, AND the stricter one; WITH adds an exception to a licence
    and frees it by 0.1.  Names bind tighter in the order WITH, AND, OR.  Parsing stops
    at a word where an operator is due, which ends the expression; an open bracket or
    a trailing operator is dropped.
    """
    out: list[str] = []
    stack: list[str] = []
    want_name = True
    marks: list[tuple[list[str], list[str]]] = []
    last = 0
    for m in _SYMBOL.finditer(line):
        if line[last : m.start()].strip():
            break  # something that is no symbol of the grammar
        last = m.end()
        word, op = m[0], m[0].upper()
        if want_name:
            if word == "(":
                stack.append(word)
            elif word == ")" or op in _BINDS:
                break
            else:
                out.append(word)
                want_name = False
                marks.append((list(out), list(stack)))
        elif op in _BINDS:
            while stack and stack[-1] != "(" and _BINDS[stack[-1]] >= _BINDS[op]:
                out.append(stack.pop())
            stack.append(op)
            want_name = True
        elif word == ")":
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                break
            stack.pop()
            marks.append((list(out), list(stack)))
        else:
            break
    if not marks:
        return None
    out, stack = marks[-1]
    out = out + [x for x in reversed(stack) if x != "("]
    values: list[float] = []
    names: list[str] = []
    for word in out:
        if word not in _BINDS:
            names.append(word)
            values.append(FREEDOM.get(family(word), UNKNOWN))
            continue
        right, left = values.pop(), values.pop()
        if word == "WITH":
            values.append(min(1.0, left + 0.1))
        else:
            values.append(max(left, right) if word == "OR" else min(left, right))
    return Expression(names, out, values[0])


def licence_names(expression: Expression) -> list[str]:
    """The licences of an expression, without the exceptions that follow WITH."""
    stack: list[list[str]] = []
    for word in expression.postfix:
        if word not in _BINDS:
            stack.append([word])
        else:
            right, left = stack.pop(), stack.pop()
            stack.append(left if word == "WITH" else left + right)
    return stack[0]


class Scanner:
    """The automaton; made once per task, as it cannot be sent."""

    def __init__(self, base: dict[str, str], notices: dict[str, str]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for phrase in {*base, *notices, *TAGS}:
            # The automaton works on text; Latin-1 maps each byte to one character.
            key = f" {phrase} ".encode().decode("latin-1")
            self.automaton.add_word(key, (len(key), base.get(phrase), notices.get(phrase), phrase in TAGS))
        self.automaton.make_automaton()

    def scan(self, raw: bytes | None) -> tuple:
        """n_words, n_base, first word, last word, base labels, labels, expressions, score of one text."""
        ws = raw.translate(WORDS).split() if raw else []
        if not ws:
            return 0, 0, None, None, [], [], [], NO_NOTICE
        form = (b" " + b" ".join(ws) + b" ").decode("latin-1")
        n_base, first, last = 0, None, None
        base, labels, tagged = set(), set(), False
        starts = []
        for end, (size, own, notice, tag) in self.automaton.iter(form):
            tagged |= tag
            if own:
                n_base += 1
                base.add(own)
                starts.append(end + 1 - size)
            if notice:
                labels.add(notice)
        if starts:
            first = form.count(" ", 0, min(starts) + 1) - 1
            last = form.count(" ", 0, max(starts) + 1) - 1
        labels |= base
        expressions, freedoms = [], []
        if tagged:
            for m in _TAG_LINE.finditer(raw):
                parsed = parse_expression(m[1].decode("utf-8", "replace"))
                if parsed:
                    expressions.append(" ".join(parsed.postfix))
                    freedoms.append(parsed.freedom)
                    labels |= {family(x) for x in licence_names(parsed)}
        # The strictest of what the text says; an expression weighs its own alternatives.
        said = [FREEDOM.get(x, UNKNOWN) for x in labels] if not freedoms else freedoms + [FREEDOM.get(x, UNKNOWN) for x in base]
        return len(ws), n_base, first, last, sorted(base), sorted(labels), expressions, min(said, default=NO_NOTICE)


COLUMNS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "expressions", "score")


def scan_licences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", base: dict[str, str] | None = None, notices: dict[str, str] | None = None) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, expressions, score.

    `n_base` counts every place where a base phrase's words stand in a row (phrases may
    overlap); `first_word` and `last_word` are the smallest and largest start among them,
    from 0, null without any.  Label columns are sorted arrays of distinct labels;
    `expressions` holds parsed expressions in postfix form.  `score` is how freely the
    text may be used (0 to 1), 0.5 without any notice.  Phrases must be words in lower
    case with single blanks.  Null and empty texts have no words and no label.  Each row
    of `docs` gives one row, where it was read; repeated and null ids are kept and other
    columns ignored.
    """
    base = BASE if base is None else base
    notices = NOTICES if notices is None else notices
    kind = docs.schema[doc_id].dataType.simpleString()
    made: list[Scanner] = []

    def rows(batch):
        if not made:
            made.append(Scanner(base, notices))
        found = zip(*(made[0].scan(x) for x in batch["text"].to_pylist()), strict=True)
        return {"doc_id": batch["doc_id"]} | dict(zip(COLUMNS, map(list, found), strict=True))

    schema = (
        f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, "
        "base_labels array<string>, labels array<string>, expressions array<string>, score double"
    )
    return map_rows(docs.select(F.col(doc_id).alias("doc_id"), as_bytes(text)), rows, schema)
