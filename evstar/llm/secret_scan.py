"""Secret scan: fixed patterns, and assignment-aware lexing.

The lexer reads source and configuration syntax (``name = "x"``,
``"name": "x"``, ``NAME=x``, ``name := 'x'``, ``call(name="x")``) as pairs of
a target name and an expression of literals and names. Names bound to
literals are constants: they are followed through assignments before or after
their definition, through operators and f-strings, so a literal is scored by
every name it reaches. Targets may have sigils (``$name``), pointers
(``*name``, ``a->name``), subscripts (``a["name"]``, ``name[]``) and types
(``name: T = "x"``); values may be in brackets, lists, calls and alternatives,
or on the next line; objects, XML and command line options are read too. The
score is the weight of the most sensitive part of the target name times how
much the whole value looks like a secret. All of it takes time in proportion
to the text.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts_of

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "literal")
MIN_VALUE = 6
THRESHOLD = 0.5

#: Weight of a word in a target name.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "passcode": 1.0, "pass": 0.8,
    "secret": 1.0, "secrets": 1.0, "token": 1.0, "apikey": 1.0, "credential": 1.0, "credentials": 1.0,
    "auth": 0.7, "authorization": 0.9, "bearer": 0.9, "privatekey": 1.0, "accesskey": 1.0,
}
#: Words that make a following ``key`` sensitive.
KEY_OWNERS = {"api", "private", "access", "encryption", "signing", "master", "auth", "client", "secret", "session", "ssh"}
#: The same inside a name without breaks between its words.
INSIDE = re.compile(
    rf"passw(?:or)?d|passphrase|passcode|pwd|credential|(?:{'|'.join(sorted(KEY_OWNERS))})key|secret(?!ar|i|e|ly)|token(?!i[sz]|s$)"
)
#: What every name with a weight has in it.
HINT = re.compile(r"pass|pwd|secret|token|key|credential|auth|bearer", re.IGNORECASE | re.ASCII)
#: What every form of assignment has in it.
SIGNS = ("=", ":", "<-", "</", "('", '("')
#: Words that end in ``pass`` and name no password.
OTHER_PASS = {"compass", "encompass", "bypass", "trespass", "surpass", "overpass", "underpass"}
#: Literals that stand for a value that is not there.
PLACEHOLDER = re.compile(
    r"(?:change_?me|placeholder|redacted|example|sample|dummy|none|null|nil|true|false|undefined|todo|your[\w-]*|[x*.#-]+|<.*>|\$\{.*\}|\{\{.*\}\}|%\w+%)",
    re.IGNORECASE,
)

#: White space that ends no line, beyond ASCII too.
_BLANK = r" \t\f\v\x1c-\x1f\x85\xa0\u1680\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff"
_TOKEN = re.compile(
    r"""(?P<quote>\"""|'''|["`]|(?<![A-Za-z0-9_\xc0-\u1fff])'|(?<=\b[bBrRuUfFLNE])')"""
    r"""|(?P<compare>[=!<>]=|===|::|:/)"""
    r"""|(?P<op>:=|=>|\+=|\?\?=|\?=|\|\|=|\.=|<-(?=[ \t])|=|:)"""
    r"""|(?P<name>(?:\??\.|->)?[$@%&*]*+[A-Za-z_](?:\w|-(?!>))*(?:(?:\??\.|->)\$?[A-Za-z_](?:\w|-(?!>))*)*)"""
    r"""|(?P<plus>\+)"""
    rf"""|(?P<space>[{_BLANK}]+)"""
    r"""|(?P<end>[\n\r;,(){}\[\]'])"""
    rf"""|(?P<bare>[^\n\r{_BLANK}"'`;,(){{}}\[\]=:+]+)""",
    re.ASCII,
)
#: After a name and a colon: its type, and the sign that assigns.
_TYPE = re.compile(
    rf"""[{_BLANK}]*+[&*?]*+(?:'\w++[{_BLANK}]++)?(?:mut[{_BLANK}]++)?(?P<type>[A-Za-z_](?:[\w.]|::)*+)(?:[{_BLANK}]*+[\[<](?:[^\n\r=:;(){{}}"'`]|::)*+)?"""
    rf"""[?!]?(?:[{_BLANK}]*+\|[{_BLANK}]*+[A-Za-z_][\w.]*+(?:\[\])?)*+[{_BLANK}]*+=(?![=>])""",
    re.ASCII,
)
#: A type that stands between a name and the sign that assigns.
TYPE_AFTER = "string"
#: What may follow a quote up to the one that closes it, on its line.
_BODY = {
    '"': re.compile(r'(?:[^"\\\n\r]++|\\[^\n\r])*+'),
    "'": re.compile(r"(?:[^'\\\n\r]++|\\[^\n\r])*+"),
    "`": re.compile(r"[^`\n\r]*+"),
    '"""': re.compile(r'(?:[^"\\\n\r]++|\\[^\n\r]|"(?!""))*+'),
    "'''": re.compile(r"(?:[^'\\\n\r]++|\\[^\n\r]|'(?!''))*+"),
}
_VALUE = re.compile(rf"""[^\n\r{_BLANK}"'`;,(){{}}\[\]]+""")
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


@lru_cache(1 << 14)
def name_weight(name: str) -> float:
    """How sensitive a target name is, by its words (any case style)."""
    words = [w.lower() for w in _PARTS.findall(name)]
    weight = max((SENSITIVE.get(w, 0.0) for w in words), default=0.0)
    if any(INSIDE.search(w) for w in words):
        weight = 1.0
    elif any(w.endswith("pass") and w not in OTHER_PASS for w in words):
        weight = max(weight, SENSITIVE["pass"])
    for a, b in zip(words, words[1:]):
        if (b == "key" and a in KEY_OWNERS) or (a, b) == ("pass", "word"):
            weight = 1.0
    return weight


@lru_cache(1 << 12)
def literal_weight(value: str) -> float:
    """How much a literal looks like a secret: its total entropy against
    that of a short random string, or 0 for short ones and placeholders."""
    if len(value) < MIN_VALUE or any(c.isspace() for c in value) or PLACEHOLDER.fullmatch(value):
        return 0.0
    n = len(value)
    bits = -sum(c * math.log2(c / n) for c in Counter(value).values())
    return min(1.0, bits / 15)


_STRIP = " \t\f\v\x1c\x1d\x1e\x1f\x85\xa0"
SIGILS, QUOTES = "$@%&*", ("'", '"')
#: Letters that may stand right before a string.
PREFIXES = {*"bBrRuUfFLNE", "br", "rb", "Rb", "bR", "fr", "rf", "BR", "RB", "u8"}

#: Words and signs after which a value goes on.
MORE = {"or", "and", "if", "else", "||", "&&", "??", "?", "%", "|"}
#: Words before an operand.
BEFORE = {"new", "await", "not", "return"}
#: Calls whose first argument is the name of what they give.
GETTERS = {"get", "getenv", "env", "getproperty", "lookup", "fetch", "getattr", "config", "getstring"}
#: Calls that ask for, show or only look at their text.
ASKERS = {"input", "prompt", "getpass", "print", "printf", "len", "open", "compile", "format", "ask", "log", "info", "error"}
#: Calls of a name and its value.
SETTERS = {"define", "set", "setenv", "put", "putenv", "setdefault", "setproperty", "setattribute", "setattr", "add", "header", "addheader", "setheader"}
#: Names in an object that stand for the object's own.
VALUE_NAMES = {"value", "val", "default", "data", "content", "text", "string", "plain", "current"}
#: YAML marks of a text that begins on the next line.
BLOCK_MARKS = {"|", ">", "|-", ">-", "|+", ">+"}

_AFTER_NAME = re.compile(r"[ \t]*(?:=(?!=)|:=|\(|\[)")
_TUPLE = re.compile(rf"[{_BLANK}]*+\(?((?:[$]?[A-Za-z_]\w*+[{_BLANK}]*+,[{_BLANK}]*+)++[$]?[A-Za-z_]\w*+)\)?[{_BLANK}]*+=(?![=>])", re.ASCII)
_SETTER = re.compile(r"""[ \t]*\([ \t]*(?:"([^"'\n]{1,200})"|'([^"'\n]{1,200})')[ \t]*,""")
_NEXT_LINE = re.compile(r"""\r?\n[ \t]++(?=(?:"[^"\n]*+"|'[^'\n]*+'|[^\s:#="',;(){}\[\]]++)[ \t]*+[,;]?(?:\r?\n|\Z))""")
_HOLE = re.compile(r"\$?\{([A-Za-z_]\w*)\}")
_OPTION = re.compile(r"--?[A-Za-z][\w-]*+")
_TAG = re.compile(r"""<([A-Za-z_][\w:.-]*+)((?:[^<>"']|"[^"<>]*+"|'[^'<>]*+')*+)>""")
_INSIDE_TAG = re.compile(r"([^<>]*+)</([A-Za-z_][\w:.-]*+)")
_ATTRIBUTE = re.compile(r"""([A-Za-z_][\w:.-]*+)[ \t\n]*+=[ \t\n]*+(?:"([^"<>]*+)"|'([^'<>]*+)')""")
#: Attributes that name the tag's ``value``.
NAMING = {"key", "name", "id"}
#: Characters of a composed value that are looked at as a whole.
WHOLE = 1024

Literal = tuple[int, int]  # start and end of a literal's content


class Values:
    """What a text assigns. A value is a list of parts: a literal, the number
    of another value, or (until ``settle``) an unquoted word."""

    def __init__(self) -> None:
        self.parts: list[list] = []
        self.pairs: list[tuple[str, int]] = []  # target name, value
        self.latest: dict[str, int] = {}
        self.first: dict[str, int] = {}

    def assign(self, targets: list[str], parts: list) -> None:
        number = len(self.parts)
        self.parts.append(list(dict.fromkeys(parts)))
        for t in dict.fromkeys(targets):
            self.pairs.append((t, number))
            self.latest[t] = number
            self.first.setdefault(t, number)

    def settle(self) -> None:
        """Decide what unquoted words are: a name that is defined somewhere,
        a literal that stands alone, or else no literal."""
        for parts in self.parts:
            if any(type(p) is tuple and len(p) == 3 for p in parts):
                alone = len(parts) == 1
                known = [self.first.get(p[2], p) if type(p) is tuple and len(p) == 3 else p for p in parts]
                parts[:] = [p if type(p) is int else p[:2] for p in known if type(p) is int or len(p) == 2 or alone]

    def literals(self, number: int, seen: set[int]) -> Iterator[Literal]:
        """The literals of a value, and of those it is made of that are not
        in ``seen`` yet."""
        todo = [number]
        while todo:
            n = todo.pop()
            if n not in seen:
                seen.add(n)
                todo += [p for p in self.parts[n] if type(p) is int]
                yield from (p for p in self.parts[n] if type(p) is tuple)

    def wholes(self, text: str) -> list[str]:
        """Every value as text, up to ``WHOLE`` characters; a value defined
        after its use counts where it has no such use itself."""
        out = [""] * len(self.parts)
        for _ in range(2 if any(type(p) is int and p >= n for n, parts in enumerate(self.parts) for p in parts) else 1):
            for n, parts in enumerate(self.parts):
                held, size = [], 0
                if parts and type(parts[0]) is int and len(out[parts[0]]) == WHOLE:
                    out[n] = out[parts[0]]
                    continue
                for p in parts:
                    piece = out[p] if type(p) is int and p != n else text[p[0] : p[1]] if type(p) is tuple else ""
                    held.append(piece[: WHOLE - size])
                    size += len(held[-1])
                    if size >= WHOLE:
                        break
                out[n] = "".join(held)
        return out


def _tags(text: str, values: Values) -> None:
    """``<name>value</name>`` and ``<add key="name" value="value"/>``."""
    for m in _TAG.finditer(text):
        attributes = [(a[1].lower(), a.span(2) if a[2] is not None else a.span(3)) for a in _ATTRIBUTE.finditer(text, *m.span(2))]
        at = dict(attributes)
        if "value" in at:
            for name in NAMING & at.keys():
                values.assign([text[slice(*at[name])]], [at["value"]])
        inside = _INSIDE_TAG.match(text, m.end())
        if inside and inside[2] == m[1] and inside[1].strip():
            start = inside.start(1) + len(inside[1]) - len(inside[1].lstrip())
            values.assign([m[1]], [(start, start + len(inside[1].strip()))])


def read_values(text: str) -> Values:
    """All assignments of ``text``.

    A quote that its line does not close, or inside a word (``don't``),
    stands alone: what follows, and the lines of a longer string, are read
    like any other text.
    """
    values = Values()
    targets: list[str] = []  # the names being assigned
    row: list[str] = []  # the names after them, of a tuple
    left = before = None  # the last name seen, and a name right before it
    owners: list[str | None] = []  # the names that open square brackets belong to
    objects: list[list[str]] = []  # the targets that open braces are the value of
    outer: list[str] = []  # the targets that open calls and brackets are the value of
    value: list = []
    inside = 0  # brackets open in the value
    want = False  # an operand may follow
    skip = False  # the next operand is a name of something
    other = False  # after ``?``: the colon of an alternative may follow
    beside = False  # a string ended right before
    sign = ""  # the last sign that assigned
    unclosed: dict[str, int] = {}  # up to where a quote is known not to be closed
    at, fresh = 0, True  # at the beginning of a line
    while True:
        if fresh and not inside and (several := _TUPLE.match(text, at)):
            if targets and value:
                values.assign(targets, value)
            names = [n.strip(_STRIP).lstrip("$") for n in several[1].split(",")]
            targets, row, value, want, left, sign, at = names[:1], names[1:], [], True, None, "=", several.end()
        fresh = False
        m = _TOKEN.match(text, at)
        if not m:
            break
        kind, at, content = m.lastgroup, m.end(), None
        if kind == "space":
            continue
        if kind == "quote":
            mark = m.group()
            if at > unclosed.get(mark, 0):
                stop = _BODY[mark].match(text, at).end()
                if text.startswith(mark, stop):
                    kind, content, at = "string", (at, stop), stop + len(mark)
                else:
                    unclosed[mark] = stop
        word = m.group()
        was_beside, beside = beside, False
        if kind == "op" and left and not value and not other:
            if want and targets and not inside and sign == word == ":":
                targets = []  # ``a: b: c``: of nested names the last
            targets = targets + ([before, left] if before and left == TYPE_AFTER else [left])
            if left.lower() in VALUE_NAMES and objects:
                targets += objects[-1]
            left, want, sign = None, True, word
            if word == ":" and (typed := _TYPE.match(text, at)):
                targets.append(typed["type"])  # or a name assigned in a value
                at = typed.end()
        elif targets and want and kind in ("name", "bare", "string"):
            if content:
                holes = [h[1] for h in _HOLE.finditer(text, *content) if h[1] in values.latest]
                if not skip:
                    if not holes or text[content[0] : content[1]] != f"{{{holes[0]}}}":
                        value.append(content)
                    value += [values.latest[h] for h in holes]
                beside = True
            else:
                whole = _VALUE.match(text, m.start())
                name = word.lstrip(SIGILS)
                ends = kind == "name" and whole.end() == m.end()
                if ends and text[at : at + 1] in QUOTES and name in PREFIXES:
                    continue  # of a string
                if ends and word in BEFORE and text[at : at + 1] in (" ", "\t"):
                    continue
                if word == "\\" and text[at : at + 1] in ("\r", "\n"):
                    at += 1  # the value begins on the next line
                    continue
                if not ends and sign == ":" and whole.group() in BLOCK_MARKS and (after := _NEXT_LINE.match(text, whole.end())):
                    at = after.end()
                    continue
                after = _AFTER_NAME.match(text, m.end()) if ends else None
                if after and after.group()[-1] == "=":  # a chained target, or a named argument
                    if value:
                        values.assign(targets, value)
                    if value or inside:
                        targets, value = [], []
                    left, want = name, False
                    continue
                if after and after.group()[-1] == "(":
                    called = re.split(r"\.|->", name)[-1].lower()
                    if called in ASKERS:
                        left, targets, value, want, inside = name, [], [], False, 0
                    else:
                        if not inside:
                            outer = list(targets)
                        inside, skip, at = inside + 1, called in GETTERS, after.end()
                    continue
                if after and after.group() == "[":
                    if not inside:
                        outer = list(targets)
                    inside, skip, at = inside + 1, True, after.end()
                    continue
                if ends and name in values.latest:
                    value.append(values.latest[name])
                elif not skip:  # an unquoted value runs to the next white space or bracket
                    at = whole.end()
                    value.append((m.start(), at, name if ends else ""))
            want = skip = False
        elif targets and not want and kind in ("name", "bare", "plus") and (kind == "plus" or word in MORE):
            want, other = True, other or word == "?"
        elif targets and not want and other and kind == "op" and word == ":":
            want, other = True, False
        elif targets and kind == "string" and was_beside:
            value.append(content)  # strings side by side are one
            beside = True
        elif row and want and not value and word == "(":
            pass  # around a tuple
        elif targets and want and word in ("(", "["):
            if not inside:
                outer = list(targets)
            inside += 1
        elif targets and inside and word in (")", "]"):
            inside, want, skip, beside = inside - 1, False, False, False
        elif inside and word == ",":
            if targets != outer and value:  # the end of a named argument
                values.assign(targets, value)
                value = []
            targets, want, skip, left = list(outer), True, False, None
        elif targets and inside and kind == "end" and word in "\n\r":
            beside = was_beside
        elif targets and not inside and kind == "end" and word in "\n\r" and text[m.start() - 1] == "\\":
            beside = was_beside  # a line that goes on
        elif targets and want and not value and not inside and kind == "end" and word in "\n\r" and (after := _NEXT_LINE.match(text, m.start())):
            at = after.end()
        elif row and not inside and word == ",":
            if value:
                values.assign(targets, value)
            targets, value, want = [row.pop(0)], [], True
        else:
            if value:
                values.assign(targets, value)
            if word == "{":
                objects.append(targets if want else [])
            elif word == "}" and objects:
                objects.pop()
            last, targets, row, value, want, before = left, [], [], [], False, None
            inside, skip, other, outer = 0, False, False, []
            left = text[slice(*content)] if content else None
            if kind == "name":
                left, before = word.lstrip(SIGILS + "?.->"), last
                if re.split(r"\.|->", left)[-1].lower() in SETTERS and (call := _SETTER.match(text, at)):
                    targets, want, sign, at, left = [call[1] or call[2]], True, "=", call.end(), None
            elif kind == "bare" and _OPTION.fullmatch(word):
                left = word.lstrip("-")
            elif word == "[":
                owners.append(last)
            elif word == "]" and owners:
                left = ".".join(n for n in (owners.pop(), last) if n)
            elif kind == "end" and word in "\n\r;":
                owners.clear()
                fresh = True
    if value:
        values.assign(targets, value)
    if "<" in text:
        _tags(text, values)
    values.settle()
    return values


def assignments(text: str) -> Iterator[tuple[str, list[Literal]]]:
    """``(target name, literals that reach it)`` in text order."""
    values = read_values(text)
    for target, number in values.pairs:
        yield target, sorted(values.literals(number, set()))


def literal_spans(text: str) -> list[Literal]:
    """Literals whose score for some name they reach passes the threshold."""
    values = read_values(text)
    weighed = [(w, n) for name, n in values.pairs if (w := name_weight(name))]
    if not weighed:
        return []
    wholes, found, seen = values.wholes(text), set(), set()
    for weight, n in weighed:
        if weight * literal_weight(wholes[n]) >= THRESHOLD:
            found.update((a, b) for a, b in values.literals(n, seen) if b > a)
    return sorted(found)


def scan(text: str) -> list[tuple[int, str, int]]:
    """All spans ``(start, kind, end)`` by start, then kind. Literals inside
    a span of a fixed pattern are not listed again."""
    base = []
    if "=" in text or ":" in text:
        base += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= MIN_VALUE]
    base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    base += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if any(sign in text for sign in SIGNS) and HINT.search(text):
        covers, k, reach = sorted(base), 0, 0
        for a, b in literal_spans(text):  # in order of their start
            while k < len(covers) and covers[k][0] <= a:
                reach = max(reach, covers[k][2])
                k += 1
            if b > reach:
                base.append((a, 3, b))
    return [(s, KINDS[k], e) for s, k, e in sorted(base)]


def joined(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def redact(text: str, mask: str = "[SECRET]") -> str:
    """``text`` with every span (overlapping ones merged) replaced."""
    out, last = [], 0
    for start, _, end in scan(text):
        if start >= last:
            out += [text[last:start], mask]
        last = max(last, end)
    return "".join([*out, text[last:]])


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_assign, n_access, n_hex,
    base_sha256, spans, n_literal``.

    A null text is empty: no spans, and the sha256 of the empty string.
    Null ids and repeated rows pass through; other columns are ignored; an
    empty table gives an empty result. Texts of any length are read whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for _, texts in texts_of(batch, "text"):
                for text in texts:
                    spans = scan(text)
                    counts = Counter(kind for _, kind, _ in spans)
                    digest = hashlib.sha256(joined([s for s in spans if s[1] != "literal"]).encode()).hexdigest()
                    rows.append((counts["assign"], counts["access"], counts["hex"], digest, joined(spans), counts["literal"]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)]
            yield pa.record_batch([batch.column(0), *columns], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_literal"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_literal long"
    )
