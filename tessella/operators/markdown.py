"""Markdown pages: code masks, references, link rewriting, headings, alert boxes.

Which characters are code depends on everything above them, so these functions read a page as a whole; each is a
pandas function over Arrow batches. What concerns many pages (where a link's target went) is a join.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tessella.functions import text as X
from tessella.shipping import ship

#: CommonMark's elements that open a block of HTML.
HTML_BLOCK = """address article aside base basefont blockquote body caption center col colgroup dd details dialog dir div dl dt
    fieldset figcaption figure footer form frame frameset h1 h2 h3 h4 h5 h6 head header hr html iframe legend li link main menu
    menuitem nav noframes ol optgroup option p param search section summary table tbody td tfoot th thead title tr track ul""".split()

_FRONT = re.compile(r"\A---[ \t]*\r?\n.*?^---[ \t]*\r?$", re.DOTALL | re.MULTILINE)
_FENCE = re.compile(r"[ \t]{0,3}(`{3,}|~{3,})")
_SPAN = re.compile(r"(?<!`)(`+)(?!`)([^\n]*?[^`\n])\1(?!`)")
_OPENS = re.compile(rf"[ \t]{{0,3}}(?:</?(?:{'|'.join(HTML_BLOCK)})(?=[ \t>\r\n]|/>|$)|<[a-z][^>]*>[ \t]*$|</[a-z][a-z0-9-]*[ \t]*>[ \t]*$)", re.IGNORECASE)
_HEADING = re.compile(r"^ {0,3}(#{1,6})[ \t]+(.*?)(?:[ \t]+#+)?[ \t]*$", re.MULTILINE)

_DEST = r"""\(\s*(?:<(?P<{0}a>[^>\n]*)>|(?P<{0}b>[^\s()<>]*(?:\([^\s()]*\)[^\s()<>]*)*))(?:\s+(?:"[^"]*"|'[^']*'|\([^)]*\)))?\s*\)"""
_INLINE = re.compile(r"(?P<bang>!?)\[(?P<text>(?:[^\[\]\n]|\\.)*)\]" + _DEST.format("d"))
_LINKED_IMAGE = re.compile(r"\[(?P<text>!\[[^\]\n]*\]\([^)\n]*\))\]" + _DEST.format("d"))
_DEFINITION = re.compile(r"^[ \t]{0,3}\[[^\]\n]+\]:[ \t]*(?:<(?P<da>[^>\n]*)>|(?P<db>\S+))", re.MULTILINE)
_AUTOLINK = re.compile(r"<(?P<da>[a-zA-Z][a-zA-Z0-9+.\-]*:[^<>\s]*)>")
_ATTRIBUTE = re.compile(r"""<[a-zA-Z][^<>]*?\b(?:href|src)\s*=\s*(?:"(?P<da>[^"]*)"|'(?P<db>[^']*)'|(?P<dc>[^\s"'>`=]+))""", re.IGNORECASE)
_ANCHOR = re.compile(r"""<a\b[^>]*?\bhref\s*=\s*(?:"(?P<da>[^"]*)"|'(?P<db>[^']*)'|(?P<dc>[^\s"'>`=]+))[^>]*>(?P<text>.*?)</a\s*>""", re.IGNORECASE | re.DOTALL)


def _blank(text: str) -> str:
    return re.sub(r"[^\n]", " ", text)


def masked(text: str) -> str:
    """Front matter, fenced blocks and code spans as spaces; every other character stays where it is."""
    front = _FRONT.match(text)
    at = front.end() if front else 0
    out, fence = [_blank(text[:at])], ""
    for line in text[at:].splitlines(keepends=True):
        mark = _FENCE.match(line)
        code = bool(fence or mark)
        if mark and not fence:
            fence = mark[1]
        elif mark and mark[1].startswith(fence):
            fence = ""
        out.append(_blank(line) if code else line)
    return _SPAN.sub(lambda m: _blank(m[0]), "".join(out))


def without_html(text: str) -> str:
    """Blocks of HTML, each up to the next blank line, as spaces."""
    out, inside = [], False
    for line in text.splitlines(keepends=True):
        inside = bool(line.strip()) and (inside or bool(_OPENS.match(line)))
        out.append(_blank(line) if inside else line)
    return "".join(out)


def _found(text: str) -> list[tuple[int, int, int, str]]:
    """(start of the reference, start and end of its destination, syntax), by kind."""
    code = masked(text)
    prose = without_html(code)
    out = []
    for pattern, page, syntax in ((_INLINE, prose, "markdown"), (_LINKED_IMAGE, prose, "markdown"), (_DEFINITION, prose, "markdown"), (_AUTOLINK, prose, "markdown"), (_ATTRIBUTE, code, "html")):
        for m in pattern.finditer(page):
            span = next((m.span(g) for g in ("da", "db", "dc") if g in pattern.groupindex and m[g] is not None), None)
            if span and page[span[0] : span[1]].strip():
                out.append((m.start(), *span, syntax))
    return out


def references_of(text: str) -> list[dict]:
    return [{"raw": text[a:b], "line": text.count("\n", 0, at) + 1, "syntax": s} for at, a, b, s in sorted(_found(text))]


def labelled_of(text: str) -> list[dict]:
    code, out = masked(text), []
    for pattern in (_INLINE, _LINKED_IMAGE, _ANCHOR):
        for m in pattern.finditer(code):
            if pattern is _INLINE and (m["bang"] or m["text"].startswith("![")):
                continue
            a, b = next(m.span(g) for g in ("da", "db", "dc") if g in pattern.groupindex and m[g] is not None)
            label = re.sub(r"<[^>]+>", "", text[m.start("text") : m.end("text")])
            out.append((m.start(), {"line": text.count("\n", 0, m.start()) + 1, "target": text[a:b], "text": html.unescape(" ".join(label.split()))}))
    return [x for _, x in sorted(out, key=lambda p: p[0])]


def shifted(text: str, title: str, level: int) -> str:
    """The first heading of level 1 moves to `level`, the others as far, six at most; without one the title is put first."""
    out, at, first = [], 0, True
    for m in _HEADING.finditer(masked(text)):
        depth = len(m[1])
        new = min(depth + level - 1, 6)
        if depth == 1 and first:
            new, first = level, False
        out += [text[at : m.start(1)], "#" * new]
        at = m.end(1)
    body = "".join([*out, text[at:]])
    return body if not first else f"{'#' * level} {title}\n\n{body}" if body else f"{'#' * level} {title}"


def spliced(text: str, moved: dict[str, str]) -> str:
    """The page with the destinations that are keys of `moved` replaced; a fragment of a destination's own is kept if the new one has none."""
    out, at = [], 0
    for a, b in sorted({(a, b) for _, a, b, _ in _found(text)}):
        raw = text[a:b]
        path, _, fragment = raw.partition("#")
        new = moved.get(raw)
        if new is None and path in moved:
            new = moved[path] + (f"#{fragment}" if fragment and "#" not in moved[path] else "")
        if new is not None and a >= at:
            out += [text[at:a], new]
            at = b
    return "".join([*out, text[at:]])


# Alert boxes. A line is read once: its quote mark, how deep that is, and the label or marker that it holds.

_QUOTED = re.compile(r"(?P<quote>[ \t]*(?:(?:[-*+]|\d+[.)])[ \t]+)?(?:>[ \t]*)+)(?P<rest>.*)")
_MARKER = re.compile(r"\[!([A-Za-z]+)\][ \t]*")
_LABEL = re.compile(r"\*\*([^*\n]+?):\*\*(?:[ \t]+(.*))?[ \t]*")
_QUOTE_FENCE = re.compile(r"[ \t]*(?:>[ \t]?)*[ \t]*(`{3,}|~{3,})")


def _kind(word: str) -> str | None:
    folded = "".join(c for c in word.lower() if c.isalpha())
    return next((kind for kind, names in X.ALERTS.items() if folded in names), None)


class _Line:
    def __init__(self, line: str):
        self.line = line
        self.body = line.rstrip("\r\n")
        self.end = line[len(self.body) :]
        m = _QUOTED.fullmatch(self.body)
        self.quote, self.rest = (m["quote"], m["rest"]) if m else ("", self.body)
        self.depth = self.quote.count(">")
        marker, label = _MARKER.fullmatch(self.rest), _LABEL.fullmatch(self.rest)
        self.marker = self.depth and marker and marker[1]
        self.label = self.depth and label and _kind(label[1]) and label[1].strip()
        self.run_in = (label[2] or "").strip() if self.label else ""
        self.blank = self.depth and not self.rest.strip()


def repaired(text: str) -> str:
    """Alert boxes as a bold label with the body on the next line; doing it twice changes nothing.

    A marker becomes its kind's label, an unknown kind Note. A known label that opens the body takes the place of the one
    above it. Blank quote lines after a label go, but one stays before a table. Code is left alone.
    """
    lines = [_Line(x) for x in text.splitlines(keepends=True)]
    out, fence, i = [], "", 0
    while i < len(lines):
        here = lines[i]
        i += 1
        mark = _QUOTE_FENCE.match(here.body)
        if mark and not fence:
            fence = mark[1]
        elif fence:
            fence = "" if mark and mark[1].startswith(fence) else fence
        elif here.marker or here.label and not here.run_in:
            word = (_kind(here.marker) or "note").capitalize() if here.marker else here.label
            if i < len(lines) and lines[i].label and lines[i].depth == here.depth:
                word, rest = lines[i].label, lines[i].run_in
                if rest:
                    lines[i] = _Line(f"{lines[i].quote}{rest}{lines[i].end}")
                else:
                    i += 1
            out.append(f"{here.quote}**{word}:**{here.end}")
            while i < len(lines) and lines[i].blank and lines[i].depth == here.depth:
                i += 1
            if i < len(lines) and lines[i].depth and lines[i].rest.lstrip().startswith("|"):
                out.append(re.sub(r"^([ \t]*)((?:[-*+]|\d+[.)])[ \t]+)", lambda m: m[1] + " " * len(m[2]), here.quote).rstrip() + (here.end or "\n"))
            continue
        out.append(here.line)
    return "".join(out)


# Columns

_REFERENCE = T.ArrayType(T.StructType([T.StructField("raw", T.StringType()), T.StructField("line", T.IntegerType()), T.StructField("syntax", T.StringType())]))
_LINK = T.ArrayType(T.StructType([T.StructField("line", T.IntegerType()), T.StructField("target", T.StringType()), T.StructField("text", T.StringType())]))


def _column(text: Column, kind: T.DataType, one: Callable[[str], object]) -> Column:
    ship(SparkSession.active())

    def run(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: None if p is None else one(p))

    return F.pandas_udf(run, kind)(text)


def mask_code(text: Column) -> Column:
    """Front matter and code blanked out, offsets kept."""
    return _column(text, T.StringType(), masked)


def references(text: Column) -> Column:
    """Every reference outside code, in order: raw, line, syntax; repeats stay."""
    return _column(text, _REFERENCE, references_of)


def labelled_links(text: Column) -> Column:
    """Links with a text of their own, in order: line, target, text; no pictures."""
    return _column(text, _LINK, labelled_of)


def callouts(text: Column) -> Column:
    """Alert boxes repaired."""
    return _column(text, T.StringType(), repaired)


def shift_headings(text: Column, title: Column, level: Column) -> Column:
    """Headings moved to where a topic stands on its page."""

    def run(pages: pd.Series, titles: pd.Series, levels: pd.Series) -> pd.Series:
        return pd.Series([None if p is None else shifted(p, t or "", int(v)) for p, t, v in zip(pages, titles, levels)], dtype=object)

    return F.pandas_udf(run, T.StringType())(text, title, level)


def retarget(pages: DataFrame, located: DataFrame) -> DataFrame:
    """Pages with their links moved. pages: page, text; located: page, target (as written, or without its fragment), new.

    Only a page's own rows of `located` reach it, as one map.
    """
    maps = located.groupBy("page").agg(F.map_from_entries(F.collect_set(F.struct("target", "new"))).alias("_moved"))

    def run(texts: pd.Series, moved: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else spliced(t, dict(m)) if m is not None else t for t, m in zip(texts, moved)], dtype=object)

    return pages.join(maps, "page", "left").withColumn("text", F.pandas_udf(run, T.StringType())(F.col("text"), F.col("_moved"))).drop("_moved")
