"""HTML as a tree: text blocks, container text, tables, pictures, and a Markdown renderer with hooks.

No Spark function parses HTML, so a page is one call of a pandas function; everything that can be said about the
rows that come out of it is said in DataFrame operators.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, SparkSession, functions as F, types as T

from tessella.functions.text import ALERTS
from tessella.shipping import ship

#: Elements whose text joins the run around them (every other one is a block), and those that are no content.
INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em font i ins kbd label mark q s samp small span strong sub sup time tt u var wbr nobr madcap:variable madcap:xref madcap:keyword".split())
DROPPED = frozenset("script style noscript template svg button input select".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


class Node:
    """An element; its children are nodes and strings."""

    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None, parent: Node | None = None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs or {}, parent, []

    def walk(self) -> Iterator[Node]:
        """All elements below, in document order."""
        todo = [c for c in reversed(self.children) if isinstance(c, Node)]
        while todo:
            node = todo.pop()
            yield node
            todo += [c for c in reversed(node.children) if isinstance(c, Node)]

    def text(self) -> str:
        out, todo = [], [self]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                out.append(x)
            elif x.tag not in DROPPED:
                todo += reversed(x.children)
        return "".join(out)

    @property
    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()


class _Builder(HTMLParser):
    """An end tag closes what is open up to its own element; one that opened nothing is ignored."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.at = self.root = Node("")
        self.open: dict[str, int] = {}

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node
            self.open[tag] = self.open.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        if self.open.get(tag):
            while True:
                done = self.at
                self.open[done.tag] -= 1
                self.at = done.parent
                if done.tag == tag:
                    break

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str) -> Node:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


def squeezed(text: str) -> str:
    return " ".join(text.split())


def blocks(container: Node) -> list[str]:
    """The text of each block element, hidden text too; inside an inline element nothing breaks."""
    out, run = [], []

    def flush() -> None:
        text = squeezed("".join(run))
        if text:
            out.append(text)
        run.clear()

    todo: list = [container]
    while todo:
        x = todo.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            run.append(x)
        elif x.tag == "br":
            run.append(" ")
        elif x.tag in INLINE:
            run.append(x.text())
        elif x.tag not in DROPPED and x.tag != "img":
            flush()
            todo.append(None)
            todo += reversed(x.children)
    flush()
    return out


def matches(node: Node, simple: str) -> bool:
    """One compound of a selector: tag, .class, #id, [attribute] or [attribute=value], in any combination."""
    for kind, name, value in re.findall(r"([.#\[]?)([\w:-]+)(?:=[\"']?([^\"'\]]*)[\"']?)?\]?", simple):
        if kind == "." and name not in node.classes or kind == "#" and node.attrs.get("id") != name:
            return False
        if kind == "[" and (name not in node.attrs or value and node.attrs[name] != value) or not kind and node.tag != name.lower():
            return False
    return True


def select(root: Node, selector: str) -> list[Node]:
    """All elements that a selector matches: compounds with white space (descendant) between, commas (or)."""
    chains = [c.split() for c in selector.split(",")]

    def fits(node: Node, chain: list[str]) -> bool:
        if not matches(node, chain[-1]):
            return False
        rest, up = chain[:-1], node.parent
        while rest and up is not None:
            if up.tag and matches(up, rest[-1]):
                rest = rest[:-1]
            up = up.parent
        return not rest

    return [n for n in root.walk() if any(fits(n, c) for c in chains)]


def container(root: Node, selector: str, drop: list[str]) -> Node | None:
    """The first element that the selector matches, rid of what the other selectors match; None if there is none."""
    found = next(iter(select(root, selector)), None)
    if found is not None:
        for css in drop:
            for node in select(found, css):
                node.parent.children.remove(node)
    return found


# Tables

#: Block elements for which a pipe table's cell has no syntax.
_STRUCTURE = frozenset("ul ol dl pre blockquote table h1 h2 h3 h4 h5 h6".split())
_BLOCK = _STRUCTURE | frozenset("p div section article".split())


def _number(text: str) -> int:
    return max(1, int(text)) if text.strip().isdigit() else 1


def table_rows(table: Node) -> tuple[list[list[Node]], int | None]:
    """A table's own rows of cells, at any depth but not of a nested table, and which of them is the header."""
    rows, head = [], None
    todo = [(c, False) for c in reversed(table.children) if isinstance(c, Node)]
    while todo:
        node, in_head = todo.pop()
        if node.tag == "tr":
            cells = [c for c in node.children if isinstance(c, Node) and c.tag in ("td", "th")]
            if cells:
                head = len(rows) if in_head and head is None else head
                rows.append(cells)
        elif node.tag != "table":
            todo += [(c, in_head or node.tag == "thead") for c in reversed(node.children) if isinstance(c, Node)]
    if head is None and rows and all(c.tag == "th" for c in rows[0]):
        head = 0
    return rows, head


def unsafe(rows: list[list[Node]]) -> str | None:
    """Why rows can't be a pipe table: the first of empty, span, nested, blocks (cell by cell), ragged; None if they can."""
    if not rows:
        return "empty"
    for cell in (c for row in rows for c in row):
        if _number(cell.attrs.get("colspan", "")) > 1 or _number(cell.attrs.get("rowspan", "")) > 1:
            return "span"
        inner = [n.tag for n in cell.walk()]
        if "table" in inner:
            return "nested"
        own = sum(isinstance(c, Node) and c.tag in _BLOCK for c in cell.children)
        loose = any(isinstance(c, str) and c.strip() for c in cell.children)
        if _STRUCTURE.intersection(inner) or inner.count("p") > 1 or own + (own > 0 and loose) > 1:
            return "blocks"
    return "ragged" if len({len(row) for row in rows}) > 1 else None


def cell_text(markdown: str) -> str:
    """A cell that survives a pipe row: hard breaks inside as <br>, other white space single, pipes escaped."""
    lines = [squeezed(x) for x in markdown.split("\\\n")]
    while lines and not lines[0]:
        lines.pop(0)
    while lines and not lines[-1]:
        lines.pop()
    return "<br>".join(lines).replace("|", "\\|")


# Markdown


def compacted(levels: list[int]) -> list[int]:
    """Heading levels by nesting depth, so that none is skipped, whatever vocabulary each came from."""
    base, above, out = min(levels, default=1), [], []
    for level in levels:
        above = [x for x in above if x < level] + [level]
        out.append(min(base + len(above) - 1, 6))
    return out


def fake_lists(root: Node) -> int:
    """Single-column tables that draw a list become one: ordered if a cell's automatic number is a number, and from it on."""
    made = 0
    for table in [n for n in root.walk() if n.tag == "table" and any("autonumber_p" in c.lower() for c in n.classes)]:
        rows, _ = table_rows(table)
        if not rows:
            continue
        marks = [c.attrs["data-mc-autonum"].strip() for row in rows for c in row if c.attrs.get("data-mc-autonum", "").strip()]
        first = re.match(r"\D{0,3}(\d+)", re.sub("<[^>]*>", "", marks[0])) if marks else None
        ordered = first is not None or any("step" in c.lower() for c in table.classes)
        new = Node("ol" if ordered else "ul", {"start": first[1]} if first else {}, table.parent)
        for row in rows:
            item = Node("li", {}, new)
            item.children = row[-1].children
            for x in item.children:
                if isinstance(x, Node):
                    x.parent = item
            new.children.append(item)
        table.parent.children[table.parent.children.index(table)] = new
        made += 1
    return made


class Renderer:
    """Walks a page and writes Markdown. A dialect overrides the four hooks."""

    def skip(self, node: Node) -> bool:
        """Whether an element is chrome."""
        return False

    def heading(self, node: Node) -> int:
        """A heading's level, 0 for none."""
        return int(node.tag[1]) if re.fullmatch("h[1-6]", node.tag) else 0

    def emphasis(self, node: Node) -> str:
        """The mark around an inline element's text."""
        return {"b": "**", "strong": "**", "i": "*", "em": "*", "cite": "*"}.get(node.tag, "")

    def callout(self, node: Node) -> str | None:
        """The label of the box that an element is, or None."""
        return None

    def prepare(self, root: Node) -> None:
        """What a dialect mends in the whole page before it is written."""

    def page(self, html: str) -> str:
        root = parse(html)
        self.prepare(root)
        named = [(n, self.heading(n)) for n in root.walk() if self.heading(n) and (n.text().strip() or any(x.tag == "img" for x in n.walk())) and not self.skip(n)]
        self.levels = {id(n): new for (n, _), new in zip(named, compacted([v for _, v in named]))}
        return "\n\n".join(self.flow(root))

    def inline(self, node: Node | str) -> str:
        """One line of Markdown; a hard break is a backslash and a newline."""
        if isinstance(node, str):
            return re.sub(r"\s+", " ", node)
        if node.tag in DROPPED or self.skip(node):
            return ""
        if node.tag == "br":
            return "\\\n"
        if node.tag == "img":
            return f"![{squeezed(node.attrs.get('alt', ''))}]({node.attrs.get('src', '')})"
        if node.tag in ("code", "kbd", "samp", "tt"):
            text = squeezed(node.text())
            mark = "`" * (1 + max(map(len, re.findall("`+", text)), default=0))
            return f"{mark}{text}{mark}" if text else ""
        inner = "".join(map(self.inline, node.children))
        if node.tag == "a" and node.attrs.get("href"):
            return f"[{inner.strip()}]({node.attrs['href']})"
        mark = self.emphasis(node)
        if mark and inner.strip():
            lead, tail = inner[: len(inner) - len(inner.lstrip())], inner[len(inner.rstrip()) :]
            return f"{lead}{mark}{inner.strip()}{mark}{tail}"
        return inner

    def flow(self, node: Node) -> list[str]:
        """The Markdown blocks inside an element."""
        out, run = [], []

        def flush() -> None:
            text = re.sub(r"[ \t]*\\\n[ \t]*", "\\\\\n", re.sub(" +", " ", "".join(run))).strip()
            text = re.sub(r"(\\\n)+$|^(\\\n)+", "", text).strip()
            if text:
                out.append(text)
            run.clear()

        for child in node.children:
            if isinstance(child, str) or child.tag in INLINE or child.tag in ("br", "img"):
                run.append(self.inline(child))
            elif child.tag not in DROPPED and not self.skip(child):
                flush()
                out += self.block(child)
        flush()
        return out

    def block(self, node: Node) -> list[str]:
        label = self.callout(node)
        if label is not None:
            body = "\n\n".join(self.flow(node)).split("\n")
            head = [f"> **{label.strip().rstrip(':') or 'Note'}:**"] + ([">"] if body[0].startswith("|") else [])
            return ["\n".join(head + [f"> {x}".rstrip() for x in body])]
        level = self.heading(node)
        if level:
            text = squeezed("".join(map(self.inline, node.children)))
            return [f"{'#' * self.levels.get(id(node), level)} {text}"] if text else []
        if node.tag == "pre":
            text = node.text().strip("\n")
            mark = "`" * max(3, 1 + max(map(len, re.findall("`+", text)), default=0))
            return [f"{mark}\n{text}\n{mark}"]
        if node.tag == "hr":
            return ["---"]
        if node.tag in ("head", "title"):
            return []
        if node.tag == "blockquote":
            return ["\n".join(f"> {x}".rstrip() for x in "\n\n".join(self.flow(node)).split("\n"))]
        if node.tag in ("ul", "ol"):
            return self.items(node)
        if node.tag == "dl" or "dl" in node.classes:
            return self.definitions(node)
        if node.tag == "table":
            return self.table(node)
        return self.flow(node)

    def items(self, node: Node) -> list[str]:
        start = _number(node.attrs.get("start", "")) if node.tag == "ol" else 0
        out, n = [], 0
        for child in node.children:
            if isinstance(child, Node) and child.tag == "li":
                mark = f"{start + n}. " if start else "- "
                n += 1
                parts = self.flow(child) or [""]
                text = "\n".join(parts) if all(re.match(r"([-*+]|\d+\.) ", p) for p in parts[1:]) else "\n\n".join(parts)
                out.append(mark + text.replace("\n", "\n" + " " * len(mark)).replace("\n" + " " * len(mark) + "\n", "\n\n"))
            elif isinstance(child, Node) and child.tag in ("ul", "ol") and out:
                out[-1] += "\n" + "\n".join(f"  {x}" for x in "\n".join(self.items(child)).split("\n"))
        return ["\n".join(out)] if out else []

    def definitions(self, node: Node) -> list[str]:
        """Terms in bold, each definition a paragraph below; class-named dt and dd count."""
        out = []
        for child in (n for n in node.walk() if _role(n) and next((p for p in _above(n) if p.tag == "dl" or "dl" in p.classes), None) is node):
            parts = self.flow(child)
            if _role(child) == "dt":
                term = " ".join(parts)
                out += [f"**{term}**"] if term else []
            else:
                out += parts
        return out

    def table(self, node: Node) -> list[str]:
        """A pipe table, or, where that would lose something, the rows as HTML."""
        rows, head = table_rows(node)
        reason = unsafe(rows)
        if reason == "empty":
            return self.flow(node)
        text = [[cell_text("".join(map(self.inline, self.unwrapped(c).children))) for c in row] for row in rows]
        if reason is None:
            top = text.pop(head) if head is not None else [""] * len(text[0])
            return ["\n".join("| " + " | ".join(x) + " |" for x in [top, ["---"] * len(top), *text])]
        out = []
        for cells in rows:
            parts = []
            for c in cells:
                spans = "".join(f' {k}="{c.attrs[k]}"' for k in ("colspan", "rowspan") if _number(c.attrs.get(k, "")) > 1)
                inner = self.flow(c)
                parts.append(f"<{c.tag}{spans}>" + (inner[0] if len(inner) == 1 and "\n" not in inner[0] else "".join(f"\n\n{x}" for x in inner) + "\n\n" * bool(inner)) + f"</{c.tag}>")
            out.append("<tr>" + "".join(parts) + "</tr>")
        return ["<table>\n" + "\n".join(out) + "\n</table>"]

    def unwrapped(self, cell: Node) -> Node:
        """A cell without the one wrapper around its text."""
        while True:
            own = [c for c in cell.children if isinstance(c, Node) or c.strip()]
            if len(own) != 1 or isinstance(own[0], str) or own[0].tag not in ("p", "div"):
                return cell
            cell = own[0]


def _role(node: Node) -> str:
    return next((r for r in ("dt", "dd") if node.tag == r or r in node.classes), "")


def _above(node: Node) -> Iterator[Node]:
    node = node.parent
    while node is not None:
        yield node
        node = node.parent


#: Dialects by name. `register` adds one; `renderer` finds it.
DIALECTS: dict[str, type[Renderer]] = {"plain": Renderer}


def register(name: str) -> Callable[[type[Renderer]], type[Renderer]]:
    """Make a renderer available under a generator's name."""

    def add(cls: type[Renderer]) -> type[Renderer]:
        if DIALECTS.setdefault(name, cls) is not cls:
            raise ValueError(f"two dialects are called {name}")
        return cls

    return add


def renderer(name: str) -> Renderer:
    if name not in DIALECTS:
        raise ValueError(f"no dialect {name}; known: {', '.join(sorted(DIALECTS))}")
    return DIALECTS[name]()


def _label(word: str) -> str | None:
    """How a note class or type is shown, or None if it names no box."""
    return next((kind.capitalize() for kind, names in ALERTS.items() if re.sub("[^a-z]", "", word.lower()) in names), None)


@register("flare")
class _Flare(Renderer):
    """Skins wrap the topic; notes are paragraphs whose automatic number is their label; lists are drawn by tables; a popup
    stands in parentheses behind its text."""

    def prepare(self, root):
        fake_lists(root)
        for n in [n for n in root.walk() if "MCTextPopupBody" in n.classes]:
            n.tag, n.children = "span", [" (", *n.children, ")"]

    def skip(self, node):
        return any(c.startswith(("MCBreadcrumbs", "MCMiniToc", "nocontent", "buttons")) for c in node.classes)

    def callout(self, node):
        auto = node.attrs.get("data-mc-autonum", "")
        return _label(re.sub("<[^>]*>", "", auto)) if auto else next(filter(None, (_label(c) for c in node.classes if node.tag in ("p", "div"))), None)


@register("dita")
class _Dita(Renderer):
    """Notes are boxes of class note with a title of their own, which the label replaces."""

    def skip(self, node):
        return node.tag == "span" and any(c.endswith("title") for c in node.classes) and node.parent is not None and "note" in node.parent.classes

    def callout(self, node):
        if node.tag != "div" or "note" not in node.classes:
            return None
        return next(filter(None, (_label(c.removeprefix("note_")) for c in node.classes if c != "note")), "Note")


@register("docbook")
class _Docbook(Renderer):
    """Boxes are classed by kind; their title is a heading that the label replaces."""

    def skip(self, node):
        return node.tag in ("h3", "h4") and node.parent is not None and self.callout(node.parent) is not None or "navheader" in node.classes or "navfooter" in node.classes

    def callout(self, node):
        return next(filter(None, map(_label, node.classes)), None) if node.tag == "div" else None


@register("webworks")
class _Webworks(Renderer):
    """Headings, lists and emphasis are class names; an icon table is a box."""

    def heading(self, node):
        found = next((re.fullmatch(r"Heading([1-6])(?:_outer)?", c) for c in node.classes if c.startswith("Heading")), None)
        return int(found[1]) if found else super().heading(node)

    def emphasis(self, node):
        return "**" if "Bold" in node.classes else "*" if "Emphasis" in node.classes else super().emphasis(node)

    def callout(self, node):
        icon = next((c for n in node.walk() for c in n.classes if c.startswith("Icon") and c != "IconTable"), None) if node.tag == "table" and "IconTable" in node.classes else None
        return (_label(icon.removeprefix("Icon")) or "Note") if icon else None


@register("classes")
class _ByClass(Renderer):
    """Any element of a note class is a box."""

    def callout(self, node):
        return next(filter(None, map(_label, node.classes)), None) if node.tag not in INLINE else None


# Columns

_TEXTS = T.ArrayType(T.StringType())
_TABLE = T.ArrayType(T.StructType([T.StructField("reason", T.StringType()), T.StructField("header", T.IntegerType()), T.StructField("rows", T.ArrayType(_TEXTS))]))
_IMAGE = T.ArrayType(T.StructType([T.StructField("src", T.StringType()), T.StructField("alt", T.StringType())]))


def _column(html: Column, kind: T.DataType, one: Callable[[str], object]) -> Column:
    """A function of a page over Arrow batches; null for a null page."""

    ship(SparkSession.active())

    def run(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: None if p is None else one(p))

    return F.pandas_udf(run, kind)(html)


def tag_counts(html: Column) -> Column:
    """How many elements of each kind a page's tree has."""

    def one(page: str) -> dict[str, int]:
        out: dict[str, int] = {}
        for n in parse(page).walk():
            out[n.tag] = out.get(n.tag, 0) + 1
        return out

    return _column(html, T.MapType(T.StringType(), T.IntegerType()), one)


def html_blocks(html: Column) -> Column:
    """One string for each block; the page's head is no content. Null gives null."""
    return _column(html, _TEXTS, lambda p: blocks(_without_head(parse(p))))


def _without_head(root: Node) -> Node:
    for node in [n for n in root.walk() if n.tag == "head"]:
        node.parent.children.remove(node)
    return root


def container_blocks(html: Column, selector: str, drop: list[str] | None = None) -> Column:
    """The blocks inside the first match of a selector, without what `drop` matches; null if nothing matches."""

    def one(page: str):
        found = container(parse(page), selector, drop or [])
        return None if found is None else blocks(found)

    return _column(html, _TEXTS, one)


def to_markdown(html: Column, name: str = "plain") -> Column:
    """The page as Markdown, in a registered dialect."""
    cls = type(renderer(name))
    return _column(html, T.StringType(), lambda p: cls().page(p))


def tables(html: Column) -> Column:
    """Each table: why it can't be a pipe table (null if it can), its header row (null for none), its cells' text."""

    def one(page: str):
        found = ((table_rows(n)) for n in parse(page).walk() if n.tag == "table")
        return [{"reason": unsafe(rows), "header": head, "rows": [[squeezed(c.text()) for c in row] for row in rows]} for rows, head in found]

    return _column(html, _TABLE, one)


def definition_lists(html: Column) -> Column:
    """Terms and definitions of all definition lists, class-named ones too, as 'term: ...' and 'definition: ...'."""

    def one(page: str):
        lists = [n for n in parse(page).walk() if n.tag == "dl" or "dl" in n.classes]
        return [("term: " if _role(n) == "dt" else "definition: ") + squeezed(n.text()) for d in lists for n in d.walk() if _role(n) and next(p for p in _above(n) if p.tag == "dl" or "dl" in p.classes) is d]

    return _column(html, _TEXTS, one)


def images(html: Column) -> Column:
    """Pictures with a source, in order: src, alt."""
    return _column(html, _IMAGE, lambda p: [{"src": n.attrs["src"].strip(), "alt": squeezed(n.attrs.get("alt", ""))} for n in parse(p).walk() if n.tag == "img" and n.attrs.get("src", "").strip()])
