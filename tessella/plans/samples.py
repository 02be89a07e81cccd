"""What a user of the registries would write: an engine with all four hooks, and a format of tables of contents."""

from __future__ import annotations

from tessella.operators import html as H
from tessella.sources import readers as R


@H.register("shouting")
class Shouting(H.Renderer):
    def skip(self, node):
        return "menu" in node.classes

    def heading(self, node):
        return 2 if node.tag == "div" and "head" in node.classes else super().heading(node)

    def emphasis(self, node):
        return "__" if node.tag == "u" else super().emphasis(node)

    def callout(self, node):
        return node.attrs.get("data-box") or None


def indented(text: str) -> list[tuple[int, str, str]]:
    """Lines of 'title = path', two spaces a level."""
    rows = [(line, line.split("=")) for line in text.split("\n") if "=" in line]
    return [((len(line) - len(line.lstrip())) // 2, parts[0].strip(), parts[1].strip()) for line, parts in rows]


R.register_toc("indented", indented)
