"""Visible text of broken and random pages: linear time, and equality with a plain recursive version."""

import random
import time

import pytest

from sievemark.llm.html_text import WIDEST_INDENT, visible_text

MB = 1_000_000
BROKEN = {
    "unclosed tags": "<a " * (MB // 3),
    "unclosed names": "<a" * (MB // 2),
    "unclosed quotes": "<a '\"<b \"" * (MB // 9),
    "blocks in a button": "<p><button>" + "<div>" * (MB // 5),
    "end tags of nothing": "<div>" * (MB // 10) + "</p>" * (MB // 8),
    "nested tables": "<table><tr><td>" * (MB // 15) + "x",
    "tables at once": "<table>" * (MB // 7) + "x",
    "text in tables": "<table>" + "x<b>" * (MB // 4),
    "nested lists": "<ul><li>a" * (MB // 9),
    "raw ends": "<script>" + "</script " * (MB // 9),
    "marks in names": "<a<!><a '<!>" * (MB // 12),
    "long number": "&#" + "1" * MB,
}


@pytest.mark.parametrize("name", BROKEN)
def test_broken_pages_take_time_in_proportion(name):
    def seconds(page):
        begin = time.process_time()
        visible_text(page)
        return time.process_time() - begin

    page = BROKEN[name]
    part, whole = seconds(page[: len(page) // 4]), seconds(page)
    assert whole < 30  # of about 5 measured; quadratic versions take hours
    assert whole < 12 * part + 1


def test_references_tables_and_indents():
    assert visible_text("a &#" + "9" * 5000 + "; b") == "a � b"
    # What a table cannot hold stands before it, also where that is a table itself.
    assert visible_text("<table><table>x<tr><td>y") == "x\n\ny"
    assert visible_text("a<table><tr><td><p>b</p><p>c</p></table>d") == "a\n\nb\nc\n\nd"
    deepest = visible_text("<ul><li>a" * 500).split("\n")
    assert len(deepest) == 500
    assert deepest[-1] == " " * (WIDEST_INDENT - 2) + "- a"


class Plain:
    """The layout of blocks, lists and tables, told again by recursion over (name, children)."""

    SPACED = {"p", "ul", "table"}

    def lines(self, node, listed=False):
        """Lines and gaps (None) of a node; inline text is a line that ends at blocks."""
        out, text = [], ""
        name, children = node

        def end():
            nonlocal text
            if text.strip():
                out.append(text.strip())
            text = ""

        if name == "table":
            rows = [[[line for line in self.lines(cell) if line] for cell in row] for row in children]
            widths = [max(max(map(len, cell), default=0) for cell in column) for column in zip(*rows)]
            for row in rows:
                for n in range(max(map(len, row))):
                    cells = [cell[n] if n < len(cell) else "" for cell in row]
                    out.append("  ".join(c.ljust(w) for c, w in zip(cells, widths)).rstrip())
            return out
        for child in children:
            if isinstance(child, str):
                text += child + " "
                continue
            if child[0] == "b":
                text += " ".join(child[1]) + " "
                continue
            end()
            gap = child[0] in self.SPACED and not (child[0] == "ul" and listed)
            out += [None] if gap else []
            if child[0] == "ul":
                for item in child[1]:
                    first = True
                    for line in self.lines(item, True):
                        out.append(line and ("- " if first else "  ") + line)
                        first = first and line is None
            else:
                out += self.lines(child, listed)
            out += [None] if gap else []
        end()
        return out

    def page(self, node):
        kept = []
        for line in self.lines(node):
            if line is not None:
                kept.append(line)
            elif kept and kept[-1] != "":
                kept.append("")
        while kept and not kept[-1]:
            kept.pop()
        return "\n".join(kept)


def _tree(rng, depth):
    children = []
    for _ in range(rng.randint(1, 4)):
        kind = rng.choice(["text", "b"] if depth == 0 else ["text", "b", "div", "p", "ul", "table"])
        word = rng.choice(["one", "a longer one", "x"])
        if kind == "text":
            children.append(word)
        elif kind == "b":
            children.append(("b", [word]))
        elif kind == "p":
            children.append(("p", [word, ("b", ["bold"])]))
        elif kind == "div":
            children.append(_tree(rng, depth - 1))
        elif kind == "ul":
            items = [("li", ["item", *_tree(rng, depth - 1)[1]]) for _ in range(rng.randint(1, 3))]
            children.append(("ul", items))
        else:
            wide = rng.randint(1, 3)
            row = lambda: [("td", ["cell", *_tree(rng, depth - 1)[1]]) for _ in range(wide)]
            children.append(("table", [row() for _ in range(rng.randint(1, 3))]))
    return ("div", children)


def _html(node):
    if isinstance(node, str):
        return node + " "
    name, children = node
    if name == "table":
        rows = "".join(f"<tr>{''.join(map(_html, row))}</tr>" for row in children)
        return f"<table>{rows}</table>"
    return f"<{name}>{''.join(map(_html, children))}</{name}>" + (" " if name == "b" else "")


def test_random_trees_equal_a_plain_version():
    rng = random.Random(5)
    for _ in range(1500):
        tree = _tree(rng, rng.randint(0, 3))
        assert visible_text(_html(tree)) == Plain().page(tree), _html(tree)
