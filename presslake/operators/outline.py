"""Reads one page into a flat outline and applies one rule set to it.

This is the whole per-page helper; everything after it is column expressions.
Markup is read with the standard library's parser. An end tag closes every
element opened since its start tag; one without a start tag is ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from html import unescape
from html.entities import html5
from html.parser import HTMLParser

from presslake.operators.rules import Field, RuleSet, Step

# Elements that never have content.
VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen "
    "link menuitem meta nextid param source spacer track wbr".split()
)
# Elements whose text is not part of the page's text.
HIDDEN = frozenset(("rp", "rt", "script", "style", "template"))


class Element:
    """An element with the range of elements and text runs inside it."""

    __slots__ = ("tag", "attrs", "parent", "index", "last", "first_run", "last_run")

    def __init__(self, tag, attrs, parent, index, first_run):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.index, self.first_run = index, first_run
        self.last = self.last_run = None


class Outline(HTMLParser):
    """Elements and visible text runs of a page, both in document order."""

    def __init__(self, markup: str):
        super().__init__(convert_charrefs=False)
        self.elements: list[Element] = []
        self.runs: list[str] = []
        self._open: list[Element] = []
        self._open_tags: Counter[str] = Counter()
        self._pending: list[str] = []
        self._hidden = 0
        self._fitting: dict[Step, list[int]] = {}
        self.feed(markup)
        self.close()
        self._end_run()
        while self._open:
            self._close_innermost()

    def _end_run(self):
        if self._pending:
            run = "".join(self._pending).strip()
            self._pending.clear()
            if run and not self._hidden:
                self.runs.append(run)

    def _close_innermost(self):
        element = self._open.pop()
        element.last, element.last_run = len(self.elements), len(self.runs)
        self._open_tags[element.tag] -= 1
        self._hidden -= element.tag in HIDDEN

    def _start(self, tag, attrs):
        self._end_run()
        parent = self._open[-1] if self._open else None
        values = {name: value or "" for name, value in attrs}
        element = Element(tag, values, parent, len(self.elements), len(self.runs))
        self.elements.append(element)
        self._open.append(element)
        self._open_tags[tag] += 1
        self._hidden += tag in HIDDEN

    def handle_starttag(self, tag, attrs):
        self._start(tag, attrs)
        if tag in VOID:
            self._close_innermost()

    def handle_startendtag(self, tag, attrs):
        self._start(tag, attrs)
        self._close_innermost()

    def handle_endtag(self, tag):
        self._end_run()
        if self._open_tags[tag]:
            while self._open[-1].tag != tag:
                self._close_innermost()
            self._close_innermost()

    def handle_data(self, data):
        self._pending.append(data)

    def handle_entityref(self, name):
        self._pending.append(html5.get(name + ";", "&" + name))

    def handle_charref(self, name):
        self._pending.append(unescape(f"&#{name};"))

    def handle_comment(self, data):
        self._end_run()

    handle_decl = handle_pi = handle_comment

    def unknown_decl(self, data):
        self._end_run()
        if data.upper().startswith("CDATA["):
            self._pending.append(data[6:])
            self._end_run()

    def first_inside(self, element: Element, step: Step) -> Element | None:
        """The first element inside that fits; a page is searched once for each step."""
        if step not in self._fitting:
            self._fitting[step] = [e.index for e in self.elements if fits(e, step)]
        found = self._fitting[step]
        at = bisect_right(found, element.index)
        return self.elements[found[at]] if at < len(found) and found[at] < element.last else None

    def text(self, element: Element) -> str:
        return "".join(self.runs[element.first_run : element.last_run])


def fits(element: Element, step: Step) -> bool:
    if step.tags and element.tag not in step.tags:
        return False
    if step.has_attr and step.has_attr not in element.attrs:
        return False
    if not step.classes:
        return True
    names = element.attrs.get("class", "").split()
    whole = " ".join(names)
    if step.exact:
        return any(wanted == whole or wanted in names for wanted in step.classes)
    return any(wanted in whole for wanted in step.classes)


def follow(outline: Outline, element: Element, step: Step) -> Element | None:
    if step.axis == "ancestor":
        element = element.parent
        while element is not None and not fits(element, step):
            element = element.parent
        return element
    return outline.first_inside(element, step)


def read(outline: Outline, element: Element, field: Field | None) -> str | None:
    if field is None:
        return None
    for step in field.steps:
        element = follow(outline, element, step)
        if element is None:
            return None
    if field.attr is None:
        return outline.text(element)
    value = element.attrs.get(field.attr)
    return value.strip() if value is not None and field.trim else value


def read_items(markup: str, rules: RuleSet) -> list[dict[str, str | None]]:
    """The raw fields of every item of a page, in document order."""
    outline = Outline(markup)
    return [
        {
            "category": read(outline, element, rules.category),
            "title": read(outline, element, rules.title),
            "link": read(outline, element, rules.link),
            "description": read(outline, element, rules.description),
        }
        for element in outline.elements
        if fits(element, rules.items)
    ]
