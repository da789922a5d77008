"""Extraction rules as data: where the items of a page are and how to read them."""

from __future__ import annotations

from dataclasses import dataclass

# How a raw href becomes a link.
PREFIX = "prefix"  # host + href, whatever the href; a blank one counts as missing
AS_IS = "as_is"  # the href itself; a blank one counts as missing
ABSOLUTE = "absolute"  # host + href unless it starts with "http"; blank stays blank
ABSOLUTE_BLANK_IS_HOST = "absolute_blank_is_host"  # the same, but blank becomes the host


@dataclass(frozen=True)
class Step:
    """One move from an element to the first element that fits."""

    tags: tuple[str, ...] = ()
    classes: tuple[str, ...] = ()
    exact: bool = False  # class tokens must equal, not merely contain, one of ``classes``
    has_attr: str | None = None
    axis: str = "descendant"  # or "ancestor"


@dataclass(frozen=True)
class Field:
    """Steps from the item to an element, then its text or one attribute of it."""

    steps: tuple[Step, ...] = ()
    attr: str | None = None
    trim: bool = False  # attributes only; text is always trimmed
    missing: str = "N/A"


@dataclass(frozen=True)
class RuleSet:
    name: str
    items: Step
    title: Field
    category: Field | None = None
    link: Field | None = None
    description: Field | None = None
    link_mode: str = AS_IS
    base_url: str = ""
    require_link: bool = False


def _fields(*steps: Step, **options) -> Field:
    return Field(steps=steps, **options)


# Tag names, class names, attributes, hosts and fill-in texts of
# the two newspapers' pages.
STORY_CARDS = RuleSet(
    name="story_cards",
    items=Step(("article",), ("story-card", "listing-card")),
    title=_fields(Step(("h2", "h3"), ("article-title", "title"))),
    link=_fields(Step(("a",), ("title", "story-link")), attr="href"),
    category=_fields(Step(("span",), ("category", "section-name"))),
    link_mode=PREFIX,
    base_url="https://www.eltiempo.com",
    require_link=True,
)

CARD_CONTAINERS = RuleSet(
    name="card_containers",
    items=Step(("article",), ("Card-Container",)),
    title=_fields(Step(("h2",), ("Card-Title",))),
    link=_fields(Step(("a",), ("Card-Title",)), attr="href"),
    category=_fields(Step(("span",), ("Card-Category",))),
    link_mode=AS_IS,
    require_link=True,
)

BLOCK_CARDS = RuleSet(
    name="block_cards",
    items=Step(("div",), ("BlockContainer-Content",), exact=True),
    title=_fields(Step(("h2",), ("Card-Title",), exact=True), missing="No title"),
    category=_fields(
        Step(("div",), ("Card-SectionContainer",), exact=True), missing="No category"
    ),
    description=_fields(Step(("div",), ("Card-Hook",), exact=True), missing="No description"),
)

_LISTED_TITLE = (Step(("h3",), ("c-article__title",), exact=True), Step(("a",)))

LISTED_ARTICLES = RuleSet(
    name="listed_articles",
    items=Step(("article",), ("c-article",)),
    title=Field(_LISTED_TITLE, missing="No title"),
    link=Field(_LISTED_TITLE, attr="href", trim=True, missing="No link"),
    category=Field(attr="data-seccion", trim=True, missing="No category"),
    link_mode=ABSOLUTE,
    base_url="https://www.eltiempo.com",
)

ARCHIVE_CARDS = RuleSet(
    name="archive_cards",
    items=Step(("div",), ("BlockContainer-Content",), exact=True),
    title=_fields(Step(("h2",), ("Card-Title",), exact=True), missing="No title"),
    link=_fields(
        Step(("h2",), ("Card-Title",), exact=True),
        Step(("a",), has_attr="href", axis="ancestor"),
        attr="href",
        trim=True,
        missing="No link",
    ),
    category=_fields(
        Step(("div",), ("Card-SectionContainer",), exact=True), missing="No category"
    ),
    link_mode=ABSOLUTE_BLANK_IS_HOST,
    base_url="https://www.elespectador.com",
)

# The source names of the daily pages.
DAILY_SOURCES = {"eltiempo": STORY_CARDS, "elespectador": CARD_CONTAINERS}
