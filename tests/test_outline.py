from presslake.operators.outline import Outline, read_items
from presslake.operators.rules import AS_IS, Field, RuleSet, Step


def items(markup, item, **fields):
    rules = RuleSet(name="t", items=item, **{"title": Field(), "link_mode": AS_IS, **fields})
    return read_items(markup, rules)


def titles(markup, item, **fields):
    return [row["title"] for row in items(markup, item, **fields)]


def test_text_runs_are_stripped_and_joined_without_separator():
    markup = "<div> <span>Suscriptores </span>\n<span> Fútbol <b>Colombiano</b></span></div>"
    assert titles(markup, Step(("div",))) == ["SuscriptoresFútbolColombiano"]


def test_entities_join_their_neighbours():
    markup = "<p>a &amp; b &eacute;&#233;&#xE9; &nope; x&nbsp;</p>"
    assert titles(markup, Step(("p",))) == ["a & b ééé &nope x"]


def test_comments_split_text_and_do_not_show():
    assert titles("<p>one <!-- no --> two</p>", Step(("p",))) == ["onetwo"]


def test_script_style_and_template_text_is_hidden():
    markup = (
        '<div>a<script>var t="</p>";</script><style>p{}</style>'
        "<template><p>x</p></template>b</div>"
    )
    assert titles(markup, Step(("div",))) == ["ab"]


def test_nested_matches_are_found_in_document_order():
    markup = '<div class="c">1<div class="c">2</div></div><div class="c">3</div>'
    assert titles(markup, Step(("div",), ("c",))) == ["12", "2", "3"]


def test_unclosed_elements_end_with_their_parent():
    markup = "<article><p><b>a<br><p>b</article><p>c"
    assert titles(markup, Step(("article",))) == ["ab"]
    assert titles(markup, Step(("p",))) == ["ab", "b", "c"]


def test_end_tag_without_start_is_ignored():
    assert titles("<div>a</span></p>b</div>c", Step(("div",))) == ["ab"]


def test_void_elements_have_no_content():
    outline = Outline('<div><img class="c"><input>text</div>')
    assert [element.tag for element in outline.elements] == ["div", "img", "input"]
    assert outline.text(outline.elements[1]) == ""


def test_self_closed_element_ends_at_once():
    assert titles('<p/>a<p class="x">b</p>', Step(("p",))) == ["", "b"]


def test_class_contains_and_exact():
    markup = '<i class="big Card-Title-x">1</i><i class="Card-Title big">2</i><i>3</i><i class>4</i>'
    assert titles(markup, Step(("i",), ("Card-Title",))) == ["1", "2"]
    assert titles(markup, Step(("i",), ("Card-Title",), exact=True)) == ["2"]
    assert titles(markup, Step(("i",), ("Card-Title big",), exact=True)) == ["2"]
    assert titles(markup, Step(("i",), ("big Card",))) == ["1"]


def test_first_match_then_inside_it_only():
    markup = "<li><h3>no link</h3><h3><a>second</a></h3></li>"
    path = Field((Step(("h3",)), Step(("a",))))
    assert titles(markup, Step(("li",)), title=path) == [None]


def test_ancestor_is_the_nearest_that_fits():
    markup = '<a href="/far"><a><div class="c"><h2>t</h2></div></a></a>'
    path = Field((Step(("h2",)), Step(("a",), has_attr="href", axis="ancestor")), attr="href")
    assert items(markup, Step(("div",), ("c",)), link=path)[0]["link"] == "/far"


def test_attributes():
    markup = '<a href=" /x " data-seccion="Vida &amp; Ocio">t</a><a href>u</a><a>v</a>'
    trimmed = Field(attr="href", trim=True)
    rows = items(markup, Step(("a",)), link=Field(attr="href"), category=trimmed)
    assert [(row["link"], row["category"]) for row in rows] == [(" /x ", "/x"), ("", ""), (None, None)]
    section = Field(attr="data-seccion")
    assert items(markup, Step(("a",)), category=section)[0]["category"] == "Vida & Ocio"


def test_a_deep_page_is_read_whole():
    markup = "<div>" + "<p>x" * 20_000 + "</div><h1>end</h1>"
    assert titles(markup, Step(("div",))) == ["x" * 20_000]
    assert titles(markup, Step(("h1",))) == ["end"]


def test_cdata_is_text():
    assert titles("<div>a<![CDATA[ b ]]></div>", Step(("div",))) in (["ab"], ["a"])
