import pytest

from inkwell.llm import markup as M

PLAIN = ["Yields were 5 * 37 kilos in the CO2 trial.", "(p < 0,05; n > 525).", "Costs of $17 and $38 were booked under R&D.", "The field unit_cost_59 was left blank [sic].", "item #18 (see page 105)", "A ratio x/y of ~85 was assumed {draft}.", "• one\n• two", "for x in rows:\n    if x > 3:\n        keep(x)", "a = 578 + 36", "", " ", "Tom & Jerry", "- 146 -"]
MARKED = {"<p>a</p>": "html", "In&nbsp;1998": "html", "<!-- x -->y": "html", "a **b** c": "markdown", "_hogares de_ x": "markdown", "# Head\ntext": "markdown", "[a](http://x.y)": "markdown", "~~gone~~": "markdown", "a `code` b": "markdown", "- item\n- item": "markdown", "| a | b |\n| --- | --- |": "markdown", "== H ==\nx": "wiki", "the [[energy regulator]]": "wiki", "''it''": "wiki", "x{{cite report|title=a}}": "wiki", "\\emph{a}": "latex", "$\\frac{a}{b}$": "latex", "\\int_0^{T} c(t)\\,dt = 350": "latex", "\\[a=1\\]": "latex"}


@pytest.mark.parametrize("text", PLAIN)
def test_plain_signs_are_no_markup(text):
    assert M.convert(text)[0] == []


@pytest.mark.parametrize("text", MARKED)
def test_markup_is_found(text):
    assert MARKED[text] in M.convert(text)[0]


def test_structure_is_kept():
    text = "<h2>Head</h2><p>One <b>two</b>.</p><ul><li>a</li><li>b</li></ul><table><tr><th>x</th><td>1</td></tr></table>\n\n```\nif a:\n    b\n```\n\n$$E = mc^2$$"
    kinds, parts = M.convert(text)
    assert kinds == ["html", "latex", "markdown"]
    kept = [(k, t) for k, t in parts if k != "blank"]
    assert kept == [("heading", "Head"), ("text", "One two."), ("item", "a"), ("item", "b"), ("row", "x\t1"), ("code", "if a:\n    b"), ("formula", "E = mc^2")]
    assert "    if a:\n        b" in M.clean(parts) and "<" not in M.clean(parts)


def test_link_dominated_blocks_are_left_out_and_articles_kept():
    menu = "<ul>" + "".join(f"<li><a href='/{k}'>go {k}</a></li>" for k in range(12)) + "</ul>"
    article = "<div><p>" + "The council reviewed the tariffs before winter. " * 12 + "</p><p>See <a href='/x'>the report</a> for more words.</p></div>"
    text = M.clean(M.convert(f"<body>{menu}{article}</body>")[1])
    assert "go 3" not in text and "the report" in text and text.count("council") == 12
    for piece in (article, "<p>only <a href='/y'>a link</a></p>", "plain <b>x</b> text"):
        assert M.clean(M.convert(piece)[1])


def test_broken_markup_does_not_crash():
    for t in ("<p>open", "</p>close", "<a href=", "**x", "[[a", "\\textbf{x", "$x", "```\ncode", "<" * 500, "&" * 500, "[" * 300, "*" * 300, "<div>" * 3000 + "x"):
        M.convert(t)


def test_tables(spark):
    b = spark.createDataFrame([("a", "x **y**", 1, "s"), ("a", "x **y**", 1, "s"), ("p", "plain", 1, "s"), ("n", None, 1, "s"), ("e", "", 1, "s"), ("l", "word **bold** " * 3000, 1, "s")], "block_id string, content string, parts int, markup string")
    c = spark.createDataFrame([("f", "= H =\n\n* a\n* b"), ("g", None)], "filename string, body string")
    assert {tuple(r) for r in M.found(b, c).collect()} == {("blocks", "a"), ("blocks", "l"), ("concept_documents", "f")}
    out = {(r.item_table, r.item_key): r.clean_text for r in M.converted(M.items(b, c)).collect()}
    assert out["blocks", "a"] == "x y" and out["blocks", "p"] == "plain" and out["blocks", "e"] == "" and ("blocks", "n") not in out
    assert out["concept_documents", "f"] == "H\n\n• a\n• b"
    empty = spark.createDataFrame([], "block_id string, content string")
    assert M.found(empty, spark.createDataFrame([], "filename string, body string")).count() == 0


LINKS = "<ul>" + "".join(f"<li><a href='/{k}'>go {k}</a></li>" for k in range(8)) + "</ul>"
BODY = "<p>" + "The council reviewed the tariffs before winter. " * 10 + "</p>"


def test_the_densest_subtree_decides_what_stays():
    """The same list of links is content inside the subtree with the largest sum of densities and furniture beside it."""
    side = f"<body><div class=nav>{LINKS}</div><div>{BODY}{BODY}</div><footer><a href='/i'>Imprint</a> | <a href='/c'>Contact</a></footer></body>"
    text = M.clean(M.convert(side)[1])
    assert "go 3" not in text and "Imprint" not in text and text.count("council") == 20
    inside = f"<body><div>{BODY}{LINKS}{BODY}</div></body>"
    assert "go 3" in M.clean(M.convert(inside)[1])


def test_short_paragraphs_and_lists_beside_the_content_stay():
    page = f"<body><h2>Head</h2><div>{BODY}{BODY}</div><p>See <a href='/x'>the annex</a> on the tariffs of that year and the next.</p><ul><li>one</li><li>two</li></ul></body>"
    text = M.clean(M.convert(page)[1])
    assert text.startswith("Head") and "the annex" in text and "• one" in text and "• two" in text


def test_without_the_density_furniture_stays(monkeypatch):
    side = f"<body><div>{LINKS}</div><div>{BODY}{BODY}</div></body>"
    monkeypatch.setattr(M, "boilerplate", lambda root: set())
    assert "go 3" in M.clean(M.convert(side)[1])


def test_each_sign_convert_knows_is_in_the_hint():
    import re

    for t in (";term\n:meaning", "      - deep item", "\t\t+ item", "> quote"):
        assert M.convert(t)[0] and re.search(M._HINT.replace("(?m)", ""), t, re.M)
