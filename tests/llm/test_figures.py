from time import monotonic

from ordstrata.llm.html_text import blocks, main_text, train

PROSE = "The tower was raised in the spring and has stood by the river ever since then."


def test_figures_of_an_article_stay():
    page = f"""<nav><a href=/>Home</a></nav><article><p>{PROSE}</p>
<figure class="wp-block-table"><table><tr><th>Year<th>Height</tr><tr><td>1900<td>30 m</tr></table>
<figcaption>Heights of the tower</figcaption></figure>
<figure><blockquote>It is <b>tall</b>.</blockquote></figure><figure><pre>x = 1</pre></figure></article>
<aside><figure><figcaption>More towers to see this week</figcaption></figure></aside>"""
    kept = main_text(page, train()).split("\n")
    assert kept == [PROSE, "Year", "Height", "1900", "30 m", "Heights of the tower", "It is tall.", "x = 1"]


def test_an_end_closes_its_element_at_any_depth():
    page = "<nav>" + "<div>" * 500 + "menu</nav><article><p>" + PROSE + "</p></article>"
    assert main_text(page, train()) == PROSE
    assert [b.in_aside for b in blocks(page)] == [True, False]


def test_deep_pages_take_linear_time():
    began = monotonic()
    blocks("<section>" * 50_000 + "</x>" * 50_000 + "</section>" * 50_000 + "<i>x")
    blocks("<nav><div>" * 50_000 + "</nav>" * 50_000)
    assert monotonic() - began < 20
