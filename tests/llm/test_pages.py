from ordstrata.llm.html_text import blocks, extract, main_text, train

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head>
<body class="home"><nav><ul><li><a href="/a">One</a></li></ul></nav><!-- x <p>no</p> -->
<div class="ad">Buy this now, all of you who read these lines today.</div>
<article><h1>Title &amp; more</h1><p><b>First  line &lt;here&gt;<br><p>Sec\n ond <a href="x>y">link</a> 5 < 6.</p>
<form><input name=q>Search</form><p>Ti.</p></article><aside>Other</aside>
<div id="comments"><p>I liked this a lot and read it twice, thank you all.</p></div>
<footer>&copy; all</footer>"""


def test_main_text():
    text = main_text(PAGE, train())
    assert text == "Title & more\nFirst line <here>\nSec ond link 5 < 6.\nTi."


def test_odd_pages(spark):
    tree = train()
    assert main_text(None, tree) == main_text("", tree) == main_text("<p><script>x", tree) == ""
    assert main_text("<article><p>a<!-- b", tree) == "a"
    assert [b.text for b in blocks("<" * 50 + "x" + "<p" * 50)] != []
    long = "<article>" + "<p>some words here</p>" * 3000
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "u", ""), (3, "u", long)]
    pages = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, text int")
    found = extract(pages).collect()
    assert len(found) == 5
    for r in found:
        html = {1: PAGE, 3: long}.get(r.page_id, "")
        assert r.text == main_text(html, tree) and r.n_chars == len(r.text)
    assert extract(pages.limit(0)).count() == 0
