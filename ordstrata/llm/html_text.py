"""Main text of web pages: flat text blocks classified by a decision tree."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordstrata.llm.common import shared

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
SPACE = re.compile(r"\s+")
NAMED = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
# What elements of HTML are for.
UNSHOWN = frozenset(
    "script style noscript template title textarea select iframe object svg button".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark"
    " q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr p li dt dd tr td th"
    " option".split()
)
ARTICLE = frozenset("article main".split())
ASIDE = frozenset("nav header footer aside form menu dialog fieldset".split())
ASIDE_NAMES = re.compile(
    r"\b(?:ads?|advert\w*|banner|promo\w*|sponsor\w*|cookies?|consent|notices?|newsletter"
    r"|subscri\w*|side-?bar|menu|nav\w*|breadcrumbs?|footer|header|masthead|comments?|repl(?:y|ies)"
    r"|disqus|share|sharing|social|related|widget|popup|modal|login|search|toolbar|alert)\b"
)
ARTICLE_NAMES = re.compile(r"\b(?:article|content|main|post|entry|story|body)\b")


class Block(NamedTuple):
    text: str
    words: int
    link_density: float
    in_article: bool
    in_aside: bool


def blocks(html: str) -> list[Block]:
    """Flat text blocks of a page in order: text between tags that are not inline, without
    comments and unshown elements, character references decoded, white space as one space."""
    out: list[Block] = []
    parts: list[tuple[str, bool]] = []  # text, and whether it is in a link
    open_: list[tuple[str, bool, bool]] = []  # element, in an article, in something aside
    where: dict[str, list[int]] = {}  # depths at which elements of a name are open
    linked, at, n = 0, 0, len(html)

    def close_block() -> None:
        text = SPACE.sub(" ", "".join(t for t, _ in parts)).strip()
        if text:
            words = len(text.split(" "))
            in_links = len(SPACE.sub(" ", " ".join(t for t, link in parts if link)).split())
            _, article, aside = open_[-1] if open_ else ("", False, False)
            out.append(Block(text, words, min(1.0, in_links / words), article, aside))
        parts.clear()

    while at < n:
        less = html.find("<", at)
        if less < 0:
            less = n
        if less > at:
            parts.append((unescape(html[at:less]), linked > 0))
        if less == n:
            break
        if html.startswith("<!--", less):
            end = html.find("-->", less + 4)
            at = n if end < 0 else end + 3
            continue
        if html.startswith(("<!", "<?"), less):
            end = html.find(">", less)
            at = n if end < 0 else end + 1
            continue
        tag = TAG.match(html, less) or LOOSE_TAG.match(html, less)
        if not tag:
            parts.append(("<", linked > 0))
            at = less + 1
            continue
        at = tag.end()
        ending, name, attributes = bool(tag[1]), tag[2].lower(), tag[3]
        if name in UNSHOWN:
            if not ending and not attributes.endswith("/"):
                close = re.compile(rf"</{name}\b[^>]*>", re.I).search(html, at)
                at = close.end() if close else n
            continue
        if name == "a":
            linked = max(0, linked + (-1 if ending else 1))
        if name in INLINE:
            if name == "br":
                parts.append((" ", False))
            continue
        close_block()
        linked = 0
        if name in VOID or attributes.endswith("/"):
            continue
        if ending:
            if where.get(name):
                depth = where[name][-1]
                while len(open_) > depth:
                    where[open_.pop()[0]].pop()
        else:
            _, article, aside = open_[-1] if open_ else ("", False, False)
            named = " ".join(
                "".join(x).lower().replace("_", "-") for x in NAMED.findall(attributes)
            )
            off = name in ASIDE or (name not in ("html", "body") and bool(ASIDE_NAMES.search(named)))
            on = name in ARTICLE or bool(name != "body" and ARTICLE_NAMES.search(named))
            where.setdefault(name, []).append(len(open_))
            open_.append((name, article or (on and not off), aside or off))
    close_block()
    return out


def features(page: list[Block]) -> list[tuple[float, ...]]:
    """Per block: words and link density of it and its neighbours, and where it stands."""
    edge = Block("", 0, 0.0, False, False)
    has_article = any(b.in_article and not b.in_aside for b in page)
    return [
        (
            here.words,
            here.link_density,
            before.words,
            before.link_density,
            after.words,
            after.link_density,
            here.in_article,
            here.in_aside,
            has_article,
        )
        for before, here, after in zip([edge, *page], page, [*page[1:], edge])
    ]


# A small labelled table, hand-made: pages, with the blocks of the main text between [[ and ]].
LABELLED = [
    "<nav><ul><li><a href=/>Home</a><li><a href=/n>News</a><li><a href=/s>Sports today</a></ul></nav>"
    "<div class=ad>Buy one and get the second one for half of the price now.</div>"
    "<article><h1>[[A storm passes the coast]]</h1><p>[[The storm reached the coast on Monday evening,"
    " and many roads were closed for hours.]]</p><p>[[Rain.]]</p><p>[[More is expected, say the"
    " <a href=/w>weather services</a> of the region, before the end of the week.]]</p></article>"
    "<footer>Copyright 2020 by the paper. All rights are reserved and nothing may be copied.</footer>",
    "<header>The Daily Page and its long slogan for all readers of the town</header>"
    "<main><h1>[[Short]]</h1><p>[[One.]]</p><p>[[<a href=/a>See the whole list</a>]]</p></main>"
    "<aside>Readers also liked these seven articles about gardens and their many flowers</aside>"
    "<form>Sign up to receive our letter with the best pieces every week</form>",
    "<div class=cookie-notice>We use cookies to make this site better for you and for us.</div>"
    "<article><p>[[Cooking rice takes time and some patience, but it is not hard at all.]]</p>"
    "<div class=related><a href=/1>Ten ways to cook beans</a></div><p>[[Stir.]]</p></article>"
    "<section id=comments><p>I tried this at home and it worked well for all of us, thanks a lot!</p>"
    "<p>Nice.</p></section>",
    "<div><a href=/a>Home</a> <a href=/b>About us</a> <a href=/c>Contact</a></div>"
    "<div><p>[[A page without any article element still has paragraphs of running text that stand"
    " together and hold many words and few links.]]</p><p>[[The second paragraph is much like the"
    " first one and goes on about the same matter at some length.]]</p><p>[[A third one follows with"
    " a <a href=/x>link</a> among its many other words, as is common on the web.]]</p></div>"
    "<div>Terms</div><div><a href=/p>Privacy</a></div>",
    "<div>Menu</div><div>[[Another plain page tells its story in one long block of text, with enough"
    " words to be told apart from menus and buttons, and no link in it at all.]]</div>"
    "<div>Share</div><div><a href=/q>Next page of the list</a></div>",
    "<div class=sidebar><p>Popular this week among the readers of the page and their many"
    " friends</p></div><div class=content><h2>[[Tides]]</h2><p>[[The tide turns twice a day in most"
    " places of the coast.]]</p><ul><li>[[high]]<li>[[low]]</ul></div>"
    "<div class=footer>Contact the editors by letter or visit the office on any weekday</div>",
    "<article><header><a href=/>Front</a></header><p>[[Trees grow slowly, and the oldest of them are"
    " thousands of years old.]]</p><nav><a href=/2>Next</a></nav><p>[[Oak]]</p><div class=promo>Get"
    " our tree book today for a small price in every shop</div></article>",
    "<article><p>[[The bridge was built in three years, and its towers stand on the rock below.]]</p>"
    "<figure class=wp-block-table><table><tr><td>[[Length]]<td>[[900 m]]</table><figcaption>[[The parts of"
    " the bridge]]</figcaption></figure><figure><blockquote>[[It stands.]]</blockquote></figure></article>"
    "<aside><figure><figcaption>See the pictures of all bridges of the country</figcaption></figure></aside>",
    "<div>Log in</div><div>[[Some pages open with a line of text that is fairly long and then they"
    " continue in the same way.]]</div><div>[[They close with a shorter one of only a dozen words,"
    " right below it.]]</div><div>Back to top</div>",
]


class Node(NamedTuple):
    feature: int
    limit: float
    low: object
    high: object


def grow(rows: list[tuple[tuple[float, ...], bool]], depth: int = 6) -> Node | bool:
    """A tree that halves impurity greedily: each node asks whether a feature is at most a limit."""
    good = sum(y for _, y in rows)
    if depth == 0 or good in (0, len(rows)):
        return 2 * good > len(rows)

    def impurity(part: list) -> float:
        share = sum(y for _, y in part) / len(part)
        return len(part) * share * (1 - share)

    best = None
    # Where a block stands comes last in a row and wins ties.
    for feature in range(len(rows[0][0]) - 1, -1, -1):
        values = sorted({float(x[feature]) for x, _ in rows})
        for a, b in zip(values, values[1:]):
            limit = (a + b) / 2
            low = [r for r in rows if r[0][feature] <= limit]
            high = [r for r in rows if r[0][feature] > limit]
            worth = impurity(low) + impurity(high)
            if best is None or worth < best[0] - 1e-12:
                best = (worth, feature, limit, low, high)
    if best is None:
        return 2 * good > len(rows)
    _, feature, limit, low, high = best
    return Node(feature, limit, grow(low, depth - 1), grow(high, depth - 1))


def decide(tree: Node | bool, row: tuple[float, ...]) -> bool:
    while isinstance(tree, Node):
        tree = tree.low if row[tree.feature] <= tree.limit else tree.high
    return tree


def train(pages: list[str] = LABELLED) -> Node | bool:
    rows = []
    for page in pages:
        found = blocks(page)
        marked = [b.text.startswith("[[") for b in found]
        bare = blocks(page.replace("[[", "").replace("]]", ""))
        rows += zip(features(bare), marked, strict=True)
    return grow(rows)


def main_text(html: str | None, tree: Node | bool) -> str:
    page = blocks(html or "")
    return "\n".join(b.text for b, row in zip(page, features(page)) if decide(tree, row))


def extract(pages: DataFrame, tree: Node | bool | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages`` (page_id, url, html).

    Every page is cut into flat text blocks. A decision tree, grown on a small labelled table of
    blocks, keeps or drops each by its words, its share of linked words, the same of the blocks
    beside it, and the kind of element around it. Kept blocks are joined by line feeds.

    A null or empty page has empty text. Unclosed tags, comments and scripts end with the page.
    Repeated rows and rows without page_id are extracted like others. An empty table gives no
    rows. Further columns are not read.
    """
    load = shared(pages.sparkSession, train() if tree is None else tree)

    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = load()
        for htmls in batches:
            yield htmls.map(lambda h: main_text(h, known))

    text = F.pandas_udf(find, "string")("html")
    return pages.select("page_id", "url", text.alias("text")).withColumn(
        "n_chars", F.length("text").cast("long")
    )
