"""Main text of web pages: flat text blocks, classified by a decision tree over their own and their neighbours' features."""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import add_columns, fresh, others, table

# Names from HTML and from common page templates.
BLOCK_TAGS = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split())
SKIPPED_TAGS = set("script style noscript template iframe object embed svg canvas select textarea button head title audio video applet map datalist annotation annotation-xml".split())
RAW_TAGS = {"script", "style", "textarea", "title", "iframe", "noscript"}
CONTAINERS = set("article aside body details dialog div dl fieldset footer form header main menu nav ol section table ul".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
ASIDE_TAGS = set("aside dialog footer menu nav".split())
ASIDE_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
ASIDE_NAMES = set(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comments consent cookie cookies copyright disqus footer gdpr masthead navbar newsletter "
    "pager pagination popup sidebar signup sponsored subscribe toolbar topbar".split()
)
#: Words that name something beside the text as often as what a text is about.
DOUBTFUL_NAMES = set(
    "comment disclaimer header login menu modal nav navigation notice notification promo promotion related recommended replies reply respond search share sharing skip social sponsor "
    "subscription teaser widget widgets".split()
)
COMMENT_NAMES = set("comment comments disqus replies reply respond".split())
NEUTRAL_NAMES = set(
    "a an and area b base big block body bottom box boxes button buttons c center class clear col cols column columns container fixed float for g grid group in inner item items j l layout left "
    "list lists mod module my new of on outer p panel pre primary r right row s secondary section site slot small sticky style sub tabs text the to top unit v view wrap wrapper x z".split()
)
VOID_TAGS = set("area base br col embed hr img input link meta param source track wbr".split())

ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))|([^\s=/"'<>]+)""")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
TAG_NAME = re.compile(r"/?([a-zA-Z][^\s/>]*)")
QUOTE_OR_END = re.compile(r"[>\"']")
COMMENT_END = re.compile(r"--!?>")
HEAD_END = re.compile(r"</head\s*>|<body\b", re.I)

FEATURES = ("place", "named", "heading", "notice", "density", "words", "prev_density", "next_density", "prev_words", "next_words")
NOTICE = re.compile(r"^\W*(?:©|\(c\)|copyright\b)|\ball rights reserved\b", re.I)
#: A name says nothing of what holds this share of a page's (or its article's) words, and so many at least; for names of comments the share is larger.
MOST_OF_PAGE, MOST_WORDS, MOST_FOR_COMMENTS = 0.5, 30, 0.9
#: An article tag around less than this share of a page's text is one block of it like others.
LEAST_ARTICLE = 0.25

#: Pages labelled by hand, as markup and one label per block in page order (1: main text). {n} stands for n words of text,
#: the only thing about the text that the features see, {c} for a copyright line. The tree's table is made of these pages' blocks and their neighbours.
LABELLED_PAGES = [
    # articles with menus, adverts and footers
    ("<nav><a>{1}</a></nav><div class=ad>{6}</div><article><h1>{9}</h1><p>{80}</p><p>{3}</p><p>{45}</p></article><footer>{9}</footer>", "0011110"),
    ("<nav><ul><li><a>{1}</a><li><a>{1}</a><li><a>{2}</a></ul></nav><div class=advert>{30}</div><article><h1>{8}</h1><p>{1}</p></article><footer>{14}</footer>", "0000110"),
    ("<div class=ad>{9}</div><article><h1>{1}</h1><p>{1}</p></article><footer>{4}</footer>", "0110"),
    ("<header>{4}</header><main><h1>{1}</h1><p>{2}</p><p>{250}</p><p>{1}</p><p>{2}</p></main><footer><a>{1}</a> {2}</footer>", "0111110"),
    ("<div id=header>{5}</div><article><p>{700}</p></article><div id=footer>{90}</div>", "010"),
    ("<ul class=menu><li><a>{1}</a><li><a>{3}</a></ul><article><h1>{12}</h1><h2>{2}</h2><p>{30} <a>{4}</a> {20}</p><h2>{3}</h2><ul><li>{5}<li>{12}<li>{1}</ul><p>{60}</p></article><div class=sidebar><p>{40}</p><p>{25}</p></div>", "001111111100"),
    ("<article><h1>{5}</h1><p>{60}</p><p><a>{7}</a></p><p>{70}</p><p>{3} <a>{9}</a></p><p>{44}</p></article>", "111111"),
    ("<article><h1>{7}</h1><p><a>{2}</a></p><p>{12}</p><p><a>{9}</a></p><p>{33}</p><p>{11} <a>{20}</a></p></article>", "111111"),
    ("<article><p>{1}</p><p>{1}</p><p>{2}</p><p>{1}</p></article><div class=promo-box>{12}</div>", "11110"),
    ("<article><h1>{4}</h1><p>{20}</p><figure><figcaption>{c}</figcaption></figure><p>{30}</p></article><p>{c}</p>", "11110"),
    # lists of references belong to an article, rows of one-word links don't
    ("<article><h2>{5}</h2><p>{80}</p><ul><li><a>{5}</a><li><a>{9}</a><li><a>{7}</a><li><a>{12}</a></ul><p>{35}</p></article>", "1111111"),
    ("<article><p>{40}</p><p>{35}</p><h2>{1}</h2><p><a>{6}</a></p><p><a>{4}</a></p><p><a>{9}</a></p></article>", "111111"),
    ("<article><p>{90}</p><ol><li><a>{8}</a> {3}<li><a>{11}</a><li>{4} <a>{6}</a></ol></article>", "1111"),
    ("<article><h1>{6}</h1><ul><li><a>{1}</a><li><a>{1}</a><li><a>{1}</a><li><a>{1}</a></ul><p>{120}</p><p>{60}</p></article>", "1000011"),
    ("<article><p>{70}</p><p>{50}</p><div><a>{1}</a></div><div><a>{1}</a></div><div><a>{2}</a></div><div><a>{1}</a></div></article>", "110000"),
    # what stands in an article and is none of it
    ("<article><h1>{6}</h1><div class=byline>{4}</div><p>{90}</p><div class=share><a>{1}</a> <a>{1}</a></div><p>{50}</p><aside>{35}</aside><p>{40}</p><form>{5}</form></article>", "11101010"),
    ("<article><h1>{9}</h1><p>{120}</p><p>{60}</p><div id=comments><h3>{2}</h3><p>{30}</p><p>{75}</p><p>{1}</p></div></article>", "1110000"),
    ("<article><p>{55}</p><div class='newsletter signup'>{8}</div><p>{66}</p><div class=cookie-notice>{40}</div></article>", "1010"),
    ("<article><p>{55}</p><div class=ad-box>{20}</div><p>{4}</p><div class=related-links><ul><li><a>{6}</a><li><a>{8}</a></ul></div></article>", "10100"),
    ("<main><h1>{4}</h1><p>{70}</p><section class=comment-list><p>{110}</p><p>{9}</p></section></main>", "1111"),
    ("<main><h1>{4}</h1><p>{70}</p><section class=comments-list><p>{110}</p><p>{9}</p></section></main>", "1100"),
    ("<article><p>{80}</p><div class=related><h3>{2}</h3><a>{7}</a><p><a>{5}</a></p></div></article>", "1000"),
    ("<article><p>{80}</p><p>{40}</p><div class=share>{3}</div><div class=social><a>{2}</a></div></article>", "1100"),
    ("<article><p>{60}</p><div class=notice>{8}</div><div class=login>{4} <a>{2}</a></div></article>", "100"),
    # names that only sound like an aside: their text and their neighbours' tell
    ("<article class=share-price><h1>{5}</h1><p>{60}</p><p>{44}</p></article>", "111"),
    ("<article class=share>{60}</article>", "1"),
    ("<article class='post related'><h1>{3}</h1><p>{200}</p></article>", "11"),
    ("<nav><a>{1}</a></nav><article class=cookie-recipes><p>{25}</p><p>{8}</p><p>{90}</p></article><footer>{5}</footer>", "01110"),
    ("<article><h1>{6}</h1><p>{100}</p><div class=related-work><h2>{2}</h2><p>{80}</p><p>{30}</p><p>{6}</p></div><p>{50}</p></article>", "1111111"),
    ("<article><p>{90}</p><section id=search-results-discussed><p>{45}</p><p>{2}</p><p>{70}</p></section></article>", "1111"),
    ("<article><p>{90}</p><section id=search><h2>{3}</h2><p>{85}</p><p>{70}</p></section></article>", "1111"),
    ("<article><p>{50}</p><section class=navigation><p>{60}</p><p>{45}</p></section></article>", "111"),
    ("<article><p>{70}</p><div class=social-history>{35}</div><div class=navigation-instruments>{14}</div><p>{20}</p></article>", "1111"),
    ("<article><p>{70}</p><div class=related-stories><a>{9}</a></div><div class=social-icons><a>{1}</a></div><div class=share-facebook><a>{2}</a></div></article>", "1000"),
    ("<article><p>{30}</p><div class=promo-summer><a>{4}</a> {2}</div><div class=sponsor-acme><a>{12}</a></div><p>{30}</p></article>", "1001"),
    ("<article><p>{30}</p><div class=cookie-dough>{30}</div><div class=banner-making>{18}</div><p>{30}</p></article>", "1111"),
    # wrappers around a whole page
    ("<div class='page with sidebar'><h1>{5}</h1><p>{60}</p><p>{50}</p><div class=sidebar>{20}</div></div>", "1110"),
    ("<div class='sidebar-layout'><div><a>{1}</a></div><div>{70}</div><p>{40}</p></div>", "011"),
    ("<form><h1>{4}</h1><p>{90}</p><p>{40}</p></form>", "111"),
    ("<div id=modal-root class='nav-fixed'><h2>{2}</h2><p>{45}</p><h2>{3}</h2><p>{60}</p></div>", "1111"),
    ("<div class=has-newsletter><article><h1>{4}</h1><p>{50}</p><p>{3}</p></article><p>{c}</p></div>", "1110"),
    # no article: long text and what stands beside it
    ("<div class=nav><a>{1}</a> <a>{2}</a></div><h1>{8}</h1><p>{60}</p><p>{5}</p><p>{45}</p><div class=footer>{10}</div>", "011110"),
    ("<div><a>{2}</a></div><div><a>{1}</a></div><div>{12}</div><div>{55}</div><div>{35} <a>{3}</a></div><div><a>{2}</a></div>", "001110"),
    ("<h1>{1}</h1><p>{60}</p><h2>{1}</h2><p>{9}</p><h2>{1}</h2><p>{60}</p>", "111111"),
    ("<p>{1}</p><p>{60}</p><p>{1}</p><p>{9}</p><p>{1}</p><p>{60}</p>", "111111"),
    ("<p>{2}</p><p>{40}</p><p>{3}</p><p>{14}</p><p>{2}</p><p>{30}</p>", "111111"),
    ("<h1>{6}</h1><p>{4}</p><p>{30}</p><h2>{2}</h2><ul><li>{3}<li>{2}<li>{6}</ul><p>{25}</p>", "11111111"),
    ("<p><a>{1}</a></p><p>{3}</p><p><a>{1}</a></p><p>{4}</p><p><a>{3}</a></p>", "00000"),
    ("<p><a>{1}</a></p><p>{300}</p><p>{1}</p><p>{45}</p><p>{20} <a>{5}</a></p><p><a>{4}</a></p><p><a>{2}</a></p>", "0111100"),
    ("<p>{25}</p><p>{3}</p><p>{40}</p>", "111"),
    ("<p>{18} <a>{4}</a></p><p>{26}</p>", "11"),
    ("<p>{50}</p><p>{45}</p><p>{c}</p>", "110"),
    ("<div><a>{1}</a></div><p>{50}</p><p>{80}</p><p>{c}</p><div><a>{2}</a> <a>{1}</a></div>", "01100"),
    ("<h3><a>{3}</a></h3><p><a>{1}</a></p><h3><a>{2}</a></h3><p>{120}</p>", "0001"),
    ("<div class=sidebar>{60}</div><div class=banner>{25}</div><p>{150}</p><div class=comments><p>{50}</p><p>{20}</p></div>", "00100"),
    ("<p>{9} <a>{20}</a></p><p><a>{9}</a> {2}</p><p>{2} <a>{8}</a></p>", "000"),
    ("<h1>{5}</h1><p>{70}</p><p><a>{8}</a></p><p>{60}</p><div><a>{3}</a></div><div><a>{2}</a></div>", "111100"),
    # text outside the article of a page that has one
    ("<p>{8}</p><div>{30}</div><article><h1>{5}</h1><p>{140}</p></article><div>{25} <a>{3}</a></div><p>{2}</p><div>{40}</div><p>{1}</p>", "00110000"),
    ("<aside>{200}</aside><article><p>{800}</p><p>{2}</p><p>{800}</p></article><section>{60}</section>", "01110"),
    ("<div><a>{2}</a></div><article><h1>{5}</h1><p>{90}</p></article><div><a>{6}</a></div><div>{9}</div>", "01100"),
    ("<p>{90}</p><p>{110}</p><article><h1>{4}</h1><p>{150}</p></article>", "1111"),
    ("<article><p>{160}</p></article><div><p>{95}</p><p>{80}</p></div><p>{2}</p>", "1110"),
    ("<article><h1>{5}</h1><p>{300}</p><p>{200}</p></article><div><p>{120}</p><p>{140}</p><p>{90}</p></div><div><a>{3}</a></div>", "1111110"),
    # article tags around teasers of a page whose text stands elsewhere
    ("<div id=content><h1>{4}</h1><p>{400}</p></div><article><a>{8}</a></article>", "110"),
    ("<div>{800}</div><article><p><a>{6}</a></p></article><p>{300}</p>", "101"),
    ("<div><p>{120}</p><p>{3}</p><p>{200}</p></div><article><h3><a>{5}</a></h3><p><a>{9}</a></p></article><article><h3><a>{4}</a></h3><p><a>{2}</a></p></article>", "1110000"),
    ("<h1>{5}</h1><p>{300}</p><p>{250}</p><article>{30}</article><p>{90}</p>", "11111"),
]


def grow_tree(rows: list[tuple], depth: int = 8):
    """A decision tree by Gini impurity: (feature, threshold, left, right) or the share of main text in a leaf."""
    share = sum(r[-1] for r in rows) / len(rows)
    if depth == 0 or share in (0, 1):
        return share
    best = None
    for k in range(len(FEATURES)):
        values = sorted({r[k] for r in rows})
        for low, high in zip(values, values[1:], strict=False):
            cut = (low + high) / 2
            left, right = [r[-1] for r in rows if r[k] <= cut], [r[-1] for r in rows if r[k] > cut]
            gini = sum(2 * sum(side) * (len(side) - sum(side)) / len(side) for side in (left, right))
            if best is None or gini < best[0] - 1e-12:
                best = gini, k, cut
    if best is None:
        return share
    _, k, cut = best
    return k, cut, grow_tree([r for r in rows if r[k] <= cut], depth - 1), grow_tree([r for r in rows if r[k] > cut], depth - 1)


def tree_column(tree, features: dict[str, Column]) -> Column:
    """The tree as one expression."""
    if not isinstance(tree, tuple):
        return F.lit(tree >= 0.5)
    k, cut, left, right = tree
    return F.when(features[FEATURES[k]] <= F.lit(float(cut)), tree_column(left, features)).otherwise(tree_column(right, features))


#: What a name is worth: one of the list by itself, a doubtful one, and the same with other words beside them.
SURE, DOUBTFUL, PARTLY, HARDLY = 1.0, 0.6, 0.4, 0.2


def named_aside(names: list[str]) -> float:
    """How far a class or id names something beside the main text; words that name nothing are left out."""
    sure, doubtful = sum(n in ASIDE_NAMES for n in names), sum(n in DOUBTFUL_NAMES for n in names)
    if not sure and not doubtful:
        return 0.0
    other = sum(n not in ASIDE_NAMES and n not in DOUBTFUL_NAMES and n not in NEUTRAL_NAMES and not n.isdigit() for n in names)
    return (PARTLY if sure else HARDLY) if other else (SURE if sure else DOUBTFUL)


def hints_of(tag: str, attributes: str) -> tuple[bool, float, bool]:
    """Whether an element's tag says for certain that it isn't main text, how far its names, role or style say so, and whether they speak of comments."""
    aside, named, comments = tag in ASIDE_TAGS, SURE if tag == "form" else 0.0, False
    if not attributes:
        return aside, named, comments
    found = {}
    for m in ATTRIBUTE.finditer(attributes):
        found.setdefault((m[1] or m[5]).lower(), m[2] or m[3] or m[4] or "")
    if "hidden" in found or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", found.get("style", "")) or found.get("role", "").lower() in ASIDE_ROLES:
        named = SURE
    if tag in ("body", "html", "main"):
        return aside, named, False
    for group in [*found.get("class", "").split(), found.get("id", "")]:  # each name by itself
        parts = [p.lower() for p in NAME_PART.findall(group)]
        worth = named_aside(parts)
        named = max(named, worth)
        comments = comments or worth >= DOUBTFUL and bool(COMMENT_NAMES & set(parts))
    if tag == "article" and not comments:
        named = 0.0  # its tag says what it is
    return aside, named, comments


@cache
def closing_tag(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}\s*>", re.I)


class Tokens:
    """The tags of a page from left to right: (text before from, to, closing, name, attributes).

    Work is linear in the page: a quoted value that is never closed is looked for once, and quotes mean nothing from there on.
    """

    def __init__(self, page: str):
        self.page, self.at, self.quotes, self.last = page, 0, True, page.rfind(">")
        self.missing: set = set()  # closing tags that the rest of the page doesn't have

    def __iter__(self):
        page, text = self.page, self.at
        search = self.at
        while (lt := page.find("<", search)) >= 0:
            two = page[lt + 1 : lt + 2]
            if two in ("!", "?"):
                self.at = self._declaration(lt)
                yield text, lt, False, "", ""
            else:
                m = TAG_NAME.match(page, lt + 1)
                end = self._end(m.end()) if m else -1
                if end < 0:
                    search = lt + 1  # a plain character
                    continue
                self.at = end + 1
                yield text, lt, two == "/", m[1].lower(), page[m.end() : end]
            text = search = self.at
        yield text, len(page), False, "", ""

    def _declaration(self, lt: int) -> int:
        page = self.page
        if page.startswith("<!--", lt):
            end = COMMENT_END.search(page, lt + 2)
            return end.end() if end else len(page)
        close = "]]>" if page.startswith("<![CDATA[", lt) else ">"
        end = page.find(close, lt)
        return len(page) if end < 0 else end + len(close)

    def _end(self, at: int) -> int:
        """Where the tag's ``>`` stands, outside of quotes."""
        start = at
        if start > self.last:
            return -1
        while self.quotes and (m := QUOTE_OR_END.search(self.page, at)):
            if m[0] == ">":
                return m.start()
            at = self.page.find(m[0], m.end()) + 1
            if not at:
                break
        self.quotes = False
        return self.page.find(">", start)

    def skip_to(self, pattern: re.Pattern) -> re.Match | None:
        """The next match ahead; a pattern once missing is not looked for again."""
        if pattern in self.missing:
            return None
        m = pattern.search(self.page, self.at)
        if m is None:
            self.missing.add(pattern)
        return m


class Blocks:
    """A page's text blocks as they come, with the ranges of blocks that named elements hold."""

    def __init__(self):
        self.rows: list[tuple] = []  # text, words, words in links, certainly aside, in an article, heading
        self.hints: list[list] = []  # first block, one behind the last, worth, comments, in an article
        self.stack: list[tuple] = []  # tag, aside, hint, comments, article
        self.open_tags: Counter = Counter()

    def open(self, tag: str, aside: bool, named: float, comments: bool, article: bool) -> None:
        hint = None
        if named:
            hint = [len(self.rows), None, named, comments, self.stack[-1][4] if self.stack else False]
            self.hints.append(hint)
        self.stack.append((tag, aside, hint, comments, article))
        self.open_tags[tag] += 1

    def close(self, tag: str) -> None:
        if self.open_tags[tag]:
            while True:
                gone = self.stack.pop()
                self.open_tags[gone[0]] -= 1
                if gone[2] is not None:
                    gone[2][1] = len(self.rows)
                if gone[0] == tag:
                    break

    def leave_all(self) -> None:
        for x in self.stack:
            if x[2] is not None:
                x[2][1] = len(self.rows)
        self.stack.clear()
        self.open_tags.clear()

    def judged(self) -> list[tuple[str, int, int, float, float, bool, bool]]:
        """(text, words, words in links, place, named, heading, notice) of the blocks that no tag rules out.

        ``place`` is 1 and the articles' share of the page's text inside an article, 1 less that share outside. A name that covers most of a page or of its articles says nothing about them.
        """
        n = len(self.rows)
        words = [0] * (n + 1)
        in_article = [0] * (n + 1)
        for k, (_, w, _, aside, article, _) in enumerate(self.rows):
            words[k + 1] = words[k] + (0 if aside else w)
            in_article[k + 1] = in_article[k] + (w if article and not aside else 0)
        for h in self.hints:
            h[1] = n if h[1] is None else h[1]

        def covered(hints: list[list]) -> list[float]:
            worth = [0.0] * n
            for level in (HARDLY, PARTLY, DOUBTFUL, SURE):
                edges = [0] * (n + 1)
                for a, z, w, *_ in hints:
                    if w == level:
                        edges[a] += 1
                        edges[z] -= 1
                depth = 0
                for k in range(n):
                    depth += edges[k]
                    if depth:
                        worth[k] = level
            return worth

        def share(worth: list[float]) -> float:
            own = [(w, article) for (_, w, _, aside, article, _), named in zip(self.rows, worth, strict=True) if not aside and named < SURE]
            return sum(w for w, article in own if article) / (sum(w for w, _ in own) or 1)

        def means_something(h: list, most: int, total: list[int]) -> bool:
            held = total[h[1]] - total[h[0]]
            return held < MOST_WORDS or held <= most * (MOST_FOR_COMMENTS if h[3] else MOST_OF_PAGE)

        hints = [h for h in self.hints if not h[4] or means_something(h, in_article[n], in_article)]
        worth = covered(hints)
        part = share(worth)
        if part < LEAST_ARTICLE:
            hints = [h for h in hints if means_something(h, words[n], words)]
            worth = covered(hints)
            part = share(worth)
        return [(text, w, links, 1 + part if article else 1 - part, named, heading, w <= 40 and bool(NOTICE.search(text))) for (text, w, links, aside, article, heading), named in zip(self.rows, worth, strict=True) if not aside]


def blocks_of(page: str | None) -> list[tuple[str, int, int, float, float, bool, bool]]:
    """The text blocks of a page in its order, as :meth:`Blocks.judged` gives them; what stands in menus, footers and the like for certain is left out."""
    return parsed(page).judged() if page else []


def parsed(page: str) -> Blocks:
    """A page cut into text blocks."""
    found = Blocks()
    pieces, links = [], 0
    outside = ("", False, None, False, False)
    in_link, skipping, aside, article, heading = False, None, False, False, False
    own: list | None = None  # a paragraph's or list item's own name

    def flush() -> None:
        nonlocal links
        text = " ".join("".join(pieces).split())
        if text:
            found.rows.append((text, text.count(" ") + 1, links, aside, article, heading))
            if own is not None:
                found.hints.append([len(found.rows) - 1, len(found.rows), *own])
        pieces.clear()
        links = 0

    tokens = Tokens(page)
    for a, b, closing, tag, attributes in tokens:
        if a < b and skipping is None:
            text = entities.unescape(page[a:b])
            pieces.append(text)
            if in_link:
                links += len(text.split())
        if not tag:
            continue
        if skipping is not None:
            if closing and tag == skipping:
                skipping = None
            continue
        if tag in SKIPPED_TAGS and not closing and not attributes.endswith("/"):
            if tag in RAW_TAGS:  # its content is not markup
                end = tokens.skip_to(closing_tag(tag))
                tokens.at = end.end() if end else len(page)
            elif tag == "head":
                end = tokens.skip_to(HEAD_END)
                tokens.at = (end.end() if end[0].startswith("</") else end.start()) if end else tokens.at
            elif tag not in VOID_TAGS and tokens.skip_to(closing_tag(tag)):
                skipping = tag
            continue
        if tag == "a":
            in_link = not closing
        elif tag == "br":
            pieces.append(" ")
        elif tag in BLOCK_TAGS:
            flush()
            in_link, own, heading = False, None, False
            inside = found.stack[-1] if found.stack else outside
            if tag in CONTAINERS:
                if closing:
                    found.close(tag)
                else:
                    certain, named, comments = hints_of(tag, attributes)
                    new = tag in ("article", "main")
                    if new and not inside[3] and not inside[4] and (inside[1] or any(x[2] is not None for x in found.stack)):
                        found.leave_all()  # an article ends a menu or notice left open before it
                        inside = outside
                    if tag == "header":
                        certain = certain or not inside[4]
                    found.open(tag, inside[1] or certain, named, inside[3] or comments, inside[4] or new and not (inside[1] or certain))
                inside = found.stack[-1] if found.stack else outside
                aside, article = inside[1], inside[4]
            else:
                aside, article = inside[1], inside[4]
                if not closing:
                    heading = tag in HEADINGS
                    if attributes:  # a paragraph or list item can be a notice by itself
                        certain, named, comments = hints_of(tag, attributes)
                        aside = aside or certain
                        own = [named, comments, article] if named else None
    flush()
    return found


def labelled_blocks(pages: list[tuple[str, str]] = LABELLED_PAGES) -> list[tuple]:
    """The features (``FEATURES``) and label of each block of the labelled pages; blocks that their tags rule out are labelled 0 and left out."""
    rows = []
    for markup, labels in pages:
        every = re.sub(r"\{(\d+)\}", lambda m: " ".join(["word"] * int(m[1])), markup).replace("{c}", "© 2020 Acme Ltd. All rights reserved.")
        found = parsed(every)
        if len(found.rows) != len(labels):
            raise ValueError(f"{len(found.rows)} blocks, {len(labels)} labels: {markup}")
        blocks, own = found.judged(), [int(label) for row, label in zip(found.rows, labels, strict=True) if not row[3]]
        around = [(0, 0.0), *((words, links / words) for _, words, links, *_ in blocks), (0, 0.0)]
        for k, ((_, _, _, place, named, heading, notice), label) in enumerate(zip(blocks, own, strict=True), 1):
            (before, links_before), (words, density), (after, links_after) = around[k - 1 : k + 2]
            rows.append((place, named, int(heading), int(notice), density, words, links_before, links_after, before, after, label))
    return rows


def page_blocks(pages: DataFrame, html: str = "html", column: str = "blocks") -> DataFrame:
    """Add ``column``: the page's blocks as an array of (text, words, links, place, named, heading, notice). Null pages have none."""
    names = ("text", "words", "links", "place", "named", "heading", "notice")
    fields = f"`{column}` array<struct<text: string, words: int, links: int, place: double, named: double, heading: boolean, notice: boolean>>"
    return add_columns(pages, html, fields, lambda: lambda values: [[[dict(zip(names, b, strict=True)) for b in blocks_of(x)] for x in values]])


def extract_text(pages: DataFrame, html: str = "html", column: str = "text", labelled: list[tuple[str, str]] | None = None) -> DataFrame:
    """Add ``column``: the main text of each page, kept blocks joined by a line feed in page order.

    Python only cuts a page into blocks; neighbours' features and the tree, trained here on the blocks of the
    labelled pages (``LABELLED_PAGES``), are Spark expressions over the array of blocks, so no shuffle is needed and pages
    stay whole. Menus, footers and asides by tag are out; of all else, in an article or not and whatever its names, the tree decides by the block's and its neighbours' words and links.

    Null and empty pages give an empty text. All rows stay, repeated ones alike, and empty tables stay empty; a page of any length is one row's work, linear in it. A column of this name is replaced.
    """
    tree = grow_tree(labelled_blocks(labelled or LABELLED_PAGES))
    blocks = fresh(pages, "_blocks")[0]
    kept = [F.col(f"`{c}`") for c in others(pages, (column,))]
    made = page_blocks(pages, html, blocks)
    density = lambda b: F.when(b["words"] > 0, b["links"] / b["words"]).otherwise(F.lit(0.0))
    none = F.struct(*[F.lit(v).alias(n) for n, v in (("text", ""), ("words", 0), ("links", 0), ("place", 0.0), ("named", 0.0), ("heading", False), ("notice", False))])

    def keep(block: Column, i: Column) -> Column:
        before = F.coalesce(F.get(blocks, i - 1), none)
        after = F.coalesce(F.get(blocks, i + 1), none)
        features = {
            "words": block["words"], "density": density(block), "prev_words": before["words"], "prev_density": density(before), "next_words": after["words"], "next_density": density(after),
            "place": block["place"], "named": block["named"], "heading": block["heading"].cast("int"), "notice": block["notice"].cast("int"),
        }
        return tree_column(tree, features)

    text = F.array_join(F.transform(F.filter(blocks, keep), lambda b: b["text"]), "\n")
    return made.select(*kept, text.alias(column))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_text(pages).select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))
