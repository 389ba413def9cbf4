"""Main text of web pages by a site style tree.

1. Each page is parsed to its block elements. Elements at the same path (tag,
   class and id names from the root) on pages of one host are one node of the
   host's style tree.
2. A node's presentation importance is the entropy of its styles (the sequence
   of its children) over the pages that have it; its content importance is one
   minus the mean entropy, over those pages, of its text blocks: what every
   page repeats has an entropy of 1 and no importance. Both scale down with the
   share of link text. A branch is as important as its most important node.
3. Nodes that markup itself names as noise (navigation, adverts, comments and the
   like, by tag, role, class or id) have importance 0. A class, an id or a form
   doesn't do so alone: see :meth:`Page.kept` for containers that hold the article
   or most of the text. Their blocks are in the tree, which decides then.
4. Branches below the threshold are removed from each page. What a page marks as
   its article counts first, then its main part, then all (:func:`main_blocks`); a marked part
   that holds less text than what surrounds it is none. Such a mark is a prior: links
   don't lower the importance of what it holds, and if more than half of its text
   would go, it stays whole.

Counts per host and node come from partial aggregates, and entropies are sums of
counts times their logarithms, so a host with a third of the pages is no group in
one task and nothing is joined before it is summed; pages are never shuffled while the table
of unimportant nodes stays within a checked bound (beyond it, pages are joined by
key). Each page is parsed twice, which is cheaper than storing it parsed. Elements more than
512 deep continue at that depth, as in browsers, so a page takes memory in proportion to its length.

Defined cases: NULL or empty html gives the empty text; a NULL or malformed url
belongs to the host without a name; equal rows are extracted each, but copies of a
page on a host count as one page in the tree; texts are whole, whatever their length; broken markup
never fails (unclosed elements end with their parent, stray ends are ignored);
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripspark.llm.common import stored, text_or_empty

# Element kinds of HTML, and names that mark noise and content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var".split())
NOISE_TAGS = frozenset("nav aside footer form button select option input textarea script style noscript template iframe "
                       "svg canvas dialog menu head title object embed audio video map datalist".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar "
                        "toolbar tablist".split())
NOISE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navigation menu "
    "submenu breadcrumb breadcrumbs pagination pager header masthead topbar footer foot sidebar aside rail cookie cookies consent gdpr "
    "notice notification alert popup modal overlay newsletter subscribe subscription signup login share sharing social follow "
    "related recommended recommendations trending comment comments commentlist discussion replies respond disqus "
    "widget toolbar search skip copyright legal disclaimer paywall teaser teasers".split())
ARTICLE_NAMES = frozenset("article articlebody article-body article-content post-content post-body entry-content story-body "
                          "story-content".split())
MAIN_NAMES = frozenset("main content main-content page-content maincontent post entry story".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
#: Names of parts whose text differs on every page without being its main text.
SIDE_NAMES = frozenset("comment comments commentlist discussion replies respond disqus related recommended recommendations trending "
                       "teaser teasers promo promotion".split())

_NAME = re.compile(r"[A-Za-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_PLAIN, _MAIN, _ARTICLE = 0, 1, 2
_CLEAN, _NAMED, _SIDE, _NOISE = 0, 1, 2, 3  # no noise; by a name or a form, which may hold the page; by a side name; certain


#: Depth at which elements are nested no further.
DEEPEST = 512


@dataclass(frozen=True)
class Block:
    """A text block: the path of its element, its words, how many characters are link text, its zone, the
    container that gives it the zone (a number, 0 for none), and the innermost element around it that a
    name calls noise (a number, -1 for none)."""

    path: int
    words: str
    link_chars: int
    zone: int
    container: int
    named: int


@dataclass(frozen=True)
class _Named:
    """An element that a name calls noise: the one around it (-1: none), the zone around it, and is it a side part?"""

    around: int
    zone: int
    side: bool


@dataclass
class Page:
    """A parsed page: its text blocks, the styles and the parent of each path, its containers of marked text (the
    one around each) and the elements that a name calls noise."""

    blocks: list[Block] = field(default_factory=list)
    styles: dict[int, list[str]] = field(default_factory=lambda: defaultdict(list))
    parents: dict[int, int] = field(default_factory=dict)
    containers: list[tuple[int, int]] = field(default_factory=lambda: [(0, _PLAIN)])  # the one around, zone
    named: list[_Named] = field(default_factory=list)

    def chain(self, path: int) -> list[int]:
        """A path and its ancestors."""
        out = [path]
        while path in self.parents:
            path = self.parents[path]
            out.append(path)
        return out

    def kept(self) -> list[Block]:
        """The blocks that are no noise. A name doesn't make an element noise that holds an article or main
        part, or more than half of the text of a page on which no mark tells the main text. A side part must
        hold more than half in any case, and a better mark than all that is left, or leave nothing."""
        if not self.named:
            return self.blocks
        chars, marks = [0] * len(self.named), [_PLAIN] * len(self.named)
        best_zone = [_PLAIN] * len(self.named)
        for b in self.blocks:
            if b.named >= 0:
                chars[b.named] += len(b.words)
                best_zone[b.named] = max(best_zone[b.named], b.zone)
        for e in reversed(range(len(self.named))):  # inner elements come after those around them
            own = self.named[e]
            marks[e] = best_zone[e] if best_zone[e] > own.zone else _PLAIN
            if own.around >= 0:
                chars[own.around] += chars[e]
                best_zone[own.around] = max(best_zone[own.around], best_zone[e])
        half = sum(len(b.words) for b in self.blocks) / 2
        lifted = {e for e, x in enumerate(self.named) if marks[e] and not x.side}

        def left() -> tuple[list[Block], int]:
            clear: list[bool] = []  # is the element lifted, and all around it?
            for e, x in enumerate(self.named):
                clear.append(e in lifted and (x.around < 0 or clear[x.around]))
            blocks = [b for b in self.blocks if b.named < 0 or clear[b.named]]
            return blocks, max((b.zone for b in blocks), default=_PLAIN)

        _, best = left()
        lifted |= {e for e, x in enumerate(self.named) if chars[e] > half and not x.side and (x.zone > best or best == _PLAIN)}
        blocks, best = left()
        lifted |= {e for e, x in enumerate(self.named) if chars[e] > half and x.side and (marks[e] > best or not blocks)}
        return left()[0]


def main_blocks(page: Page) -> tuple[list[Block], int]:
    """The blocks of the page's main text, and the zone that decided.

    Text is counted per container: an article (the outermost one) or a main part. Articles that each hold more text
    than the level around them (the main part, or the page outside of any) are the main text. If there
    is none, articles are cards beside it and go; then the main part is the main text if it holds
    half or more of what is left, else all that is left."""
    blocks = page.kept()
    chars, outside = Counter(), Counter()  # per container: its text; the text of its level outside of articles
    for b in blocks:
        chars[b.container] += len(b.words)
        if b.zone < _ARTICLE:
            outside[b.zone] += len(b.words)

    def surrounding(container: int) -> int:
        around = page.containers[container][0]
        return outside[page.containers[around][1]]

    articles = {c for c, (_, zone) in enumerate(page.containers) if zone == _ARTICLE and chars[c]}
    held = {c for c in articles if chars[c] > surrounding(c)}
    if held:
        return [b for b in blocks if b.container in held], _ARTICLE
    rest = [b for b in blocks if b.zone < _ARTICLE]
    if outside[_MAIN] and outside[_MAIN] >= outside[_PLAIN]:
        return [b for b in rest if b.zone == _MAIN], _MAIN
    return rest, _PLAIN


@dataclass
class _Open:
    tag: str
    path: int
    noise: bool
    zone: int
    inline: bool
    named: int = -1
    container: int = 0
    depth: int = 0


def _label(tag: str, attributes: str, inside: int) -> tuple[str, int, int]:
    """An element's name in paths, in what way its markup names it noise, and its zone.
    A header is noise on a page, but not ``inside`` an article, where it holds the title."""
    given: dict[str, str] = {}
    if attributes.strip(" /"):
        for name, value in _ATTRIBUTE.findall(attributes):
            given.setdefault(name.lower(), unescape(value.strip("\"'")))
    marks = f"{given.get('class', '')} {given.get('id', '')}".split()
    words = {w.lower() for m in marks for w in _NAME.findall(_CAMEL.sub(" ", m))}
    names = {m.lower() for m in marks}
    role = given.get("role", "").lower()
    prop = given.get("itemprop", "").lower()
    zone = _ARTICLE if tag == "article" or role == "article" or prop == "articlebody" or names & ARTICLE_NAMES else (
        _MAIN if tag == "main" or role == "main" or names & MAIN_NAMES else _PLAIN)
    hidden = "hidden" in given or given.get("aria-hidden", "").lower() == "true" or bool(
        re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", given.get("style", "").lower()))
    form = tag == "form" or role == "form"
    marked = set() if tag in ("html", "body") or (zone and not words & {"comment", "comments"}) else words & NOISE_NAMES
    if inside:
        marked -= {"header"}
    if marked & SIDE_NAMES:
        zone = _PLAIN  # an article of comments is none of the page
    if hidden or (tag in NOISE_TAGS and tag != "form") or (tag == "header" and not inside) or (role in NOISE_ROLES and not form):
        noise = _NOISE
    elif marked & SIDE_NAMES:
        noise = _SIDE
    else:
        noise = _NAMED if form or marked else _CLEAN
    return ".".join([tag, *sorted(words)]), noise, zone


def parse(html: str | None) -> Page:
    """Blocks and styles of a page. Text within certain noise is left out; :meth:`Page.kept` judges the rest."""
    page, html = Page(), html or ""
    stack = [_Open("", 0, False, _PLAIN, False)]
    open_tags: Counter[str] = Counter()
    text: list[str] = []
    link = [0]

    def flush() -> None:
        words = " ".join("".join(text).split())
        if words:
            top = stack[-1]
            page.blocks.append(Block(top.path, words, min(link[0], len(words)), top.zone, top.container, top.named))
        text.clear()
        link[0] = 0

    def add(raw: str) -> None:
        if raw and not stack[-1].noise:
            plain = unescape(raw) if "&" in raw else raw
            text.append(plain)
            if open_tags["a"]:
                link[0] += len(plain.strip())

    def close(upto: int) -> None:
        if any(not x.inline for x in stack[upto:]):
            flush()
        open_tags.subtract(x.tag for x in stack[upto:])
        del stack[upto:]

    at = 0
    while token := _TOKEN.search(html, at):
        add(html[at:token.start()])
        at = token.end()
        slash, tag, attributes = (token[1], token[2], token[3]) if token[2] else (token[4], token[5], token[6])
        if not tag:
            continue
        tag = tag.lower()
        if slash:
            if open_tags[tag]:
                close(next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag))
            elif tag == "p" or tag == "br":
                flush()
            continue
        if tag == "br" or tag == "hr":
            flush()
        if tag in VOID:
            continue
        inline = tag in INLINE
        if not inline:
            _close_implied(stack, tag, close, open_tags)
            flush()
        top = stack[-1]
        name, noise, zone = _label(tag, attributes, top.zone)
        depth = top.depth
        if inline:
            path = top.path
        else:
            above = top.path if depth < DEEPEST else page.parents[top.path]
            depth = min(depth + 1, DEEPEST)
            path = xxhash.xxh64_intdigest(f"{above}/{name}") >> 1
            page.parents[path] = above
            children = page.styles[above]
            if not children or children[-1] != name:
                children.append(name)
            page.styles[path]  # noqa: B018  an element without children has the empty style
        if tag in RAW:
            end = _RAW_ENDS[tag].search(html, at)
            at = end.end() if end else len(html)
            continue
        if noise and not top.noise and not inline:
            flush()
        if noise and inline:
            noise = _NOISE
        named = top.named
        if noise in (_NAMED, _SIDE) and not top.noise:
            page.named.append(_Named(named, top.zone, noise == _SIDE))
            named = len(page.named) - 1
        container = top.container
        if zone > top.zone:
            page.containers.append((container, zone))
            container = len(page.containers) - 1
        open_tags[tag] += 1
        stack.append(_Open(tag, path, noise == _NOISE or top.noise, max(zone, top.zone), inline, named, container, depth))
    add(html[at:])
    flush()
    return page


_RAW_ENDS = {tag: re.compile(rf"</{tag}\b[^>]*>", re.I) for tag in RAW}
_CLOSES_P = frozenset("address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                      "header hr main menu nav ol p pre section table ul".split())
_SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
             "th": ("td", "th"), "option": ("option",), "tbody": ("thead", "tbody", "tr", "td", "th")}


def _close_implied(stack: list[_Open], tag: str, close, open_tags: Counter[str]) -> None:
    """A paragraph ends where a block begins, a list item at the next one, and so on."""
    if tag in _CLOSES_P and open_tags["p"]:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag == "p":
                close(k)
                break
            if not stack[k].inline:
                break
    while any(stack[-1].tag == t for t in _SIBLINGS.get(tag, ())):
        close(len(stack) - 1)


def main_text(html: str | None, unimportant: frozenset[int] | set[int] = frozenset(),
              repeated: frozenset[int] | set[int] = frozenset()) -> str:
    """The page's main text: blocks joined by one space. Of the part that the page marks, ``repeated``
    branches go, unless they are more than half of it; of a page without marks, ``unimportant`` ones.
    (A branch is at least as important as any within it, so a block goes if and only if its own element's branch does.)"""
    own, zone = main_blocks(parse(html))
    if zone == _PLAIN:
        return " ".join(b.words for b in own if b.path not in unimportant)
    left = [b.words for b in own if b.path not in repeated]
    if 2 * sum(map(len, left)) < sum(len(b.words) for b in own):
        left = [b.words for b in own]
    return " ".join(left)


# --- the style tree ---------------------------------------------------------------------------

_TREE = "host string, page bigint, path bigint, parents array<bigint>, style bigint, feature bigint, n bigint, chars bigint, link_chars bigint"


def _tree_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per page: a row for each path (with ``style``) and one for each text block of a path (with ``feature``)."""
    for batch in batches:
        out = []
        for host, page, html in zip(batch["host"], batch["page"], batch["html"]):
            tree = parse(html)
            chars, links, features = Counter(), Counter(), Counter()
            for b in tree.blocks:
                chars[b.path] += len(b.words)
                links[b.path] += b.link_chars
                features[b.path, xxhash.xxh64_intdigest(b.words) >> 1] += 1
            for path in chars:
                style = xxhash.xxh64_intdigest(" ".join(tree.styles.get(path, ()))) >> 1
                out.append((host, page, path, tree.chain(path), style, None, 1, chars[path], links[path]))
            out += [(host, page, path, None, None, f, n, 0, 0) for (path, f), n in features.items()]
        frame = pd.DataFrame(out, columns=["host", "page", "path", "parents", "style", "feature", "n", "chars", "link_chars"])
        yield frame.astype({"style": "Int64", "feature": "Int64"})


def host_of(url: str | Column) -> Column:
    """Host of a url in lower case, without user and port; empty if there is none."""
    own = F.regexp_extract(F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit("")),
                           r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(own)


def branch_importance(pages: DataFrame) -> DataFrame:
    """``host, path, importance, variety`` (0 to 1; variety is importance without regard to links) of
    every branch that holds text; ``pages``: ``host, page, html``.
    Copies of a page (equal ``host`` and ``page``) count once."""
    rows = stored(pages.mapInPandas(_tree_rows, _TREE).dropDuplicates(["host", "page", "path", "feature"]))
    nodes = rows.where("style IS NOT NULL")
    sizes = nodes.groupBy("host", "path").agg(
        F.sum("n").alias("pages"), F.sum("chars").alias("chars"), F.sum("link_chars").alias("link_chars"),
        F.min("parents").alias("parents"))

    # The entropy of counts n with the sum c is log(c) - sum(n * log(n)) / c; to the base of the number of
    # pages it is divided by log(pages), at the end, as that is one number per node.
    log_n = F.col("n") * F.log("n")
    styles = nodes.groupBy("host", "path", "style").agg(F.sum("n").alias("n")).groupBy("host", "path").agg(
        F.sum("n").alias("shown"), F.sum(log_n).alias("style_spread"))
    content = rows.where("feature IS NOT NULL").groupBy("host", "path", "feature").agg(
        F.sum("n").alias("c"), F.sum(log_n).alias("c_spread")).groupBy("host", "path").agg(
        F.avg(F.log("c") - F.col("c_spread") / F.col("c")).alias("mean_entropy"))
    base = F.log("pages")
    presentation = F.when(F.col("pages") > 1, (F.log("shown") - F.col("style_spread") / F.col("shown")) / base).otherwise(F.lit(1.0))
    varied = F.when(F.col("mean_entropy").isNull(), F.lit(0.0)).when(
        F.col("pages") > 1, F.lit(1.0) - F.least(F.lit(1.0), F.col("mean_entropy") / base)).otherwise(F.lit(1.0))
    own = sizes.join(styles, ["host", "path"]).join(content, ["host", "path"], "left").withColumn(
        "varies", F.greatest(varied, F.lit(0.5) * presentation)).withColumn(
        "own", F.col("varies") * (F.lit(1.0) - F.col("link_chars") / F.greatest("chars", F.lit(1))))
    return own.select("host", F.explode("parents").alias("path"), "own", "varies").groupBy("host", "path").agg(
        F.max("own").alias("importance"), F.max("varies").alias("variety"))


def extract(pages: DataFrame, *, threshold: float = 0.2, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html", broadcast_rows: int = 1_000_000) -> DataFrame:
    """``page_id, url, text, n_chars``: one row per page."""
    html = text_or_empty(html_col)
    own = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host_of(url_col).alias("host"), html.alias("html"))
    keyed = own.withColumn("page", F.xxhash64("host", "html"))
    low = stored(branch_importance(keyed.select("host", "page", "html")).where(F.col("importance") < threshold).select(
        "host", "path", (F.col("variety") < threshold).alias("repeated")))

    @F.pandas_udf("string")
    def texts(htmls: pd.Series, unimportant: pd.Series, repeated: pd.Series) -> pd.Series:
        return pd.Series([main_text(h, set() if u is None else set(u), set() if r is None else set(r))
                          for h, u, r in zip(htmls, unimportant, repeated)], dtype=object)

    # Broadcast only up to a checked number of rows (16 bytes each and the host's name once);
    # beyond that, each host's list goes to its pages by a shuffled join.
    by_host = low.groupBy("host").agg(F.sort_array(F.collect_set("path")).alias("unimportant"),
                                      F.sort_array(F.collect_set(F.when(F.col("repeated"), F.col("path")))).alias("repeated"))
    if low.count() <= broadcast_rows:
        by_host = F.broadcast(by_host)
    marked = own.join(by_host, "host", "left")
    out = marked.select("page_id", "url", texts("html", "unimportant", "repeated").alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
