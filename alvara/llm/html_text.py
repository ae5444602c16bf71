"""HTML extraction by equivalence classes of tokens.

Tokens are tags (name, class, id and role; one with an id also without its value) and
whole texts between tags. The occurrence vector of a token is its count on every page of
a host; tokens with equal vectors form a class. The tokens that nearly all pages have
exactly once (``ROOT_SHARE``) are the root of the host's template; classes of two or more tokens that repeat together on most pages are nested in
its slots as lists. A class is valid on a page if its tokens come in the template's
order; others are skipped there. Slots are what lies between matched root tokens, and
the tags that are open around a slot say what it is. The text of the article's slots is
the result. An article is named by root tags and by article and main tags of the page, or
where it has neither by other marks of the page. Where nothing names one, the result is
the text of all slots that aren't named as something else, without blocks of nothing but
links of a list or nothing but the template's texts.

Vectors are compared by a digest that is summed over pages, so a host with any number
of pages is folded before the shuffle, and nothing of a host is gathered but its
template. Hosts with fewer than ``LEAST_PAGES`` pages use the template over all hosts.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, table, tidy

LEAST_PAGES = 5
#: Share of a host's pages that a list class occurs on at least.
LIST_SHARE = 0.5
#: Share of a host's pages that a root token occurs on exactly once at least.
ROOT_SHARE = 0.8
ALL = "*"

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|title|iframe|svg)\b[^>]*>.*?(?:</\1\s*>|\Z)"""
    r"""|</?[a-zA-Z](?:[^>"']+|"[^"]*"|'[^']*')*>?|<[!?][^>]*>?|[^<]+|<""", re.S | re.I)
NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
MARKS = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split())
DROPPED = frozenset(
    "aside button dialog footer form head header iframe input menu nav noscript option script select style svg "
    "template textarea title".split())
ARTICLE = frozenset(["article", "main"])
OTHER_MARK = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adverts?|sponsor\w*|promo\w*|banner|sidebar|side|menu|nav\w*|breadcrumbs?|header|"
    r"masthead|footer|comments?|commentlist|disqus|replies|reply|notices?|cookies?|consent|popup|modal|newsletter|"
    r"subscribe|share|sharing|social|related|widgets?|forms?|login|search|toolbar|complementary|navigation|"
    r"contentinfo|alert)(?:$|[\s_-])", re.I)
#: Tags that words of class or id never leave out: they tell how a page or heading looks.
FRAME = frozenset("html body main h1 h2 h3 h4 h5 h6".split())
OTHER_ARTICLE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|comments?|replies|reply|related|widgets?)(?:$|[\s_-])", re.I)
ARTICLE_MARK = re.compile(
    r"(?:^|[\s_-])(?:article|main|content|post|entry|story)(?:$|[\s_-]body|[\s_-]content|[\s_-]text|\s)", re.I)


def host_of(url: str | None) -> str:
    """The authority of a url in lower case, without user and port; '' if there is none."""
    m = re.match(r"\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", url or "")
    return m[1].rpartition("@")[2].partition(":")[0].lower() if m else ""


class Token:
    """One tag or text of a page."""

    __slots__ = ("name", "closes", "marks", "text", "key", "bare")

    def __init__(self, raw: str, raw_name: str | None):
        self.name = self.text = self.key = self.bare = None
        self.closes, self.marks = False, ""
        m = NAME.match(raw) if raw.startswith("<") and raw_name is None else None
        if raw_name is not None:  # an element whose content is no markup
            self.name, self.text = raw_name.lower(), ""
        elif m:
            self.name, self.closes = m[1].lower(), raw.startswith("</")
            if not self.closes:
                self.marks = " ".join(sorted(
                    f"{k.lower()}={(a or b or c).strip().lower()}" for k, a, b, c in MARKS.findall(raw)))
            self.key = f"{'/' if self.closes else ''}{self.name} {self.marks}".strip()
            if "id=" in self.marks:  # ids may name the page
                self.bare = f"{self.name} " + " ".join(sorted({"id", *(
                    f"{k.lower()}={(a or b or c).strip().lower()}"
                    for k, a, b, c in MARKS.findall(raw) if k.lower() != "id")}))
        elif not raw.startswith(("<!", "<?")):
            self.text = unescape(raw)
            bare = " ".join(self.text.split())
            if bare:
                self.key = "#" + xxhash.xxh3_64_hexdigest(bare)

    @property
    def values(self) -> str:
        return " ".join(part.partition("=")[2] if "=" in part else part for part in self.marks.split(" "))

    @property
    def other(self) -> bool:
        """Whether this opening tag names something that isn't the article."""
        if self.name in DROPPED or not self.marks or self.name in FRAME:
            return self.name in DROPPED
        return bool((OTHER_ARTICLE if self.name == "article" else OTHER_MARK).search(self.values))

    @property
    def article(self) -> bool:
        return self.name in ARTICLE or bool(self.marks) and self.name not in ("html", "body") and bool(
            ARTICLE_MARK.search(self.values))


def tokens(html: str | None) -> list[Token]:
    return [Token(m[0], m[1]) for m in TOKEN.finditer(html or "")]


def vectors(html: str | None) -> dict[str, tuple[int, int]]:
    """Token to its count on the page and where it comes first."""
    first, count = {}, Counter()
    for at, token in enumerate(tokens(html)):
        for key in (token.key, token.bare):
            if key is not None:
                count[key] += 1
                first.setdefault(key, at)
    return {k: (n, first[k]) for k, n in count.items()}


def matched(page: list[Token], root: list[str]) -> set[int]:
    """Positions of the root tokens that come in the template's order."""
    place = {key: k for k, key in enumerate(root)}
    # longest increasing run of places: what else is on the page came out of order
    tails, ends, back = [], [], {}
    for at, token in enumerate(page):
        k = place.get(token.key, place.get(token.bare))
        if k is None:
            continue
        i = bisect_left(tails, k)
        back[at] = ends[i - 1] if i else -1
        if i == len(tails):
            tails.append(k)
            ends.append(at)
        else:
            tails[i], ends[i] = k, at
    out, at = set(), ends[-1] if ends else -1
    while at >= 0:
        out.add(at)
        at = back[at]
    return out


def article_text(html: str | None, root: list[str], lists: list[str]) -> str:
    """The main text of a page under a template: root tokens in order, tokens of lists."""
    page = tokens(html)
    fixed, known = matched(page, root), set(root)
    links = {key for key in lists if key == "a" or key.startswith("a ")}
    marked = [t for t in page if t.name and t.article and not t.closes and not t.other]
    sure = [t for t in marked if t.name in ARTICLE or fixed and (t.key in known or t.bare in known)]
    text, found = _article(page, fixed, set(map(id, sure if fixed and sure else marked)), links)
    # an article only inside of what is left out is none
    return text if found or not marked else _article(page, fixed, set(), links)[0]


def _article(page: list[Token], fixed: set[int], articles: set[int], links: set[str]) -> tuple[str, bool]:
    """The text of the tags ``articles`` (by identity), of all slots if there are none; whether one came up."""
    named = bool(articles)
    blocks, block, open_, count = [], [], [], Counter()
    inside = skipped = linked = 0
    found = False
    own = False  # whether the block holds any text beside the template's
    prose = False  # whether it holds any text beside links of a list

    def end() -> None:
        nonlocal block, own, prose
        text = " ".join("".join(block).split())
        if text and own and prose:
            blocks.append(text)
        block, own, prose = [], False, False

    for at, token in enumerate(page):
        name = token.name
        if name is None:
            if not token.text or skipped or (named and not inside):
                continue
            # what separates links has neither letters nor digits
            prose = prose or named or not linked and (not links or any(c.isalnum() for c in token.text))
            own = own or named or at not in fixed and not token.text.isspace()
            block.append(token.text)
            continue
        if name not in INLINE:
            end()
        elif name == "br":
            block.append(" ")
        if token.text is not None or name in VOID:
            continue
        if token.closes:
            if count[name]:
                while True:
                    was, other, article, link = open_.pop()
                    count[was] -= 1
                    skipped, inside, linked = skipped - other, inside - article, linked - link
                    if was == name:
                        break
            continue
        if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and open_ and count[name]:
            # such an element ends where the next one of its kind begins, through inline tags
            k = len(open_) - 1
            while k >= 0 and open_[k][0] in INLINE:
                k -= 1
            if open_[k][0] == name:
                while len(open_) > k:
                    was, other, article, link = open_.pop()
                    count[was] -= 1
                    skipped, inside, linked = skipped - other, inside - article, linked - link
        # the head of an article belongs to it
        other = token.other and not (name == "header" and inside)
        article = id(token) in articles and not other
        found = found or article and not skipped
        link = token.key in links or token.bare in links
        open_.append((name, int(other), int(article), int(link)))
        count[name] += 1
        skipped, inside, linked = skipped + other, inside + article, linked + link
    end()
    return "\n".join(blocks), found


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            rows = [(host_of(u.as_py()), p.as_py(), key, n, first)
                    for u, p, h in zip(part.column(0), part.column(1), part.column(2))
                    for key, (n, first) in vectors(h.as_py()).items()]
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["host", "page", "token", "n", "first"])


def templates(pages: DataFrame) -> DataFrame:
    """(host, root, lists) for ``pages`` (page_id, url, html), and a row for the host '*' of all.

    ``root``: tokens that nearly all pages of the host have exactly once, in order;
    ``lists``: tokens of the classes that repeat together.
    """
    key = F.xxhash64("page_id", "url", "html")
    seen = materialise(
        pages.select("url", key.alias("page"), "html").mapInArrow(
            _vectors, "host string, page long, token string, n int, first int"), "vectors")
    # the digest of a vector: sums of the halves of a hash of (page, count)
    mix = F.xxhash64("page", "n")
    parts = seen.groupBy("host", "token").agg(
        F.count(F.lit(1)).alias("pages"), F.sum("n").alias("times"),
        F.sum((F.col("n") == 1).cast("long")).alias("ones"),
        F.sum(F.shiftrightunsigned(mix, 33)).alias("high"), F.sum(mix.bitwiseAND(F.lit(0x7FFFFFFF))).alias("low"),
        F.sum("first").alias("firsts"))
    sums = [F.sum(c).alias(c) for c in ("pages", "times", "ones", "high", "low", "firsts")]
    parts = materialise(parts, "tokens")
    parts = parts.unionByName(parts.groupBy("token").agg(*sums).withColumn("host", F.lit(ALL)))
    hosts = pages.select(_host(F.col("url")).alias("host")).groupBy("host").agg(F.count(F.lit(1)).alias("all"))
    hosts = materialise(hosts, "hosts")
    hosts = hosts.unionByName(hosts.agg(F.sum("all").alias("all")).where("all > 0").withColumn("host", F.lit(ALL)))
    hosts = hosts.where((F.col("all") >= LEAST_PAGES) | (F.col("host") == ALL))
    common = parts.join(hosts, "host").withColumn("root", F.col("ones") >= ROOT_SHARE * F.col("all")).where(
        (F.col("pages") >= LIST_SHARE * F.col("all")) & (F.col("times") > F.col("pages")) & (F.col("pages") > 1)
        | (F.col("pages") == F.col("all")) | F.col("root"))
    place = F.struct((F.col("firsts") / F.col("pages")).alias("at"), "token")
    classes = common.groupBy("host", "root", "pages", "times", "high", "low").agg(
        F.count(F.lit(1)).alias("size"), F.collect_list(place).alias("tokens"))
    classes = classes.where("root or (size > 1 and times > pages)")
    tokens_of = lambda root: F.flatten(F.collect_list(F.when(F.col("root") == root, F.col("tokens"))))
    return materialise(classes.groupBy("host").agg(
        F.array_sort(tokens_of(True))["token"].alias("root"),
        F.array_sort(tokens_of(False))["token"].alias("lists")), "templates")


def _host(url):
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":.*$", ""))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            found = [article_text(h.as_py(), r.as_py() or [], l.as_py() or [])
                     for h, r, l in zip(part.column(2), part.column(3), part.column(4))]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(found, pa.string()),
                 pa.array([len(t) for t in found], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html).

    Null and empty pages have the text ''. Pages without url form the host ''. Repeated
    rows each give a row; further columns are ignored; an empty table gives an empty
    result. Blocks are joined by line breaks; white space inside them becomes one space.
    """
    pages = tidy(pages, page_id="long", url="string", html="string")
    found = templates(pages)
    shared = found.where(F.col("host") == ALL).first() or {"root": [], "lists": []}
    root, lists = (F.array(*[F.lit(t) for t in shared[k]]).cast("array<string>") for k in ("root", "lists"))
    joined = pages.withColumn("host", _host(F.col("url"))).join(found.where(F.col("host") != ALL), "host", "left")
    return joined.select(
        "page_id", "url", "html", F.coalesce("root", root).alias("root"), F.coalesce("lists", lists).alias("lists"),
    ).mapInArrow(
        _texts, "page_id long, url string, text string, n_chars long")


def op10_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extract(table(spark, folder, "pages"))
