"""Main text of web pages by template deduction from equivalence classes.

A page is a sequence of tokens: tags and text blocks with their path in the page.  Over the
pages of a host every token has an occurrence vector (its count on each page).  Tokens with
equal vectors form a class; large classes that occur on most pages of their layout and keep
their order are the host's template.  A token's layout is the set of pages that have the
element it lies in.

Tags and the words of classes choose first: blocks of the article, or outside of menus and
the like if a page has none.  The template then takes its constant text out of them; it is a
flat list of classes, and slots are not derived from places in it.

Vectors are compared by digests that Spark sums up per host and token, so a host of any size
is never gathered.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from loanweave.llm.common import annotate, as_texts, stored, table, unused

#: A class is part of the template if it has so many tokens and is on so many pages, at least
#: this share of the host's pages that have the elements of its tokens.
CLASS_TOKENS, CLASS_PAGES, CLASS_SHARE = 2, 5, 0.6
#: Constant text counts as template only if its neighbours differ from page to page: this
#: share of a 64-bit sketch of them must be filled (what copies of an article share isn't).
NEIGHBOURS = 0.5
#: Templates of all hosts together are sent to every task up to this size; larger ones are
#: joined by host and salt, so that no host's pages meet in one task.
TEMPLATE_BYTES, SALTS = 32 << 20, 64

# Fixed values of HTML: elements without content, with raw text, with inline content, and
# elements that an opening tag of the same kind closes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|textarea|iframe|svg|math|object|select|title"
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rp rt s samp small"
    " span strike strong sub sup time tt u var wbr".split()
)
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
# Elements, and words of classes, ids and roles, that hold no main text.
ASIDE_TAGS = frozenset("nav header footer aside form button dialog menu head fieldset".split())
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr"
    " sidebar comment comments reply replies respond disqus share sharing social related recommended newsletter subscribe"
    " signup popup modal breadcrumb breadcrumbs pagination pager widget complementary contentinfo".split()
)
WEAK_ASIDE_WORDS = frozenset(
    "nav navbar navigation menu header masthead footer notice notices notification alert toolbar login search legal copyright skip".split()
)
CONTENT_WORDS = frozenset("article entry post content main body story text title".split())
#: Elements that names never make aside.
KEPT_TAGS = frozenset("html body main article".split())

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b[^>]*+>.*?(?:</(?P=raw)\s*+>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attributes>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(?:/?[a-zA-Z]|[!?/])[^>]*+(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
_HOST = re.compile(r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)")


def host(url: str | None) -> str:
    """Host of a URL in lower case; empty if there is none."""
    m = _HOST.match(url or "")
    return m[1].lower() if m else ""


def _step(tag: str, attributes: str) -> tuple[str, bool, bool, bool]:
    """Name of an element in a path, whether it is aside, aside by its names only, the article.

    Only whole tokens of a class, id or role speak (their numbers apart): "no-sidebar" does
    not.  Other elements are left to the template.
    """
    names: set[str] = set()
    whole: set[str] = set()
    label, aside, article, content = tag, tag in ASIDE_TAGS, tag in ("article", "main"), False
    if attributes and not attributes.isspace():
        for m in _ATTRIBUTE.finditer(attributes):
            kind, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
            if kind == "hidden" or kind == "aria-hidden" and value == "true":
                aside = True
            elif kind in ("class", "id", "role"):
                value = re.sub(r"\d+", "", value)
                names.update(w for w in re.split(r"[^a-z0-9]+", value) if w)
                tokens = {w.strip("-_") for w in value.split()}
                whole |= tokens
                content |= kind == "id" and not tokens.isdisjoint(CONTENT_WORDS)
                if kind == "role" and value == "main":
                    article = True
        if names:
            label = f"{tag}.{'.'.join(sorted(names))}"
    named = bool(whole & ASIDE_WORDS) and not content or bool(whole & WEAK_ASIDE_WORDS) and not names & CONTENT_WORDS
    return label, aside, named and not article and tag not in KEPT_TAGS, article


class Page:
    """Blocks and tag tokens of one page, in page order.

    ``blocks``: (path, text, aside, in article); ``tags``: paths of opened elements.

    An element that is aside by its names isn't if it holds the main element, or an article
    on a page that has no article elsewhere.
    """

    def __init__(self, source: str):
        self.blocks: list[tuple[str, str, bool, bool]] = []
        self.tags: list[str] = []
        self.has_article = False
        # tag, path, aside, numbers of the elements around that are aside by their names, in article
        self._stack: list[tuple[str, str, bool, tuple[int, ...], bool]] = [("", "", False, (), False)]
        self._text: list[str] = []
        self._found: list[tuple[str, str, bool, tuple[int, ...], bool]] = []
        self._articles: list[tuple[bool, tuple[int, ...]]] = []
        self._walk(source)
        self._settle()

    def _settle(self) -> None:
        """Say of every block whether it is aside, when all articles are known."""
        cleared = {n for main, named in self._articles if main for n in named}
        if not any(cleared.issuperset(named) for _, named in self._articles):
            cleared.update(n for _, named in self._articles for n in named)
        self.has_article = any(cleared.issuperset(named) for _, named in self._articles)
        self.blocks = [
            (path, text, aside or not cleared.issuperset(named), article)
            for path, text, aside, named, article in self._found
        ]

    def _flush(self) -> None:
        if self._text:
            text = " ".join(entities.unescape("".join(self._text)).split())
            self._text.clear()
            if text:
                self._found.append((self._stack[-1][1], text, *self._stack[-1][2:]))

    def _open(self, tag: str, attributes: str) -> None:
        stack = self._stack
        if tag == "br":
            self._text.append(" ")
            return
        inline = tag in INLINE
        if inline and "=" not in attributes and "hidden" not in attributes:
            return
        label, aside, named, article = _step(tag, attributes)
        if inline and not aside and not named:
            return
        self._flush()
        if not inline and stack[-1][0] == "p" and tag not in VOID:
            stack.pop()
        ends = CLOSES.get(tag, ())
        while stack[-1][0] in ends:
            stack.pop()
        _, path, outer_aside, around, outer_article = stack[-1]
        path = f"{path}/{label}"
        self.tags.append(path)
        if tag in VOID or attributes.endswith("/") and inline:
            return
        aside = outer_aside or aside
        article = article and not aside
        if article:
            self._articles.append((tag != "article", around))
        if named:
            around = (*around, len(self.tags))
        stack.append((tag, path, aside, around, outer_article or article))

    def _close(self, tag: str) -> None:
        stack = self._stack
        depth = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == tag), 0)
        if depth:
            self._flush()
            del stack[depth:]
        elif tag not in INLINE:
            self._flush()

    def _walk(self, source: str) -> None:
        at = 0
        for m in _TOKEN.finditer(source):
            if m.start() > at:
                self._text.append(source[at : m.start()])
            at = m.end()
            tag = m["tag"]
            if tag:
                tag = tag.lower()
                self._close(tag) if m["close"] else self._open(tag, m["attributes"] or "")
        if at < len(source):
            self._text.append(source[at:])
        self._flush()


def _number(text: str) -> int:
    value = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))
    return value - (1 << 64) if value >= 1 << 63 else value


def tokens(page: Page) -> list[dict]:
    """Each distinct token of a page with its count, first place and neighbours' hashes."""
    texts = [_number(f"{path}\n{text}") for path, text, _, _ in page.blocks]
    around = [_number(path) if path else None for path, _, _, _ in page.blocks]
    counts = Counter(texts)
    out = []
    for k, number in enumerate(texts):
        if count := counts.pop(number, 0):
            before = texts[k - 1] if k else 0
            after = texts[k + 1] if k + 1 < len(texts) else 0
            out.append({"token": number, "n": count, "place": k, "text": True, "before": before & 63, "after": after & 63, "around": around[k]})
    for path, count in Counter(page.tags).items():
        out.append({"token": _number(path), "n": count, "place": 0, "text": False, "before": 0, "after": 0, "around": None})
    return out


_TOKENS = "array<struct<token:bigint,n:int,place:int,text:boolean,before:int,after:int,around:bigint>>"


def constant_blocks(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """``host`` and ``constants``: tokens of text that belongs to the host's template."""

    def start():
        def work(urls, sources):
            return [[host(u) for u in urls.to_pylist()], [tokens(Page(s)) for s in as_texts(sources)]]

        return work

    parsed = annotate(pages.select(id_col, url_col, html_col), [url_col, html_col], f"host string, tokens {_TOKENS}", start)
    each = parsed.select("host", F.col(id_col).alias("page"), F.explode("tokens").alias("t"))
    # the digest of an occurrence vector: sums of both halves of hashes of (page, count), so
    # that a page stored twice counts twice in every vector
    digest = F.xxhash64("page", "t.n")
    vectors = each.groupBy("host", "t.token").agg(
        F.count("*").alias("pages"),
        F.sum("t.n").alias("total"),
        F.sum(digest.bitwiseAND(0xFFFFFFFF)).alias("low"),
        F.sum(F.shiftright(digest, 32)).alias("high"),
        F.sum("t.place").alias("places"),
        F.max("t.text").alias("text"),
        F.max("t.around").alias("around"),
        F.bit_or(F.expr("shiftleft(1L, t.before)")).alias("before"),
        F.bit_or(F.expr("shiftleft(1L, t.after)")).alias("after"),
        F.bit_or(F.expr("shiftleft(1L, cast(xxhash64(page) & 63 as int))")).alias("met"),
    )
    hosts = hosted(pages.select(url_col), url_col, "host").groupBy("host").agg(F.count("*").alias("host_pages"))
    # read twice, so written once: the pages are parsed for it only here
    repeated = stored(vectors.where(F.col("pages") >= CLASS_PAGES))
    # a text's layout: the pages of the host that have its element, or all if it lies in none
    layouts = repeated.where(~F.col("text")).select("host", F.col("token").alias("around"), F.col("pages").alias("layout_pages"))
    frequent = (
        repeated.join(hosts, "host")
        .join(layouts, ["host", "around"], "left")
        .where(~F.col("text") | (F.col("pages") >= CLASS_SHARE * F.coalesce("layout_pages", "host_pages")))
    )
    # different pages, in a sketch like that of the neighbours
    possible = F.least(F.lit(48), F.bit_count("met"))
    varied = F.greatest(F.bit_count("before"), F.bit_count("after")) >= NEIGHBOURS * possible
    classes = frequent.groupBy("host", "low", "high", "pages", "total").agg(
        F.count("*").alias("size"),
        F.array_sort(
            F.collect_list(F.when(F.col("text") & varied, F.struct((F.col("places") / F.col("pages")).alias("place"), "token")))
        ).alias("constants"),
    )
    valid = classes.where((F.col("size") >= CLASS_TOKENS) & (F.size("constants") > 0))
    return valid.groupBy("host").agg(F.collect_list(F.transform("constants", lambda c: c["token"])).alias("constants"))


def main_blocks(page: Page, classes: list[list[int]]) -> list[str]:
    """Texts of the article's slots.

    A class of constants is taken out where its tokens keep the template's order; elsewhere
    the class isn't valid and its blocks are slots like others.
    """
    inside = [b for b in page.blocks if not b[2] and (b[3] or not page.has_article)]
    if not classes:
        return [b[1] for b in inside]
    numbered = [(_number(f"{b[0]}\n{b[1]}"), b[1]) for b in inside]
    dropped: set[int] = set()
    for constants in classes:
        order = {token: k for k, token in enumerate(constants)}
        met = [order[n] for n, _ in numbered if n in order]
        if met == sorted(met):
            dropped.update(constants)
    return [text for n, text in numbered if n not in dropped]


def hosted(pages: DataFrame, url_col: str, name: str) -> DataFrame:
    """Append the host of each page's URL."""
    return annotate(pages, [url_col], f"`{name}` string", lambda: lambda urls: [[host(u) for u in urls.to_pylist()]])


def with_templates(
    pages: DataFrame, templates: DataFrame, host_col: str, spread: tuple[str, ...], limit: int = TEMPLATE_BYTES
) -> DataFrame:
    """Pages with their host's row of ``templates``, which are broadcast within ``limit`` bytes.

    Beyond it, templates are repeated once per salt and pages take the salt of their
    ``spread`` columns, so that a hot host is shared by many tasks.
    """
    tokens = F.aggregate("constants", F.lit(0), lambda n, c: n + F.size(c))
    known = templates.agg((F.count("*") * 128 + F.sum(tokens) * 8).alias("bytes")).first()["bytes"] or 0
    named = templates.select(F.col("host").alias(host_col), F.col("constants").alias(unused(pages, "constants")))
    if known <= limit:
        return pages.join(F.broadcast(named), host_col, "left")
    salt = unused(pages, "salt")
    salted = pages.withColumn(salt, F.pmod(F.xxhash64(*spread), F.lit(SALTS)))
    every = named.withColumn(salt, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    return salted.join(every, [host_col, salt], "left").drop(salt)


def extract_main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", limit: int = TEMPLATE_BYTES
) -> DataFrame:
    """Append ``main_text``: blocks of the article in page order, joined by two line feeds.

    White space inside a block becomes one space and character references are decoded.  A
    null or empty page has an empty text.  Pages without URL share the empty host.  On pages
    without an article or main element, all blocks outside of menus, notices and the like
    count.  Repeated rows count as often as they are stored, an empty table gives an empty
    one, long pages are read whole, and other columns stay (``main_text`` is replaced).
    """
    name = unused(pages, "host")
    named = hosted(pages, url_col, name)
    templates = stored(constant_blocks(pages, id_col, url_col, html_col))
    joined = with_templates(named, templates, name, (id_col, url_col), limit)
    constants = unused(named, "constants")

    def start():
        def work(sources, constants):
            return [[
                "\n\n".join(main_blocks(Page(s), c or []))
                for s, c in zip(as_texts(sources), constants.to_pylist())
            ]]

        return work

    return annotate(joined, [html_col, constants], "main_text string", start).drop(name, constants)


def digests(spark: SparkSession, directory: str) -> DataFrame:
    """Main text of every page of a directory."""
    pages = table(spark, directory, "pages").select("page_id", "url", "html")
    return extract_main_text(pages).select(
        "page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars")
    )
