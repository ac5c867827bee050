"""Web pages: titles and summaries, and the text of articles."""

from __future__ import annotations

import html
import re
from html.parser import HTMLParser
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.functions.text import WHITE_SPACE, clean
from broadsheet.functions.urls import normal_url
from broadsheet.sources.shared import small_batches

#: Fixed values of the article parser.
NOISE = ("script", "style", "noscript", "svg", "iframe", "form", "header", "footer", "nav", "aside")
LEAST_PARAGRAPH, LEAST_ARTICLE = 30, 200
BOILERPLATE = ("abone ol", "son dakika", "reklam")
#: Pages whose articles are sent at once.
PAGES_AT_ONCE = 200
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")


def _meta(attr: str, value: str) -> Column:
    forward = F.regexp_extract("html", f"(?is)<meta\\s[^>]*{attr}\\s*=\\s*[\"']{value}[\"'][^>]*content\\s*=\\s*[\"']([^\"']*)[\"']", 1)
    backward = F.regexp_extract("html", f"(?is)<meta\\s[^>]*content\\s*=\\s*[\"']([^\"']*)[\"'][^>]*{attr}\\s*=\\s*[\"']{value}[\"']", 1)
    return F.coalesce(F.nullif(forward, F.lit("")), F.nullif(backward, F.lit("")))


def unescape_basic(c: Column) -> Column:
    """The entities that pages use in titles; & last, so that nothing is unescaped twice."""
    for name, value in (("&quot;", '"'), ("&#x27;", "'"), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        c = F.replace(c, F.lit(name), F.lit(value))
    return c


def page_meta(pages: DataFrame) -> DataFrame:
    """pages with title and summary: the card's, else the page's own; a title ends at its first bar. Built-in functions."""
    title = F.coalesce(_meta("property", "og:title"), F.regexp_extract("html", "(?is)<title[^>]*>(.*?)</title>", 1))
    summary = F.coalesce(_meta("property", "og:description"), _meta("name", "description"), F.lit(""))
    title = F.trim(F.regexp_replace(F.element_at(F.split(title, "\\|"), 1), WHITE_SPACE, " "))
    return pages.withColumns({"title": unescape_basic(title), "summary": unescape_basic(clean(summary))})


class ArticleParser(HTMLParser):
    """Paragraphs of every article, main and body element, and the metadata, in one pass.

    Open elements are kept in order: an end tag closes the last one of its name and all that were opened in it, so a noise
    element that is never closed ends with the element around it.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.elements: list[str] = []
        self.count: dict[str, int] = {}
        self.muted: int | None = None  # the place of the outermost open noise element
        self.meta: dict[tuple[str, str], str] = {}
        self.title: str | None = None
        self.heading: str | None = None
        self.within: str | None = None
        self.open: list[tuple[str, list[str]]] = []
        self.done: list[tuple[str, list[str]]] = []
        self.rest: list[str] = []
        self.parts: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        if tag not in VOID:
            if tag in NOISE and self.muted is None:
                self.muted = len(self.elements)
            self.elements.append(tag)
            self.count[tag] = self.count.get(tag, 0) + 1
        if self.muted is not None:
            return
        a = {k: v or "" for k, v in attrs}
        if tag == "meta" and a.get("content"):
            for k in ("property", "name", "itemprop"):
                if k in a:
                    self.meta.setdefault((k, a[k]), a["content"])
        elif tag in ("article", "main", "body"):
            self.open.append((tag, []))
        elif tag in ("p", "h2"):
            self._end()
            self.parts = []
        elif tag in ("title", "h1"):
            self.within, self.parts = tag, []

    def handle_endtag(self, tag):
        if self.count.get(tag):
            closed = None
            while closed != tag:
                closed = self.elements.pop()
                self.count[closed] -= 1
            if self.muted is not None and len(self.elements) <= self.muted:
                self.muted = None
        if self.muted is not None:
            return
        if tag in ("p", "h2"):
            self._end()
        elif tag == self.within:
            text = re.sub(WHITE_SPACE, " ", " ".join(self.parts or [])).strip()
            if tag == "title":
                self.title = self.title or text
            else:
                self.heading = self.heading or text
            self.within = self.parts = None
        elif tag in ("article", "main", "body"):
            self._end()
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] == tag:
                    self.done.append(self.open.pop(i))
                    break

    def handle_data(self, data):
        if self.parts is not None and self.muted is None:
            self.parts.append(data)

    def _end(self):
        if self.parts is None or self.within:
            return
        text, self.parts = re.sub(WHITE_SPACE, " ", " ".join(self.parts)).strip(), None
        if len(text) >= LEAST_PARAGRAPH and not text.lower().startswith(BOILERPLATE):
            self.rest.append(text)
            for _, found in self.open:
                found.append(text)

    def result(self) -> tuple[str | None, str | None, str | None, str, str, str]:
        """(title, summary, date, text, cleaned text, status)."""
        self._end()
        self.done += self.open
        get = lambda *keys: next((re.sub(WHITE_SPACE, " ", self.meta[k]).strip() for k in keys if k in self.meta), None)
        inner = [p for t, p in self.done if t != "body"] or [p for t, p in self.done if t == "body"] or [self.rest]
        best = max(inner, key=lambda p: len(" ".join(p)))
        cleaned = " ".join(best)
        return (
            get(("property", "og:title"), ("name", "twitter:title")) or self.title or self.heading,
            get(("property", "og:description"), ("name", "description"), ("name", "twitter:description")),
            get(("property", "article:published_time"), ("name", "pubdate"), ("name", "date"), ("itemprop", "datePublished")),
            "\n\n".join(best),
            cleaned,
            "parsed" if len(cleaned) >= LEAST_ARTICLE else "empty",
        )


def parse_article(markup: str | None) -> tuple:
    parser = ArticleParser()
    parser.feed(markup or "")
    parser.close()
    return parser.result()


ARTICLE = "title string, summary string, published_date string, article_text string, cleaned_article_text string, parse_status string"


def _few_pages(batch: pa.RecordBatch):
    """The batch by PAGES_AT_ONCE rows, so that articles of a few pages are held and not of all."""
    return (batch.slice(i, PAGES_AT_ONCE) for i in range(0, batch.num_rows, PAGES_AT_ONCE))


def parsed_articles(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row a page: id, and title, summary, date, text and status of its article. Nothing is shuffled."""
    names = [x.split()[0] for x in ARTICLE.split(", ")]

    def run(batches):
        for b in chain.from_iterable(map(_few_pages, batches)):
            rows = [parse_article(x.as_py()) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array([r[i] for r in rows], pa.string()) for i in range(len(names))]], names=[id_col, *names])

    small_batches(pages.sparkSession)
    kind = pages.schema[id_col].dataType.simpleString()
    return pages.select(id_col, html_col).mapInArrow(run, f"`{id_col}` {kind}, {ARTICLE}")


def _found(links: DataFrame, pages: DataFrame) -> DataFrame:
    """links (id, link) with the markup of the page that has the same normal URL, null where there is none; of several pages
    the one of the largest id."""
    held = pages.groupBy(normal_url(F.col("url")).alias("_url")).agg(F.max_by("html", "page_id").alias("html"), F.lit(True).alias("_there"))
    return links.withColumn("_url", normal_url(F.col("link"))).join(held, "_url", "left").select("id", "html", "_there")


def fetched_articles(links: DataFrame, pages: DataFrame) -> DataFrame:
    """One row a link: id, the page's length and its article; links without a page have the status fetch_error.

    links: id, link. pages: page_id, url, html, which a crawler has landed.
    """
    got = _found(links, pages)
    there = got.filter("_there").select("id", F.coalesce("html", F.lit("")).alias("html"))
    parsed = parsed_articles(there, "id").join(there.select("id", F.length("html").cast("bigint").alias("page_chars")), "id")
    names = [x.split()[0] for x in ARTICLE.split(", ")]
    lost = got.filter("_there is null").select("id", *[F.lit("fetch_error" if n == "parse_status" else None).cast("string").alias(n) for n in names], F.lit(None).cast("bigint").alias("page_chars"))
    return parsed.unionByName(lost)


def scraped(links: DataFrame, pages: DataFrame) -> DataFrame:
    """id, title and summary of the listed links that have a page with a title; the rest is dropped."""
    got = _found(links, pages).filter("_there")
    return page_meta(got.select(F.col("id").alias("page_id"), F.lit("").alias("url"), F.coalesce("html", F.lit("")).alias("html"))).filter("coalesce(title, '') <> ''").withColumnRenamed("page_id", "id")


def unescaped(text: str) -> str:
    return html.unescape(text)
