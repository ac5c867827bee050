"""Feeds and sitemaps that lie in files: one row an item. Fetching is left to connectors that land the files."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from datetime import UTC, datetime
from email.utils import parsedate_to_datetime
from itertools import chain, islice
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from broadsheet.functions.urls import normal_url
from broadsheet.sources.shared import small_batches

ITEM = "title string, summary string, source_name string, published_date string, link string, category string"
#: Characters that the parser is given, and items that are sent, at once.
CHARS_AT_ONCE, ITEMS_AT_ONCE = 1 << 16, 5_000
HEALTH = "source_name string, discovery_url string, parse_ok boolean, item_count int, unique_url_count int, latest_item_date string, error string"


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _child(node, *names: str) -> str | None:
    for name in names:
        for c in node:
            if _local(c.tag) == name:
                text = (c.text or "").strip()
                if text:
                    return text
    return None


def iso_date(text: str | None, default: str) -> str:
    """UTC in ISO form from the dates that feeds use; what can't be read is the default."""
    if not text:
        return default
    try:
        when = datetime.fromisoformat(text.strip())
    except ValueError:
        try:
            when = parsedate_to_datetime(text.strip())
        except (TypeError, ValueError, IndexError):
            return default
    return (when if when.tzinfo else when.replace(tzinfo=UTC)).astimezone(UTC).isoformat()


def _closed(xml: str, *names: str) -> Iterator:
    """Outermost elements of these names, each as soon as it is closed; what has been read is let go, so a file of any size
    holds one element at a time."""
    parser = ElementTree.XMLPullParser(("start", "end"))
    path, inside = [], 0
    for at in range(0, len(xml), CHARS_AT_ONCE):
        parser.feed(xml[at : at + CHARS_AT_ONCE])
        for event, node in parser.read_events():
            found = _local(node.tag) in names
            if event == "start":
                path.append(node)
                inside += found
                continue
            path.pop()
            inside -= found
            if not inside:
                if found:
                    yield node
                if path:
                    path[-1].remove(node)
    parser.close()


def feed_items(xml: str, source: str, now: str) -> Iterator[tuple]:
    """Items of an RSS or Atom feed."""
    for top in _closed(xml, "item", "entry"):
        for node in top.iter():
            if _local(node.tag) not in ("item", "entry"):
                continue
            link = _child(node, "link") or next((c.get("href") for c in node if _local(c.tag) == "link" and c.get("href")), None)
            tags = [c for c in node if _local(c.tag) == "category"]
            category = next((c.get("term") or (c.text or "").strip() or c.get("label") for c in tags[:1]), None)
            when = _child(node, "pubDate", "published", "updated", "created", "date")
            yield _child(node, "title"), _child(node, "description", "summary", "content") or "", source, iso_date(when, now), link, category or None


def sitemap_items(xml: str, source: str, now: str) -> Iterator[tuple]:
    """Items of a news sitemap; those without a title or a location are left out."""
    for top in _closed(xml, "url"):
        for node in top.iter():
            if _local(node.tag) != "url":
                continue
            loc = _child(node, "loc")
            news = next((c for c in node if _local(c.tag) == "news"), None)
            title = _child(news, "title") if news is not None else None
            if loc and title:
                when = (_child(news, "publication_date") if news is not None else None) or _child(node, "lastmod")
                yield title, "", source, iso_date(when, now), loc, _child(news, "keywords")


READERS = {"rss": feed_items, "sitemap": sitemap_items}


def _read(kind: str | None, xml: str | None, source: str | None, now: str) -> Iterator[tuple]:
    """Items of a file that can be read to its end; the file is read once for that and once for its items."""
    reader = READERS[kind]
    for _ in _closed(xml or ""):
        pass
    return reader(xml or "", source, now)


def _files(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Rows of a batch, one file's text at a time."""
    for i in range(batch.num_rows):
        yield tuple(c[i].as_py() for c in batch.columns)


def items(files: DataFrame, now: str) -> DataFrame:
    """files: source_name, source_type (rss or sitemap), discovery_url, xml. One row an item; broken files give none."""

    def run(batches):
        for name, kind, xml in chain.from_iterable(map(_files, batches)):
            try:
                found = _read(kind, xml, name, now)
            except (ElementTree.ParseError, KeyError):
                continue
            while rows := list(islice(found, ITEMS_AT_ONCE)):
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(6)], names=[x.split()[0] for x in ITEM.split(", ")])

    small_batches(files.sparkSession)
    return files.select("source_name", "source_type", "xml").mapInArrow(run, ITEM)


def health(files: DataFrame, now: str) -> DataFrame:
    """One row a file: whether it could be read, its items, distinct links and latest date."""

    def run(batches):
        for b in batches:
            rows = []
            for name, kind, url, xml in _files(b):
                n, links, latest, error = 0, set(), None, None
                try:
                    for f in _read(kind, xml, name, now):
                        n, latest = n + 1, f[3] if latest is None else max(latest, f[3])
                        if f[4]:
                            links.add(hashlib.blake2b(f[4].encode("utf-8", "surrogatepass"), digest_size=16).digest())
                except (ElementTree.ParseError, KeyError) as e:
                    error = f"{type(e).__name__}: {e}"
                rows.append((name, url, error is None, n, len(links), latest, error))
            kinds = [pa.string(), pa.string(), pa.bool_(), pa.int32(), pa.int32(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=[x.split()[0] for x in HEALTH.split(", ")])

    small_batches(files.sparkSession)
    return files.select("source_name", "source_type", "discovery_url", "xml").mapInArrow(run, HEALTH)


def distinct_items(items_: DataFrame, order: str = "published_date") -> DataFrame:
    """Items of each source without repeated links; items without a link always stay."""
    w = Window.partitionBy("source_name", "link").orderBy(order, "title")
    empty = F.coalesce(F.col("link"), F.lit("")) == ""
    keyed = items_.filter(~empty).withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")
    return keyed.unionByName(items_.filter(empty))


def metadata_records(spark: SparkSession, path: str) -> DataFrame:
    """Discovery records from lines of JSON, with normal URLs; records without one go."""
    rows = spark.read.schema("url string, discovery_role string, canonical_category string, position int").json(path)
    return rows.filter("coalesce(url, '') <> ''").withColumn("url", normal_url(F.col("url")))


def best_metadata(records: DataFrame) -> DataFrame:
    """Per url the record that says most: category feeds before general ones, then a category other than 'other', then position.

    records: url, discovery_role, canonical_category, position. The priority is total, so order of arrival doesn't matter.
    """
    w = Window.partitionBy("url").orderBy((F.col("discovery_role") == "category").desc(), (F.col("canonical_category") != "other").desc(), "position")
    return records.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")
