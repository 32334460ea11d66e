"""Feeds: RSS 2.0, RSS 1.0/RDF and Atom documents to rows of one item shape.

A document is parsed where it lies, in a task; dates and filters are Spark's, so that they push down and run on the JVM.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heddle.functions import dates
from heddle.functions import text as T

RAW = "feed_url string, source string, form string, url string, title string, summary string, body string, authors string, published string, images array<string>, subjects array<string>, ref string"


def _local(tag: str) -> str:
    return tag.rpartition("}")[2] if isinstance(tag, str) else ""


def _all(x: ET.Element, name: str) -> list[ET.Element]:
    """Children by local name, of whatever namespace."""
    return [c for c in x if _local(c.tag) == name]


def _text(x: ET.Element, *names: str) -> str:
    """The text of the first child by the first of these names that has any."""
    for name in names:
        for c in _all(x, name):
            if t := "".join(c.itertext()).strip():
                return t
    return ""


def _images(x: ET.Element, html: str) -> list[str]:
    """At most two images of an entry: enclosures, media elements, then <img> of 100 by 100 or of no stated size."""
    found = [c.get("url", "") for c in _all(x, "enclosure") if c.get("type", "").startswith("image/")]
    found += [c.get("url", "") for name in ("content", "thumbnail") for c in _all(x, name) if c.get("url") and (name == "thumbnail" or c.get("medium") == "image" or c.get("type", "").startswith("image/"))]
    for tag in re.findall(r"<img\b[^>]*>", html or "", re.I):
        attr = {k.lower(): v for k, _, v in re.findall(r"([\w-]+)\s*=\s*([\"'])(.*?)\2", tag, re.S)}
        sides = [int(n[0]) for k in ("width", "height") if (n := re.findall(r"^\d+", attr.get(k, "")))]
        if attr.get("src", "").startswith(("http://", "https://")) and all(s >= 100 for s in sides):
            found.append(attr["src"])
    return list(dict.fromkeys(u for u in found if u))[:2]


def _entry(x: ET.Element, form: str) -> dict | None:
    if form == "atom":
        links = [c for c in _all(x, "link")]
        html = [c for c in links if c.get("type") == "text/html" and c.get("href")]
        href = next((c.get("href") for c in [*html, *[c for c in links if c.get("rel", "alternate") == "alternate"], *links] if c.get("href")), "") or _text(x, "link")
        authors = ", ".join(n for a in _all(x, "author") if (n := _text(a, "name") or "".join(a.itertext()).strip()))
        ref = _text(x, "id")
        row = {"url": href or ref, "summary": _text(x, "summary", "content"), "body": _text(x, "content", "summary"), "authors": authors, "published": _text(x, "published", "updated"), "subjects": [c.get("term") for c in _all(x, "category") if c.get("term")], "ref": ref}
    else:
        row = {"url": _text(x, "link"), "summary": _text(x, "description"), "body": _text(x, "description", "encoded"), "authors": _text(x, "author", "creator"), "published": _text(x, "pubDate", "date"), "subjects": [t for c in _all(x, "category") if (t := "".join(c.itertext()).strip())], "ref": _text(x, "guid")}
        row["authors"] = row["authors"] or _text(x, "creator")
    row |= {"title": " ".join(_text(x, "title").split()), "images": _images(x, row["body"])}
    return row if row["title"] and row["url"] else None


def entries(xml: bytes | str) -> Iterator[tuple[str, dict]]:
    """(form, entry) of a feed document. No document, one that defines entities of its own, or a broken one has none; a broken entry is left out."""
    data = xml.encode() if isinstance(xml, str) else xml or b""
    if not data.strip() or re.search(rb"<!DOCTYPE[^>\[]*\[[^\]]*<!ENTITY", data):
        return
    try:
        root = ET.fromstring(data.strip())
    except ET.ParseError:
        return
    kind = _local(root.tag)
    form = {"rss": "rss", "RDF": "rdf", "feed": "atom"}.get(kind)
    if not form:
        return
    where = root if form != "rss" else next(iter(_all(root, "channel")), root)
    for x in _all(where, "entry" if form == "atom" else "item"):
        try:
            if row := _entry(x, form):
                yield form, row
        except (ValueError, AttributeError):
            continue


def parsed(documents: DataFrame) -> DataFrame:
    """The entries of feed documents (``feed_url, source, document``), one row each, in columns RAW: everything as in the feed. Null documents have none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [{"feed_url": r.feed_url, "source": r.source, "form": form, **row} for r in b.itertuples(index=False) for form, row in entries(r.document)]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in RAW.split(", ")])

    return documents.select("feed_url", "source", "document").mapInPandas(run, RAW)


def published_date(form: Column, published: Column) -> Column:
    """RSS 2.0 by its own form of date, the others by the first ten characters."""
    return F.when(form == "rss", F.coalesce(dates.rss_date(published), F.try_to_date(F.substring(published, 1, 10), "yyyy-MM-dd"))).otherwise(F.try_to_date(F.substring(published, 1, 10), "yyyy-MM-dd"))


def feed_items(documents: DataFrame, cutoff: Column | None = None) -> DataFrame:
    """Items from feed documents: text without markup, dates, source names by host. Those of the cutoff's day and undated ones stay; newest first per source isn't implied."""
    p = parsed(documents)
    rows = p.select("source", "url", "title", T.strip_html(F.col("summary")).alias("abstract"), T.strip_html(F.col("body")).alias("content"), "authors", published_date(F.col("form"), F.col("published")).alias("published_date"), T.host_label(F.col("feed_url"), "substack.com").alias("source_name"), "images", "subjects", "ref")
    return rows if cutoff is None else rows.where(F.col("published_date").isNull() | (F.col("published_date") >= F.to_date(cutoff)))


def newest_first(documents: DataFrame, cutoff: Column | None = None) -> DataFrame:
    """The items of many feeds as one list: the newest first, undated ones last, equal dates by address. Sorted by range over all tasks."""
    return feed_items(documents, cutoff).orderBy(F.col("published_date").desc_nulls_last(), "url")


def preprint_feed_items(documents: DataFrame, cutoff: Column | None = None) -> DataFrame:
    """Items from a preprint server's Atom: one per address over all categories, the id after /abs/ as source_id. The cutoff's day is dropped, undated ones stay."""
    p = parsed(documents).withColumn("published_date", published_date(F.col("form"), F.col("published")))
    if cutoff is not None:
        p = p.where(F.col("published_date").isNull() | (F.col("published_date").cast("timestamp") >= cutoff))
    first = p.groupBy("url").agg(F.min_by(F.struct("source", "title", "summary", "authors", "published_date", "subjects", "ref"), F.struct("feed_url", "ref")).alias("v")).select("url", "v.*")
    return first.select("source", "url", "title", T.collapse(F.col("summary")).alias("abstract"), "authors", "published_date", F.regexp_extract("ref", r"/abs/(.+)$", 1).alias("source_id"), "subjects")


def paper_feed_items(documents: DataFrame, today: Column, per_source: int | None = None) -> DataFrame:
    """Items from a working-paper RSS whose titles are "Title -- by A, B" and which has no dates: dated ``today``, all, or the first ``per_source`` of a source by address."""
    from pyspark.sql import Window

    p = parsed(documents)
    by = F.split("title", r"\s+--\s+by\s+", 2)
    url = F.regexp_replace("url", r"#.*$", "")
    rows = p.select("source", url.alias("url"), F.get(by, F.lit(0)).alias("title"), F.coalesce(F.get(by, F.lit(1)), F.col("authors")).alias("authors"), T.strip_html(F.col("summary")).alias("abstract"), F.regexp_extract(url, r"/papers/(w\d+)", 1).alias("source_id"), today.alias("published_date"))
    if per_source is None:
        return rows
    return rows.withColumn("r", F.row_number().over(Window.partitionBy("source").orderBy("url"))).where(F.col("r") <= per_source).drop("r")
