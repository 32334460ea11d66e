"""Listing pages scraped by each source's own selectors."""

from __future__ import annotations

import json
from collections.abc import Iterator
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heddle.functions import dates
from heddle.functions import text as T
from heddle.sources.markup import article_text, parse

NEEDED = ("listing_url", "article_selector", "title_selector", "url_selector")
RAW = "source string, pos int, url string, title string, dates array<string>, authors string, abstract string"


def config(text: str | dict | None) -> dict | None:
    """A source's configuration, as an object or JSON text; None if it is no object or lacks a needed selector."""
    try:
        got = json.loads(text) if isinstance(text, str) else text
    except ValueError:
        return None
    if not isinstance(got, dict) or any(not got.get(k) for k in NEEDED):
        return None
    return {**got, "base_url": got.get("base_url") or got["listing_url"]}


def articles(html: str, c: dict) -> Iterator[dict]:
    """The articles of a listing, with title and address; the address is the container's own where it is the link."""
    for x in parse(html).select(c["article_selector"]):
        title = x.first(c["title_selector"])
        link = x.first(c["url_selector"])
        href = (link.attrs.get("href") if link is not None else None) or x.attrs.get("href")
        name = (title.text() if title is not None else "").strip()
        if not name or not href:
            continue
        pick = lambda k: (y.text() if c.get(k) and (y := x.first(c[k])) is not None else "")
        days = [y.attrs.get("datetime") or y.text() for y in x.select(c["date_selector"])] if c.get("date_selector") else []
        yield {"url": urljoin(c["base_url"], href), "title": name, "dates": days, "authors": pick("author_selector"), "abstract": pick("abstract_selector")}


def listing_items(pages: DataFrame, year: int, cutoff: Column | None = None, date_pattern: str | None = None) -> DataFrame:
    """Items of listing pages (``source, crawl_config, html``): the first per address, then those of the cutoff's day or later or without a date.

    A source without a valid configuration has none. The date is the first of an article's matches that can be read.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [{"source": r.source, "pos": i, **a} for r in b.itertuples(index=False) if (c := config(r.crawl_config)) and r.html for i, a in enumerate(articles(r.html, c))]
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in RAW.split(", ")])

    found = pages.select("source", "crawl_config", "html").mapInPandas(run, RAW)
    first = found.groupBy("source", "url").agg(F.min_by(F.struct("title", "dates", "authors", "abstract"), "pos").alias("v")).select("source", "url", "v.*")
    day = F.element_at(F.filter(F.transform("dates", lambda t: dates.flexible_date(t, year, date_pattern)), lambda x: x.isNotNull()), 1)
    day = F.when(F.exists("dates", lambda t: dates.flexible_date(t, year, date_pattern).isNotNull()), day)
    out = first.withColumn("published_date", day).drop("dates")
    return out if cutoff is None else out.where(F.col("published_date").isNull() | (F.col("published_date") >= F.to_date(cutoff)))


def page_texts(pages: DataFrame, most: int | None = None) -> DataFrame:
    """``url, text``: the whole article text of each page (``url, html``), "" where there is none. most: characters to keep, for a caller whose prompt holds no more."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"url": b["url"], "text": [article_text(h or "", u or "", most) for h, u in zip(b["html"], b["url"])]})

    return pages.select("url", "html").mapInPandas(run, "url string, text string")


def page_date(html: Column) -> Column:
    """The date on a paper's own page: of its first <time>, by attribute or text, else what follows "Issue Date", a month and a year being the month's first."""
    attribute = F.regexp_extract(html, r"(?i)<time\b[^>]*\bdatetime\s*=\s*[\"']([^\"']+)", 1)
    inner = T.strip_html(F.regexp_extract(html, r"(?is)<time\b[^>]*>(.*?)</time>", 1))
    issue = F.regexp_extract(T.strip_html(html), r"(?i)\bIssue Date:?\s+([A-Za-z]+ (?:\d{1,2}, )?\d{4})", 1)
    return F.coalesce(dates.flexible_date(attribute, 1), dates.month_year(inner), dates.month_year(issue))
