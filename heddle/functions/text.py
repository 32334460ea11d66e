"""Scalar text functions on columns. All give null for null unless said otherwise."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


@F.pandas_udf(StringType())
def _without_marks(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c)))


@F.pandas_udf(StringType())
def title_case(s: pd.Series) -> pd.Series:
    """Every run of letters with a capital first letter, so O'Neil-Smith, which initcap doesn't give."""
    return s.str.title()


def without_accents(c: Column) -> Column:
    """Compatibility decomposition without combining marks. ASCII texts stay on the JVM."""
    return F.when(c.rlike(r"^\p{ASCII}*$"), c).otherwise(_without_marks(F.when(~c.rlike(r"^\p{ASCII}*$"), c)))


def collapse(c: Column) -> Column:
    """Every run of white space (no-break ones too) as one space, ends trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def normal_title(title: Column) -> Column:
    """Lower case, without accents and punctuation, white space collapsed."""
    return collapse(F.regexp_replace(without_accents(F.lower(title)), r"(?U)[^\p{L}\p{N}_\s]", ""))


def first_author(authors: Column) -> Column:
    """The last word of what stands before the first comma, in lower case; "" if there is none."""
    return F.lower(F.element_at(F.split(collapse(F.element_at(F.split(F.coalesce(authors, F.lit("")), ","), 1)), " "), -1))


def content_hash(title: Column, authors: Column) -> Column:
    """16 hex digits that are equal for one work on several platforms: of its normalised title and first author's last name. A null title counts as ""."""
    return F.substring(F.sha2(F.concat_ws("|", F.coalesce(normal_title(title), F.lit("")), first_author(authors)), 256), 1, 16)


def strip_tags(c: Column, by: str = " ") -> Column:
    """Markup replaced by ``by``, nothing collapsed."""
    return F.regexp_replace(c, r"<[^>]+>", by)


def strip_html(c: Column) -> Column:
    """Markup as a space, white space collapsed."""
    return collapse(strip_tags(c))


def topic_key(c: Column) -> Column:
    """Lower case with _ for a space or hyphen."""
    return F.translate(F.lower(c), " -", "__")


def host(url: Column) -> Column:
    """The host of an address in lower case; null if it has none."""
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def host_label(url: Column, domain: str) -> Column:
    """What stands before ``.domain`` in an address's host; "" if it is another host."""
    return F.regexp_extract(url, r"^https?://([^./]+)\." + domain.replace(".", r"\."), 1)


def deep_link(base: str, slug: Column, item_id: Column) -> Column:
    """The address of an item within a feed's page."""
    return F.concat(F.lit(base.rstrip("/") + "/digests/"), slug, F.lit("#item-"), item_id.cast("string"))


def contains_keyword(lower_text: Column, keyword: str) -> Column:
    """Whether a keyword stands anywhere in a text already in lower case, within words too."""
    return lower_text.contains(keyword.lower())


def contains_name(lower_text: Column, name: str) -> Column:
    """Names of fewer than five characters on word boundaries, longer ones anywhere. The name is compared as given, so in lower case."""
    if len(name) < 5:
        return lower_text.rlike(r"(?U)\b\Q" + name.replace(r"\E", "") + r"\E\b")
    return lower_text.contains(name)


def truthy(c: Column) -> Column:
    """Whether a boolean or its text is true; null counts as false."""
    return F.coalesce(F.lower(c.cast("string")) == "true", F.lit(False))


def fenced_json(reply: Column) -> Column:
    """The text within a reply's first ```json fence, else its first ``` fence, else the whole. An unterminated fence runs to the end."""
    pick = lambda fence: F.regexp_extract(reply, r"(?s)" + fence + r"(.*?)(?:```|\z)", 1)
    return F.trim(F.when(reply.contains("```json"), pick("```json")).when(reply.contains("```"), pick("```")).otherwise(reply), F.lit(" \n\r\t"))


def needs_abstract(abstract: Column, least: int = 50) -> Column:
    """Whether an abstract is null or shorter than ``least`` characters."""
    return F.length(F.trim(F.coalesce(abstract, F.lit("")))) < least


def thin(content: Column, least: int = 500) -> Column:
    """Whether a content is null or shorter than ``least`` characters."""
    return F.length(F.coalesce(content, F.lit(""))) < least


def from_inverted_index(index: Column) -> Column:
    """A text from map<word, array<position>>: words in the order of their positions, equal positions by word."""
    placed = F.flatten(F.transform(F.map_entries(index), lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("p"), e["key"].alias("w")))))
    return F.array_join(F.transform(F.array_sort(placed), lambda x: x["w"]), " ")


# How sentences that are no content begin.
BOILERPLATE = r"(?i)^(subscribe|sign up|share this|click here|read more|follow us|newsletter|copyright|all rights|terms of|privacy policy|posted by|written by|photo by|image credit|advertisement|this (article|post|piece) (was|is)|related (articles|posts)|table of contents|skip to)"


def extractive_abstract(content: Column, most: int = 3) -> Column:
    """The first sentences of 30 to 200 characters that aren't boilerplate, as "- " bullets of about 90; null if the content has under 100 characters or fewer than two such sentences."""
    plain = collapse(strip_tags(content))
    kept = F.filter(F.transform(F.split(plain, r"(?<=[.!?])\s+(?=[A-Z])"), F.trim), lambda s: F.length(s).between(30, 200) & ~s.rlike(BOILERPLATE))

    def bullet(s: Column) -> Column:
        closed = F.when(s.rlike(r"[.!?]$"), s).otherwise(F.concat(F.regexp_replace(s, r"[,;:]+$", ""), F.lit(".")))
        head = F.substring(closed, 1, 90)
        cut = F.when(head.contains(" "), F.regexp_replace(head, r"(?s) [^ ]*$", "")).otherwise(head)
        return F.when(F.length(closed) > 95, F.concat(F.regexp_replace(cut, r"[.,;:]+$", ""), F.lit("..."))).otherwise(closed)

    bullets = F.slice(F.transform(kept, bullet), 1, most)
    return F.when((F.length(collapse(content)) >= 100) & (F.size(bullets) >= 2), F.array_join(F.transform(bullets, lambda b: F.concat(F.lit("- "), b)), "\n"))
