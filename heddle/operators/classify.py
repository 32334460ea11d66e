"""Classification as a dataflow: prefilter in Spark, a pluggable classifier in batches, verdicts in long form, auto-tags, audit."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heddle.operators.scoring import THRESHOLD, keyword_scores, potentially_relevant
from heddle.operators.taxonomy import Taxonomy

BATCH = 5
BELOW = "Below the keyword threshold"
VERDICT = "item_id bigint, subtopic string, relevant boolean, confidence string, reasoning string, topics array<string>"

#: takes the taxonomy's text and a batch of {title, content, item_type, authors, source, subtopics}, gives JSON text: {"0": {subtopic: {relevant, topics, confidence, reasoning}}, ...}
Classifier = Callable[[str, list[dict]], str]


def item_type(source_type) -> F.Column:
    """Research paper, blog post or article, by the type of an item's source."""
    return F.when(source_type.isin("working_paper", "nber", "academic_journal", "preprint"), "research paper").when(source_type.isin("blog", "substack", "newsletter"), "blog post").otherwise("article")


def split_by_prefilter(items: DataFrame, taxonomy: Taxonomy, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(items that may be relevant, verdicts of the others): an item below the threshold everywhere is not relevant under every subtopic."""
    marked = potentially_relevant(items, taxonomy, threshold)
    subtopics = F.explode(F.array(*[F.lit(s) for s in taxonomy.subtopics])).alias("subtopic")
    rejected = marked.where(~F.col("passes")).select(F.col("id").alias("item_id"), subtopics)
    return marked.where("passes").drop("passes"), rejected.select("item_id", "subtopic", *_default(BELOW))


def _default(reason: str) -> list:
    return [F.lit(False).alias("relevant"), F.lit("low").alias("confidence"), F.lit(reason).alias("reasoning"), F.array().cast("array<string>").alias("topics")]


def parse_reply(reply: str) -> dict:
    """The JSON object in a reply, fenced or not; {} if there is none."""
    fenced = re.search(r"```(?:json)?\s*(.*?)(?:```|\Z)", reply or "", re.S)
    try:
        got = json.loads(fenced.group(1) if fenced else reply or "")
    except ValueError:
        return {}
    return got if isinstance(got, dict) else {}


def classify(items: DataFrame, taxonomy: Taxonomy, classifier: Classifier, size: int = BATCH, subtopics: str | None = None, most: int | None = None, threshold: float | None = None) -> DataFrame:
    """Verdicts of a classifier on ``items``, one row per item and subtopic asked for (all, or those in the array column ``subtopics``).

    Items go in batches of at most ``size`` as they come in a partition; one prompt covers the subtopics any of them needs. An item's missing
    subtopics are "Not evaluated"; where a batch fails, its items are tried one by one, and one that fails alone gets
    "Classification failed". The classifier sees an item's whole content, or its first ``most`` characters, for a prompt that holds no more.
    With a ``threshold`` the prefilter is part of the same pass: an item below it never reaches the classifier and is not relevant under every subtopic. The result isn't deterministic if the classifier isn't: write it once before using it twice.
    """
    every = taxonomy.subtopics
    wanted = F.col(subtopics) if subtopics else F.array(*[F.lit(s) for s in every])
    content = F.coalesce(F.when(F.length("content") > 0, F.col("content")), F.col("abstract"), F.lit(""))
    marked = items.withColumn("passes", F.lit(True)) if threshold is None else potentially_relevant(items, taxonomy, threshold)
    shown = F.when(F.col("passes"), content if most is None else F.substring(content, 1, most))
    rows = marked.select(F.col("id").alias("item_id"), "title", shown.alias("content"), "authors", "source", wanted.alias("subtopics"), "passes")

    def ask(batch: list[dict]) -> list[dict]:
        names = sorted({s for x in batch for s in x["subtopics"]})
        got = parse_reply(classifier(taxonomy.prompt(names), batch))
        return [got[str(i)] if isinstance(got.get(str(i)), dict) else {} for i in range(len(batch))]

    def verdicts(x: dict, got: dict | None) -> Iterator[tuple]:
        for s in x["subtopics"]:
            v = got.get(s) if got else None
            if got is None or not isinstance(v, dict):
                yield x["item_id"], s, False, "low", "Classification failed" if got is None else "Not evaluated", []
            else:
                topics = [t for t in v.get("topics") or [] if isinstance(t, str)]
                yield x["item_id"], s, str(v.get("relevant", False)).lower() == "true", v.get("confidence") or "low", v.get("reasoning") or "", topics

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            every = [{**r, "subtopics": list(r["subtopics"]) if r["subtopics"] is not None else []} for r in b.to_dict("records")]
            held = [x for x in every if x.pop("passes")]
            out = [(x["item_id"], s, False, "low", BELOW, []) for x in every if x["content"] is None for s in x["subtopics"]]
            for i in range(0, len(held), size):
                batch = held[i : i + size]
                try:
                    replies: list[dict | None] = list(ask(batch))
                except Exception:
                    replies = []
                    for x in batch:
                        try:
                            replies += ask([x])
                        except Exception:
                            replies.append(None)
                out += [v for x, got in zip(batch, replies) for v in verdicts(x, got)]
            yield pd.DataFrame(out, columns=["item_id", "subtopic", "relevant", "confidence", "reasoning", "topics"])

    return rows.mapInPandas(run, VERDICT)


def batch_prompt(batch: list[dict], most: int | None = None) -> str:
    """What a model is asked about a batch, beside taxonomy.prompt as its fixed part: the items by number, what is asked of each, and the form of the reply.

    The same batch gives the same text. Null fields are left out. most: characters of content to show, for a model that takes no more.
    """
    parts = []
    for i, x in enumerate(batch):
        content = x.get("content") or ""
        fields = [("Title", x.get("title")), ("Authors", x.get("authors")), ("Source", x.get("source")), ("Subtopics", ", ".join(sorted(x["subtopics"]))), ("Content", content if most is None else content[:most])]
        parts.append("\n".join([f"### Item {i}", *[f"{name}: {value}" for name, value in fields if value]]))
    one = {"relevant": True, "topics": ["topic_key"], "confidence": "high | medium | low", "reasoning": "one sentence"}
    form = json.dumps({str(i): {s: one for s in sorted(x["subtopics"])} for i, x in enumerate(batch)}, indent=1)
    return "\n\n".join([*parts, "Reply with JSON of this form only:", form])


def keyword_classifier(taxonomy: Taxonomy, least: float = 0.1) -> Classifier:
    """A classifier without a model: relevant are the subtopics with a topic whose share of keywords is at least ``least``."""

    def run(_: str, batch: list[dict]) -> str:
        out = {}
        for i, x in enumerate(batch):
            text = f"{x['title'] or ''} {x['content'] or ''}".lower()
            own: dict = {}
            for s in x["subtopics"]:
                share = {t.topic: sum(k.lower() in text for k in t.keywords) / max(1, len(t.keywords)) for t in taxonomy.of(s)}
                hit = [t for t, v in share.items() if v >= least]
                own[s] = {"relevant": bool(hit), "topics": hit, "confidence": "high" if max(share.values(), default=0) >= 3 * least else "medium", "reasoning": ""}
            out[str(i)] = own
        return json.dumps(out)

    return run


def auto_tagged(verdicts: DataFrame, items: DataFrame, taxonomy: Taxonomy) -> DataFrame:
    """``verdicts`` with the topics that an item's source implies: added where the verdict is relevant and names no topic but secondary ones."""
    rules = [(s, sub, top) for s, tags in taxonomy.source_tags.items() for sub, top in tags]
    if not rules:
        return verdicts
    sources = items.select(F.col("id").alias("item_id"), "source")
    tag = F.lit(None).cast("string")
    for s, sub, top in reversed(rules):
        tag = F.when((F.col("source") == s) & (F.col("subtopic") == sub), top).otherwise(tag)
    substantive = F.exists("topics", lambda t: ~t.isin(*taxonomy.secondary) if taxonomy.secondary else F.lit(True))
    added = F.when(F.col("tag").isNotNull() & F.col("relevant") & ~substantive, F.array_union("topics", F.array("tag"))).otherwise(F.col("topics"))
    return verdicts.join(sources, "item_id", "left").withColumn("tag", tag).withColumn("topics", added).drop("source", "tag")


def populated(verdicts: DataFrame) -> DataFrame:
    """``subtopic, topic``: the topics that some relevant verdict names."""
    return verdicts.where("relevant").select("subtopic", F.explode("topics").alias("topic")).distinct()


def relevance_counts(verdicts: DataFrame) -> DataFrame:
    """``subtopic, n_relevant, n_verdicts``."""
    return verdicts.groupBy("subtopic").agg(F.count_if(F.coalesce("relevant", F.lit(False))).alias("n_relevant"), F.count("*").alias("n_verdicts"))


def relevant_in(verdicts: DataFrame, subtopic: str) -> DataFrame:
    """The verdicts that call an item relevant to a subtopic."""
    return verdicts.where(F.col("relevant") & (F.col("subtopic") == subtopic))


def category_audit(hits: DataFrame, verdicts: DataFrame, taxonomy: Taxonomy) -> DataFrame:
    """``item_id, subtopic, topic``: for each subtopic, items judged not relevant claimed by topics nobody filled.

    Items are walked by id; the first empty topic in the taxonomy's order whose audit keywords an item holds claims it, and is empty
    no more. hits: scoring.audit_hits. A topic's claim can only fall to one of its first n items, n the subtopic's number of topics, so
    just these go to the walk: a group of at most n * n rows, whatever the number of items.
    """
    every = [(t.subtopic, t.topic) for t in taxonomy.topics]
    spark = verdicts.sparkSession
    empty = spark.createDataFrame(every, "subtopic string, topic string").join(populated(verdicts), ["subtopic", "topic"], "left_anti")
    rejected = verdicts.where(~F.coalesce("relevant", F.lit(False))).select("item_id", "subtopic").distinct()
    open_ = hits.join(F.broadcast(empty), ["subtopic", "topic"], "left_semi").join(rejected, ["item_id", "subtopic"], "left_semi")
    most = max((len(taxonomy.of(s)) for s in taxonomy.subtopics), default=0)
    first = open_.distinct().withColumn("r", F.row_number().over(Window.partitionBy("subtopic", "topic").orderBy("item_id"))).where(F.col("r") <= most)

    def walk(g: pd.DataFrame) -> pd.DataFrame:
        taken, out = set(), []
        for item, own in g.sort_values(["item_id", "ordinal"]).groupby("item_id", sort=True):
            for topic in own["topic"]:
                if topic not in taken:
                    taken.add(topic)
                    out.append((item, own["subtopic"].iloc[0], topic))
                    break
        return pd.DataFrame(out, columns=["item_id", "subtopic", "topic"])

    return first.groupBy("subtopic").applyInPandas(walk, "item_id bigint, subtopic string, topic string")


__all__ = ["Classifier", "auto_tagged", "batch_prompt", "category_audit", "classify", "item_type", "keyword_classifier", "keyword_scores", "parse_reply", "populated", "relevance_counts", "relevant_in", "split_by_prefilter"]
