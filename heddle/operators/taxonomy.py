"""The two-level taxonomy: subtopics, their topics, keywords and weights. A configuration of some dozens of rows."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

MAX_ROWS = 10_000
SCHEMA = "subtopic string, topic string, ordinal int, name string, description string, weight double, keywords array<string>"


@dataclass(frozen=True)
class Topic:
    subtopic: str
    topic: str
    ordinal: int
    name: str = ""
    description: str = ""
    weight: float = 1.0
    keywords: tuple[str, ...] = ()


@dataclass(frozen=True)
class Taxonomy:
    """Topics in order, names of networks by kind, tags by source, and audit keywords by topic where they differ from the first eight."""

    topics: tuple[Topic, ...]
    network: dict[str, dict[str, str]] = field(default_factory=dict)  # kind (author, organization, publication) -> name -> description
    source_tags: dict[str, list[tuple[str, str]]] = field(default_factory=dict)  # source key -> (subtopic, topic)
    secondary: frozenset[str] = frozenset()
    audit: dict[tuple[str, str], list[str]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if problems := self.problems():
            raise ValueError(f"{len(problems)} problem(s): " + "; ".join(problems))

    def problems(self) -> list[str]:
        out = [] if self.topics else ["there are no topics"]
        seen = set()
        for t in self.topics:
            if not t.subtopic or not t.topic:
                out.append(f"topic {t.ordinal} lacks a subtopic or key")
            if (t.subtopic, t.topic) in seen:
                out.append(f"{t.subtopic}/{t.topic} is there twice")
            seen.add((t.subtopic, t.topic))
        out += [f"the network has no kind {k}" for k in self.network if k not in ("author", "organization", "publication")]
        out += [f"the network name {n} isn't in lower case" for names in self.network.values() for n in names if n != n.lower()]
        out += [f"a tag of {s} names the unknown topic {p}" for s, tags in self.source_tags.items() for p in tags if tuple(p) not in seen]
        return out

    @classmethod
    def read(cls, table: DataFrame, **more) -> Taxonomy:
        """From a taxonomy table of at most MAX_ROWS rows; null weights count as 1, null keywords as none."""
        rows = table.select("subtopic", "topic", "ordinal", "name", "description", "weight", "keywords").distinct().limit(MAX_ROWS + 1).collect()
        if len(rows) > MAX_ROWS:
            raise ValueError(f"a taxonomy has at most {MAX_ROWS} topics")
        topics = [Topic(r[0], r[1], r[2] or 0, r[3] or "", r[4] or "", 1.0 if r[5] is None else r[5], tuple(k for k in r[6] or () if k)) for r in rows]
        return cls(tuple(sorted(topics, key=lambda t: (t.ordinal, t.subtopic, t.topic))), **more)

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(t.subtopic, t.topic, t.ordinal, t.name, t.description, t.weight, list(t.keywords)) for t in self.topics], SCHEMA)

    @property
    def subtopics(self) -> list[str]:
        return list(dict.fromkeys(t.subtopic for t in self.topics))

    def of(self, subtopic: str) -> list[Topic]:
        return [t for t in self.topics if t.subtopic == subtopic]

    def audit_keywords(self, topic: Topic, first: int = 8) -> list[str]:
        return list(self.audit.get((topic.subtopic, topic.topic), topic.keywords[:first]))

    def prompt(self, subtopics: Iterable[str]) -> str:
        """What a classifier is told of some subtopics: always the same text for the same subtopics, in whatever order."""
        lines = []
        for s in sorted(set(subtopics)):
            lines.append(f"## {s}")
            lines += [f"- {t.topic}: {t.name}. {t.description}".rstrip() for t in self.of(s)]
        return "\n".join(lines)
