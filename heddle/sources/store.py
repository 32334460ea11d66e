"""Tables as snapshots: new files are written beside the old ones, then one list of all tables' files under the next number; readers take the highest
and never see half of a commit, of however many tables."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The tables and their columns.
TABLES = {
    "items": "id bigint, url string, content_hash string, title string, abstract string, content string, authors string, source string, source_id string, source_name string, published_date date, crawled_at timestamp, raw_metadata string, api_refused_at timestamp, api_refusal_type string",
    "classifications": "id bigint, item_id bigint, subtopic string, relevant boolean, confidence string, reasoning string, classified_at timestamp",
    "item_topics": "id bigint, item_id bigint, subtopic string, topic_key string",
    "network_connections": "id bigint, item_id bigint, connection_name string, connection_description string",
    "sources": "id bigint, key string, name string, source_type string, crawler_type string, subtopics array<string>, url string, feed_url string, issn string, openalex_source_id string, crawl_config string, is_enabled boolean, crawl_status string, crawl_error string, consecutive_failures int, last_crawled_at timestamp, created_at timestamp, updated_at timestamp",
    "feeds": "id bigint, slug string, name string, description string, filter_config string, created_at timestamp, is_active boolean",
    "feed_snapshots": "id bigint, feed_id bigint, week_ending date, item_ids array<bigint>, created_at timestamp",
    "topic_summaries": "id bigint, feed_id bigint, topic_key string, week_ending date, summary string, item_hash string, created_at timestamp",
    "crawl_state": "source string, saved timestamp, last_run timestamp",
    "migrations": "name string, applied_at timestamp",
    "user_read_items": "id bigint, user_email string, item_id bigint, read_at timestamp",
    "user_feed_preferences": "id bigint, user_email string, feed_slug string, preferences string, updated_at timestamp",
}


# The tables kept in buckets by a hash of a column, so that a change rewrites the buckets it touches only.
BUCKETED = {"items": "url"}


class Store:
    """Tables under a root folder on any file system Spark writes to.

    A commit of several tables is seen whole or not at all. Two writers of one table: the second is refused if the first came between its reading
    and its commit; writers of different tables don't disturb each other. buckets: how many the tables of BUCKETED get when they are first
    written; take so many that a crawl touches few of them.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        jvm = spark._jvm
        self._path = lambda p: jvm.org.apache.hadoop.fs.Path(f"{self.root}/{p}" if p else self.root)
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())
        self._seen: dict[str, dict | None] = {}

    def _names(self, folder: str) -> list[str]:
        path = self._path(folder)
        return [f.getPath().getName() for f in self._fs.listStatus(path)] if self._fs.exists(path) else []

    def _numbers(self) -> list[int]:
        """The numbers of the commits: each list is written once and never moved, so a crash at any step leaves the last one in force."""
        return [int(n.rpartition("-")[2]) for n in self._names("") if n.startswith("_current-")]

    def _tables(self) -> tuple[int, dict]:
        """The number of the last commit and its list: by table the number of buckets and the folder of each that has rows."""
        number = max(self._numbers(), default=0)
        if not number:
            return 0, {}
        stream = self._fs.open(self._path(f"_current-{number}"))
        try:
            return number, json.loads(stream.readLine())
        finally:
            stream.close()

    def bucket(self, table: str, key: Column) -> Column:
        """The bucket of a row of a table in BUCKETED, by the value of the column there."""
        now = self._tables()[1].get(table)
        return F.pmod(F.xxhash64(key), F.lit(now["n"] if now else self.buckets)).cast("int")

    def read(self, table: str, only: list[int] | None = None) -> DataFrame:
        """The current version, or just some of its buckets; no rows before the first commit."""
        now = self._tables()[1].get(table)
        self._seen[table] = now
        folders = [f for b, f in sorted((now or {"folders": {}})["folders"].items()) if only is None or int(b) in only]
        if not folders:
            return self.spark.createDataFrame([], TABLES[table])
        return self.spark.read.schema(TABLES[table]).parquet(*[f"{self.root}/{table}/{f}" for f in folders])

    def _written(self, table: str, df: DataFrame, only: list[int] | None) -> dict:
        """``df`` written, and the table's entry for the list. Columns that are missing are null."""
        version = f"v-{uuid.uuid4().hex}"
        schema = self.spark.createDataFrame([], TABLES[table]).schema
        out = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])
        if table not in BUCKETED:
            out.write.parquet(f"{self.root}/{table}/{version}")
            return {"n": 1, "folders": {"0": version}}
        now = self._tables()[1].get(table) or {"n": self.buckets, "folders": {}}
        out.withColumn("_bucket", self.bucket(table, F.col(BUCKETED[table]))).hint("rebalance", "_bucket").write.partitionBy("_bucket").parquet(f"{self.root}/{table}/{version}")
        made = {n.partition("=")[2]: f"{version}/{n}" for n in self._names(f"{table}/{version}") if n.startswith("_bucket=")}
        kept = {} if only is None else {b: f for b, f in now["folders"].items() if int(b) not in only}
        return {"n": now["n"], "folders": kept | made}

    def commit(self, tables: dict[str, DataFrame], only: dict[str, list[int]] | None = None) -> int:
        """Commit the next versions of some tables, all at once, and give the commit's number. Older files stay.

        only: for a table in buckets, those that the rows given replace; its others stay as they are. Rows outside of them aren't allowed.
        """
        base = self._tables()[1]
        seen = {t: self._seen.get(t, base.get(t)) for t in tables}
        entries = {t: self._written(t, df, (only or {}).get(t)) for t, df in tables.items()}
        while True:
            number, now = self._tables()
            for t in tables:
                if now.get(t) != seen[t]:
                    raise RuntimeError(f"another writer committed {t}")
            staged, final = self._path(f"_next-{uuid.uuid4().hex}"), self._path(f"_current-{number + 1}")
            stream = self._fs.create(staged, True)
            stream.writeBytes(json.dumps(now | entries))
            stream.close()
            if not self._fs.exists(final) and self._fs.rename(staged, final):
                self._seen |= entries
                return number + 1

    def write(self, table: str, df: DataFrame) -> int:
        """Commit one table, whole."""
        return self.commit({table: df})

    def missing(self) -> list[str]:
        """The tables that have no version yet, in order."""
        have = self._tables()[1]
        return [t for t in TABLES if t not in have]

    def create_missing(self) -> list[str]:
        """An empty first version of each table that has none, in one commit; those made."""
        todo = self.missing()
        if todo:
            self.commit({t: self.spark.createDataFrame([], TABLES[t]) for t in todo})
        return todo

    def apply(self, changes: dict[str, Callable[[Store], dict[str, DataFrame]]], now: dt.datetime, dry: bool = False) -> list[str]:
        """Changes to the tables by name, each applied once, in the order of names, in one commit with the note that it was; those applied (or due, if dry)."""
        had = {r.name for r in self.read("migrations").select("name").collect()}
        due = [n for n in sorted(changes) if n not in had]
        for name in [] if dry else due:
            note = self.spark.createDataFrame([(name, now)], TABLES["migrations"])
            self.commit({**changes[name](self), "migrations": self.read("migrations").unionByName(note)})
        return due
