"""Fetching documents for the readers: an injected transport, retries, and a pace per host, in tasks."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heddle.functions.text import host

RETRYABLE = {429, 500, 502, 503, 504}  # fixed values


@dataclass(frozen=True)
class Reply:
    status: int
    body: str = ""
    retry_after: str | None = None


#: takes an address and headers, gives a Reply, or raises OSError for what may be tried again
Transport = Callable[[str, dict], Reply]


def wait_before(attempt: int, retry_after: str | None, base: float = 2.0, most: float = 60.0) -> float:
    """Seconds to wait after a failed attempt (from 0): what the server says, else a power of the base."""
    try:
        said = float(retry_after) if retry_after is not None else None
    except ValueError:
        said = None
    return min(most, said if said is not None and said >= 0 else base**attempt)


def get(transport: Transport, url: str, headers: dict | None = None, attempts: int = 3, sleep: Callable[[float], None] = time.sleep) -> Reply:
    """The reply to a request, tried again for lost connections and RETRYABLE statuses; other statuses come back as they are."""
    reply = Reply(0)
    for i in range(attempts):
        try:
            reply = transport(url, headers or {})
        except OSError:
            reply = Reply(0)
        if reply.status and reply.status not in RETRYABLE:
            return reply
        if i + 1 < attempts:
            sleep(wait_before(i, reply.retry_after))
    return reply


def headers(name: str, contact: str, accept: str) -> dict[str, str]:
    """Who asks, and how to reach them."""
    return {"User-Agent": f"{name} (+{contact})", "Accept": accept}


def fetched(requests: DataFrame, transport: Transport, name: str, contact: str, accept: str = "*/*", pause: float = 1.0, slow: dict[str, float] | None = None, partitions: int = 32, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """``url, source, status, document`` for every request (``url, source``). All requests to a host go through one task at its pace; hosts run beside
    each other. A request that fails has a null document, and no other is touched by it. Null addresses aren't asked for."""
    said, pace = headers(name, contact, accept), dict(slow or {})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: dict[str, float] = {}
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                least = pace.get(r.host, pause)
                if r.host in last and (left := last[r.host] + least - time.monotonic()) > 0:
                    sleep(left)
                reply = get(transport, r.url, said, sleep=sleep)
                last[r.host] = time.monotonic()
                out.append((r.url, r.source, reply.status, reply.body if 200 <= reply.status < 300 else None))
            yield pd.DataFrame(out, columns=["url", "source", "status", "document"])

    asked = requests.where(F.col("url").isNotNull()).select("url", "source", F.coalesce(host(F.col("url")), F.lit("")).alias("host")).distinct()
    return asked.repartition(partitions, "host").mapInPandas(run, "url string, source string, status int, document string")
