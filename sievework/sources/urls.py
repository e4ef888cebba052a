"""URL lists and a paced, retrying fetcher."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.filters import is_fetchable

# Answers that no retry changes.
FINAL = (400, 401, 403, 404, 410)


def url_rows(metadata: DataFrame, column: str, *, id_col: str | None = None, required_true: str | None = None, source: str = "", limit: int = 0) -> DataFrame:
    """(url, row_id, source), one row per distinct fetchable url; list columns are exploded; the required flag must be a true boolean. ``limit`` keeps the first urls in order, 0 all."""
    kind = dict(metadata.dtypes)[column]
    rows = metadata
    if required_true:
        rows = metadata.where(F.col(required_true) if dict(metadata.dtypes)[required_true] == "boolean" else F.lit(False))
    url = F.explode(column) if kind.startswith("array") else F.col(column)
    out = rows.select(url.alias("url"), (F.col(id_col).cast("string") if id_col else F.lit("")).alias("row_id"), F.lit(source).alias("source"))
    out = out.where(is_fetchable(F.col("url"))).groupBy("url").agg(F.min("row_id").alias("row_id"), F.first("source").alias("source"))
    return out.orderBy("url").limit(limit) if limit else out


class Pacer:
    """Starts of requests are ``delay`` seconds apart."""

    def __init__(self, delay: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.delay, self.clock, self.sleep, self.next = delay, clock, sleep, None

    def wait(self) -> None:
        now = self.clock()
        if self.next is not None and self.next > now:
            self.sleep(self.next - now)
        self.next = max(now, self.next if self.next is not None else now) + self.delay


def retry_delay(attempt: int, retry_after: str | None) -> float:
    try:
        return min(120.0, max(0.0, float(retry_after)))
    except (TypeError, ValueError):
        return min(30.0, 2.0**attempt)


def fetch_one(url: str, opener: Callable, pacer: Pacer, retries: int, most_bytes: int) -> tuple[bytes | None, str]:
    """(body, "") or (None, reason). ``opener(url)`` gives (status, headers, body)."""
    reason = ""
    for attempt in range(retries + 1):
        pacer.wait()
        try:
            status, headers, body = opener(url)
        except OSError as e:
            status, headers, body, reason = 0, {}, b"", type(e).__name__
        if status == 200:
            return (body, "") if len(body) <= most_bytes else (None, "too_large")
        reason = f"http_{status}" if status else reason
        if status in FINAL:
            break
        if attempt < retries:
            pacer.sleep(retry_delay(attempt, headers.get("Retry-After")))
    return None, reason


def fetch(urls: DataFrame, opener: Callable, *, delay: float = 2.0, tasks: int = 1, retries: int = 4, most_bytes: int = 100 << 20) -> DataFrame:
    """(url, row_id, content, reason). Each of ``tasks`` tasks waits tasks x delay between starts, so all together keep the delay."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pacer = Pacer(delay * tasks)
        for pdf in batches:
            got = [fetch_one(u, opener, pacer, retries, most_bytes) for u in pdf["url"]]
            yield pdf[["url", "row_id"]].assign(content=[b for b, _ in got], reason=[r for _, r in got])

    return urls.select("url", "row_id").repartition(tasks).mapInPandas(run, "url string, row_id string, content binary, reason string")
