"""Rules of polite fetching, without a network: delays, redirects, robots, classification of responses."""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from email.utils import parsedate_to_datetime
from urllib.parse import urljoin, urlsplit
from urllib.robotparser import RobotFileParser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def retry_delay(attempt: int, retry_after: str | None = None, now: float | None = None, jitter: float = 0.0) -> float:
    """Seconds to wait after an attempt: what the server asks, as seconds or a date, else 5 to 15, doubling."""
    if retry_after:
        value = retry_after.strip()
        if value.isdigit():
            return float(value)
        try:
            return max(0.0, parsedate_to_datetime(value).timestamp() - (time.time() if now is None else now))
        except (TypeError, ValueError):
            pass
    return min(15.0, max(5.0, 2.0 ** (attempt - 1)) + jitter)


@dataclass
class Limiter:
    """At least ``interval`` seconds between the end of one attempt and the start of the next."""

    interval: float
    clock: object = time.monotonic
    sleep: object = time.sleep
    done: float | None = None

    def __enter__(self):
        if self.done is not None and (wait := self.done + self.interval - self.clock()) > 0:
            self.sleep(wait)
        return self

    def __exit__(self, *_):
        self.done = self.clock()


def follow(url: str, location: str, seen: set[str], root: str | None = None) -> str:
    """Target of a redirect on the same host, under ``root`` if given, not seen before; else ValueError."""
    to = urljoin(url, location)
    if urlsplit(to).scheme not in ("http", "https") or urlsplit(to).hostname != urlsplit(url).hostname:
        raise ValueError(f"redirect leaves the host: {to}")
    if root and not urlsplit(to).path.startswith(urlsplit(root).path):
        raise ValueError(f"redirect leaves {root}")
    if to in seen:
        raise ValueError(f"redirect loop at {to}")
    return to


@dataclass
class Robots:
    """Answers by origin, kept: a missing file allows all, a forbidden one nothing."""

    fetch: object
    agent: str
    kept: dict = field(default_factory=dict)

    def allows(self, url: str) -> bool:
        parts = urlsplit(url)
        origin = f"{parts.scheme}://{parts.netloc}"
        if origin not in self.kept:
            status, body = self.fetch(f"{origin}/robots.txt")
            rules = RobotFileParser()
            if status in (401, 403):
                rules.disallow_all = True
            elif status == 404:
                rules.allow_all = True
            elif status == 200:
                rules.parse(body.splitlines())
            else:
                raise ValueError(f"robots of {origin}: status {status}")
            self.kept[origin] = rules
        return self.kept[origin].can_fetch(self.agent, url)


def _has(body: Column, *words: str) -> Column:
    low = F.lower(body)
    test = F.lit(False)
    for w in words:
        test = test | low.contains(w)
    return F.coalesce(test, F.lit(False))


def is_interstitial(body: Column) -> Column:
    """Pages that check the browser instead of answering."""
    return _has(body, "captcha", "checking your browser", "verify you are human", "please enable javascript and cookies", "just a moment")


def is_api_json(body: Column) -> Column:
    return F.coalesce(body.rlike(r"^\s*[{\[]"), F.lit(False)) & _has(body, '"query"', '"error"')


def is_article(body: Column) -> Column:
    return _has(body, "<main", "<article", "mw-parser-output")


def response_kind(status: Column, body: Column) -> Column:
    """(blocked | error | api | article | other) of a recorded response, by its body before its status."""
    return (
        F.when(body.isNull() | (F.trim(body) == ""), F.lit("empty")).when(is_interstitial(body) & ~is_article(body), F.lit("blocked")).when(is_api_json(body), F.lit("api"))
        .when(is_article(body), F.lit("article")).when(status >= 400, F.lit("error")).otherwise(F.lit("other"))
    )


def is_api_probe(body: Column) -> Column:
    """Whether a body is the API's answer to a probe: a JSON object with a list of pages."""
    return F.coalesce(F.try_variant_get(F.try_parse_json(body), "$.query.allpages", "array<variant>").isNotNull(), F.lit(False))


def bounded(recorded: DataFrame, most: int, length: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(bodies of at most ``most`` bytes, the others with the code ``body_too_large`` and without their content); of files as Spark's ``binaryFile`` source reads them, by their
    stated length, so that the content of too large ones is never read."""
    size = F.col("length") if length is None else length
    kept = recorded.where(size <= most)
    dropped = [c for c in recorded.columns if c not in ("content", "body")]
    return kept, recorded.where(size > most).select(*dropped, F.lit("body_too_large").alias("code"))
