"""Paged endpoints as a data source: resumption tokens, fail-over and retries stay on the source's side."""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

RETRIED = frozenset({429, 500, 502, 503, 504})
SLOW_SECONDS = 30.0


def retry_delay(attempt: int, seconds_taken: float, status: int, retry_after: float | None, cap: float = 900.0) -> float:
    """A server's wish first; a slow 503 backs off like a time-out, by the minute; others by the second."""
    if retry_after is not None:
        return min(cap, retry_after)
    if status == 503 and seconds_taken >= SLOW_SECONDS:
        return min(cap, 60.0 * 2 ** (attempt - 1))
    return min(cap, 2.0**attempt)


def http_get(url: str) -> tuple[int, bytes, dict[str, str]]:
    try:
        with urllib.request.urlopen(url, timeout=300) as answer:  # noqa: S310
            return answer.status, answer.read(), dict(answer.headers)
    except urllib.error.HTTPError as e:
        return e.code, b"", dict(e.headers or {})


def fetch(url: str, get: Callable = http_get, attempts: int = 5, sleep: Callable[[float], None] = time.sleep) -> ElementTree.Element:
    """One parsed page; statuses of RETRIED and pages that don't parse are tried again."""
    last = "nothing tried"
    for attempt in range(1, attempts + 1):
        began = time.monotonic()
        status, body, headers = get(url)
        if status == 200:
            try:
                return ElementTree.fromstring(body)
            except ElementTree.ParseError as e:
                last = f"unreadable page: {e}"
        elif status in RETRIED:
            last = f"status {status}"
        else:
            raise OSError(f"status {status} for {url}")
        if attempt < attempts:
            wish = headers.get("Retry-After", "")
            sleep(retry_delay(attempt, time.monotonic() - began, status, float(wish) if wish.isdigit() else None))
    raise OSError(f"{last} after {attempts} attempts for {url}")


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def pages(urls: list[str], query: str, get: Callable = http_get, sleep: Callable[[float], None] = time.sleep) -> Iterator[list[ElementTree.Element]]:
    """Records page by page along resumption tokens. A later address is tried only if one fails before its first page."""
    for at, base in enumerate(urls):
        began, url = False, f"{base}?verb=ListRecords&{query}"
        try:
            while url:
                root = fetch(url, get, sleep=sleep)
                error = next((e for e in root.iter() if _local(e.tag) == "error"), None)
                if error is not None:
                    if error.get("code") == "noRecordsMatch":
                        return
                    raise OSError(f"{error.get('code')}: {error.text}")
                records = [e for e in root.iter() if _local(e.tag) == "record"]
                began = True
                yield records
                token = next((e.text for e in root.iter() if _local(e.tag) == "resumptionToken" and e.text), None)
                url = f"{base}?verb=ListRecords&resumptionToken={token}" if token else ""
            return
        except OSError:
            if began or at == len(urls) - 1:
                raise


MOST_RESULTS = 30_000
_Page = tuple[list[ElementTree.Element], int]


def search_page(url: str, query: str, start: int, size: int, get: Callable = http_get, sleep: Callable[[float], None] = time.sleep, attempts: int = 5) -> _Page:
    """(entries, total) of one page of a search, newest first. An empty page inside the listing is asked for again."""
    for attempt in range(1, attempts + 1):
        root = fetch(f"{url}?search_query={query}&sortBy=lastUpdatedDate&sortOrder=descending&start={start}&max_results={size}", get, attempts, sleep)
        total = next((int(e.text or 0) for e in root.iter() if _local(e.tag) == "totalResults"), 0)
        entries = [e for e in root.iter() if _local(e.tag) == "entry"]
        if entries or start >= total:
            break
        if attempt < attempts:
            sleep(3.0 * attempt)
    return entries, total


def newest_first(page: Callable[[int], _Page], since: str, until: str | None = None, most: int = MOST_RESULTS) -> tuple[list[ElementTree.Element], bool]:
    """(entries updated in [since, until], whether none is missing).

    Pages come newest first; reading stops after a page whose last entry is older than since. A listing
    that is cut at `most` results, or by a page that stays empty, isn't complete.
    """
    found, start = [], 0
    while start < most:
        entries, total = page(start)
        if not entries:
            return found, start >= total
        days = [next((e.text or "" for e in x.iter() if _local(e.tag) == "updated"), "")[:10] for x in entries]
        found += [x for x, day in zip(entries, days, strict=True) if since <= day <= (until or "9999")]
        start += len(entries)
        if days[-1] < since or start >= total:
            return found, True
    return found, False


class _SearchReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        """One for each query: its pages follow each other until they are too old."""
        return [InputPartition(q) for q in self.options.get("queries", "cat:*").split(",")]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        size = int(self.options.get("page_size", "1000"))
        entries, complete = newest_first(lambda start: search_page(self.options["urls"], partition.value, start, size), self.options["since"], self.options.get("until"))
        for e in entries:
            yield ElementTree.tostring(e, encoding="unicode"), partition.value, complete
        yield None, partition.value, complete  # the verdict stands even where nothing was found


class SearchDataSource(DataSource):
    """spark.read.format("skein_search").option("urls", ...).option("since", ...).load(): one XML entry a row, and one without for each query."""

    @classmethod
    def name(cls) -> str:
        return "skein_search"

    def schema(self) -> str:
        return "entry string, query string, complete boolean"

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return _SearchReader(dict(self.options))


FORMATS = {"oai": "skein_oai", "api": "skein_search"}


def source_format(config: dict[str, str]) -> str:
    """The data source a configuration names; the search is the default."""
    name = config.get("source", "api")
    if name not in FORMATS:
        raise ValueError(f"source must be one of {', '.join(sorted(FORMATS))}, not {name!r}")
    return FORMATS[name]


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        """One for each set asked for; a set's pages follow each other by token and can't be split."""
        return [InputPartition(s) for s in self.options.get("sets", "").split(",")]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        query = "&".join(f"{k}={v}" for k, v in (("metadataPrefix", self.options.get("prefix", "arXivRaw")), ("from", self.options.get("since")), ("until", self.options.get("until")), ("set", partition.value)) if v)
        for records in pages(self.options["urls"].split(","), query):
            for r in records:
                yield (ElementTree.tostring(r, encoding="unicode"),)


class OaiDataSource(DataSource):
    """spark.read.format("skein_oai").option("urls", ...).option("since", ...).load(): one XML record a row."""

    @classmethod
    def name(cls) -> str:
        return "skein_oai"

    def schema(self) -> str:
        return "record string"

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return _Reader(dict(self.options))


def register(spark: SparkSession) -> None:
    for source in (OaiDataSource, SearchDataSource):
        spark.dataSource.register(source)
