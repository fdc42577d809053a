"""Web services as a Spark data source: a page or a (year, county) is one partition.

The transport is passed in, so that tests and machines without a network use
recorded answers. A partition retries; a year whose counties all fail is
skipped, one of which only some fail is an error, as a partial year would look
complete.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


#: Columns for what went wrong with a request, and for the tag of a query; rows of one page.
FAILURE, TAG, PAGE = "_failure", "_tag", 50_000


class ServiceError(RuntimeError):
    """A service gave no answer, or only a part of one."""


def retried(call: Callable[[], str], tries: int = 4, pause: float = 1.5, sleep: Callable[[float], None] = time.sleep) -> str:
    """The answer of the first call that works, with growing pauses."""
    for n in range(1, tries + 1):
        try:
            return call()
        except OSError as e:
            if n == tries:
                raise ServiceError(str(e)) from e
            sleep(pause * n)
    raise AssertionError


def fetch(url: str) -> str:
    """The text behind a URL; file URLs work too."""
    from urllib.request import urlopen

    with urlopen(url, timeout=60) as answer:  # noqa: S310
        return answer.read().decode("utf-8")


@dataclass
class Page(InputPartition):
    year: int
    url: str


class TableReader(DataSourceReader):
    """Rows of JSON tables whose first row names the columns; one URL for each partition."""

    def __init__(self, schema, options):
        self.names, self.pause = [f.name for f in schema.fields], float(options.get("pause", 1.5))
        self.pages = [Page(int(y), u) for y, u in json.loads(options["pages"])]

    def partitions(self) -> list[Page]:
        return self.pages

    def read(self, partition: Page) -> Iterator[tuple]:
        try:
            head, *rows = json.loads(retried(lambda: fetch(partition.url), pause=self.pause))
        except (ServiceError, ValueError) as e:
            if FAILURE not in self.names:
                raise ServiceError(str(e)) from e
            yield tuple(str(partition.year) if n == "year" else str(e) if n == FAILURE else None for n in self.names)
            return
        place = {n: k for k, n in enumerate(head)}
        for row in rows:
            yield tuple(str(partition.year) if n == "year" else row[place[n]] if n in place else None for n in self.names)


class TableService(DataSource):
    """``spark.read.format("table_service").schema(...).option("pages", json)``: the schema is the pruned list of columns."""

    @classmethod
    def name(cls) -> str:
        return "table_service"

    def reader(self, schema) -> TableReader:
        return TableReader(schema, self.options)


def table_pages(base: str, years: list[int], counties: list[str], variables: list[str], level: str = "tract", key: str | None = None) -> list[tuple[int, str]]:
    """One URL for each year and county, or for counties each state; subject tables have a path of their own."""
    subject = "/subject" if any(v.startswith("S") for v in variables) else ""
    names = ",".join(variables)
    if level == "tract":
        places = [f"for=tract:*&in=state:{c[:2]}%20county:{c[2:]}" for c in counties]
    else:
        places = [f"for=county:*&in=state:{s}" for s in sorted({c[:2] for c in counties})]
    secret = f"&key={key}" if key else ""
    return [(y, f"{base}/{y}/acs/acs5{subject}?get={names}&{p}{secret}") for y in years for p in places]


def whole_years(pages: list[tuple[int, str]], failed: dict[int, int]) -> list[int]:
    """The years of which every request was answered; one of which only some were is an error, one of which none was is left out."""
    asked: dict[int, int] = {}
    for year, _ in pages:
        asked[year] = asked.get(year, 0) + 1
    if parts := [y for y, n in failed.items() if n < asked[y]]:
        raise ServiceError(f"only a part of the requests was answered for {', '.join(map(str, sorted(parts)))}")
    if not (whole := [y for y in asked if y not in failed]):
        raise ServiceError("no year was answered")
    return whole


def complete_years(pages: list[tuple[int, str]], works: Callable[[str], bool]) -> list[tuple[int, str]]:
    """The pages of years that can be read; all or nothing for each year."""
    out = []
    for year in dict.fromkeys(y for y, _ in pages):
        mine = [p for p in pages if p[0] == year]
        ok = [works(u) for _, u in mine]
        if any(ok) and not all(ok):
            raise ServiceError(f"{year}: only {sum(ok)} of {len(ok)} counties answered")
        out += mine if all(ok) else []
    return out


def paged(get: Callable[[int], list[dict]], size: int = 50_000) -> Iterator[dict]:
    """Rows page by page until one is not full."""
    start = 0
    while True:
        rows = get(start)
        yield from rows
        if len(rows) < size:
            return
        start += size


def paged_query(base: str, where: str, columns: list[str]) -> str:
    """The address of a query whose predicate and columns are worked out by the service."""
    from urllib.parse import urlencode

    return f"{base}?{urlencode({'$where': where, '$select': ','.join(columns)})}"


class PagedReader(DataSourceReader):
    """Rows of JSON objects, page by page; one query for each partition, its tag in the column TAG."""

    def __init__(self, schema, options):
        self.names = [f.name for f in schema.fields]
        self.queries = [Page(int(tag), url) for tag, url in json.loads(options["queries"])]
        self.size = int(options.get("size", PAGE))

    def partitions(self) -> list[Page]:
        return self.queries

    def read(self, partition: Page) -> Iterator[tuple]:
        def page(start: int) -> list[dict]:
            return json.loads(retried(lambda: fetch(f"{partition.url}&%24limit={self.size}&%24offset={start}")))

        for row in paged(page, self.size):
            yield tuple(str(partition.year) if n == TAG else None if row.get(n) is None else str(row[n]) for n in self.names)


class PagedService(DataSource):
    """``spark.read.format("paged_service").schema(...).option("queries", json of [tag, address])``."""

    @classmethod
    def name(cls) -> str:
        return "paged_service"

    def reader(self, schema) -> PagedReader:
        return PagedReader(schema, self.options)


def downloaded(url: str, path: Path) -> Path | None:
    """The file of an address, fetched once and never half; None if the service has none."""
    from urllib.error import HTTPError
    from urllib.request import urlopen

    if not path.exists():
        path.parent.mkdir(parents=True, exist_ok=True)
        part = path.with_name(path.name + ".part")
        try:
            with urlopen(url, timeout=600) as answer, part.open("wb") as f:  # noqa: S310
                while block := answer.read(1 << 20):
                    f.write(block)
        except HTTPError:
            part.unlink(missing_ok=True)
            return None
        part.replace(path)
    return path


def provider(setting: str | None, configured: str, has_key: bool) -> str:
    """The survey's provider: the environment's choice, else the configured one; ``auto`` depends on a key."""
    chosen = setting or configured
    return ("api" if has_key else "census_reporter") if chosen == "auto" else chosen


def preferred_tile(names: list[str]) -> str | None:
    """The best of the global tiles: masked median, masked average, median, average; the last by name."""
    for kind in ("median_masked", "average_masked", "median", "average"):
        found = sorted(n for n in names if "global" in n.lower() and kind in n)
        if found:
            return found[-1]
    return None
