"""A catalogue search as a Python data source.

Requests are planned on the driver (batches of merged boxes, spans of the window), a partition a request chain; pages
stream through an iterator, so a reader holds one page.  ``transport`` names what answers requests: a folder of saved
pages here, as there is no network in tests; a callable ``module:function`` that posts a body elsewhere.
"""

from __future__ import annotations

import importlib
import json
import threading
import time
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

#: Items a page by level, pause between requests, attempts and their longest waits in seconds.
PAGE, PAUSE, ATTEMPTS = {"l1c": 1000, "l2a": 200}, 0.25, 7
WAITS = (1, 2, 4, 8, 16, 16)
#: Catalogue end points.
ENDPOINTS = {"cdse": "https://stac.dataspace.copernicus.eu/v1", "aws": "https://earth-search.aws.element84.com/v1"}


def endpoint(source: str) -> str:
    """Where the catalogue of a source (``cdse-l1c``, ``cdse``, ``aws-l1c``, ``aws``) answers."""
    return ENDPOINTS["cdse" if source.startswith("cdse") else "aws"]


def level_of(source: str) -> str:
    return "l1c" if source.endswith("l1c") else "l2a"


def mask_source(source: str) -> str:
    """The source on the same catalogue whose scenes have a cloud mask."""
    return "cdse" if source.startswith("cdse") else "aws"


class Refused(Exception):
    """A response that is not a page: status, and seconds the server asked to wait."""

    def __init__(self, status: int, wait: float | None = None):
        super().__init__(f"status {status}")
        self.status, self.wait = status, wait


def retryable(status: int) -> bool:
    return status in (408, 429) or status >= 500


def body(collection: str, boxes: list[tuple], start: str, end: str, limit: int) -> dict:
    """Search body: one box as ``bbox``, several as a MultiPolygon to intersect."""
    out = {"collections": [collection], "datetime": f"{start}T00:00:00Z/{end}T23:59:59Z", "limit": limit}
    if len(boxes) == 1:
        return out | {"bbox": list(boxes[0])}
    ring = lambda w, s, e, n: [[[w, s], [e, s], [e, n], [w, n], [w, s]]]
    return out | {"intersects": {"type": "MultiPolygon", "coordinates": [ring(*b) for b in boxes]}}


class Pace:
    """At least ``PAUSE`` between the requests of this process, whichever search makes them, and their number."""

    def __init__(self) -> None:
        self.lock, self.last, self.requests = threading.Lock(), float("-inf"), 0

    def wait(self, sleep: Callable[[float], None], waited: float = 0.0) -> None:
        """Pauses if the last request was just now and its caller has not ``waited`` since."""
        with self.lock:
            if max(time.monotonic() - self.last, waited) < PAUSE:
                sleep(PAUSE)
            self.last = time.monotonic()
            self.requests += 1


PACE = Pace()


def request(post: Callable[[dict], dict], payload: dict, sleep: Callable[[float], None] = time.sleep) -> dict:
    """A page, after up to seven attempts: lost connections and the statuses of ``retryable`` are tried again, after the
    wait that the server states or else ever longer ones.  Other statuses, and answers that are not JSON objects, end the search."""
    waited = 0.0
    for attempt in range(ATTEMPTS):
        PACE.wait(sleep, waited)
        try:
            page = post(payload)
        except (Refused, OSError, EOFError) as e:  # OSError: connections refused, reset and timed out
            refused = isinstance(e, Refused)
            if refused and not retryable(e.status) or isinstance(e, FileNotFoundError) or attempt + 1 == ATTEMPTS:
                raise
            waited = e.wait if refused and e.wait is not None else WAITS[attempt]
            sleep(waited)
            continue
        if not isinstance(page, dict):
            raise ValueError("the catalogue's answer is not a page")
        return page
    raise AssertionError("unreachable")


def pages(post: Callable[[dict], dict], payload: dict, sleep: Callable[[float], None] = time.sleep) -> Iterator[dict]:
    """All pages of a search, one at a time."""
    while True:
        page = request(post, payload, sleep)
        yield page
        following = next((x for x in page.get("links", []) if x.get("rel") == "next"), None)
        if following is None:
            return
        payload = payload | following.get("body", {}) if following.get("merge", True) else following["body"]


def folder_transport(path: str) -> Callable[[dict], dict]:
    """Answers a search from saved pages ``0.json``, ``1.json`` and so on; the token is the page's number."""

    def post(payload: dict) -> dict:
        k = int(payload.get("token", 0))
        with open(f"{path}/{k}.json", encoding="utf-8") as f:
            page = json.load(f)
        try:
            open(f"{path}/{k + 1}.json", encoding="utf-8").close()
            page["links"] = [{"rel": "next", "body": {"token": k + 1}, "merge": True}]
        except FileNotFoundError:
            page["links"] = []
        return page

    return post


class Search(InputPartition):
    def __init__(self, payload: dict):
        self.payload = payload


class StacReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[Search]:
        from ..operators.scenes import disjoint, split_window, widen

        o = self.options
        boxes = [widen(tuple(b)) for b in json.loads(o["boxes"])]
        size, level = int(o.get("batch", 100)), o.get("level", "l1c")
        spans = split_window(o["start"], o["end"], int(o.get("spans", 1)))
        return [Search(body(o["collection"], disjoint(boxes[k : k + size]), a, b, PAGE[level])) for k in range(0, len(boxes), size) for a, b in spans]

    def read(self, partition: Search) -> Iterator[tuple]:
        where = self.options["transport"]
        if where.startswith("folder:"):
            post = folder_transport(where.removeprefix("folder:"))
        else:
            module, name = where.split(":")
            post = getattr(importlib.import_module(module), name)
        for page in pages(post, partition.payload):
            for item in page.get("features", []):
                yield (json.dumps(item),)


class StacSource(DataSource):
    """``spark.read.format("stac_items")`` with options collection, boxes (JSON), start, end, level, batch, spans, transport."""

    @classmethod
    def name(cls) -> str:
        return "stac_items"

    def schema(self) -> str:
        return "item string"

    def reader(self, schema: StructType) -> StacReader:
        return StacReader(dict(self.options))
