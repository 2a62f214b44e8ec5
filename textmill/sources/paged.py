"""A paged REST source of nested items as a Spark data source, with retries and a landing zone."""

from __future__ import annotations

import gzip
import hashlib
import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from textmill.operators.contracts import ContractError

#: Answers that another try would not change.
PERMANENT = frozenset((400, 401, 403, 404, 410, 422))


def with_retry(call: Callable, tries: int = 5, wait: float = 1.0):
    """call(), tried again after 1, 2, 4, ... times wait seconds; permanent failures raise at once."""
    for i in range(tries):
        try:
            return call()
        except urllib.error.HTTPError as e:
            if e.code in PERMANENT or i == tries - 1:
                raise
        except (urllib.error.URLError, TimeoutError):
            if i == tries - 1:
                raise
        time.sleep(wait * 2**i)
    raise AssertionError


def cache_key(host: str, identity: str, endpoint: str, params: dict) -> str:
    """Name of a response in the landing zone. It holds who asked, as answers differ by what one may see."""
    return hashlib.md5(json.dumps([host, identity, endpoint, sorted(params.items())]).encode()).hexdigest()


class Page(InputPartition):
    def __init__(self, number: int):
        self.number = number


class PagedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.url, self.size = options["url"], int(options.get("per_page", 100))
        self.params = json.loads(options.get("params", "{}"))
        self.tries = int(options.get("tries", 5))

    def get(self, page: int) -> tuple[list, int]:
        query = urllib.parse.urlencode(self.params | {"page": page, "per_page": self.size})

        def call():
            with urllib.request.urlopen(f"{self.url}?{query}", timeout=60) as r:
                body = r.read()
                body = gzip.decompress(body) if r.headers.get("Content-Encoding") == "gzip" else body
                return json.loads(body), int(r.headers.get("Omeka-S-Total-Results") or r.headers.get("X-Total-Count") or -1)

        return with_retry(call, self.tries)

    def partitions(self) -> list[Page]:
        first, total = self.get(1)
        pages = -(-total // self.size) if total >= 0 else (1 if first else 0)
        return [Page(i) for i in range(1, max(1, pages) + 1)]

    def read(self, partition: Page) -> Iterator[tuple]:
        items, total = self.get(partition.number)
        for i, item in enumerate(items):
            yield partition.number, i, total, json.dumps(item)


class PagedSource(DataSource):
    """spark.read.format('paged').option('url', ...): page, place, total, item (JSON)."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "page int, place int, total long, item string"

    def reader(self, schema) -> PagedReader:
        return PagedReader(dict(self.options))


def fetch(spark: SparkSession, url: str, **options: str) -> DataFrame:
    """All items of a paged endpoint; fewer rows than the total that the source states raise."""
    spark.dataSource.register(PagedSource)
    df = spark.read.format("paged").options(url=url, **options).load().checkpoint()
    got = df.agg(F.count("*").alias("n"), F.max("total").alias("total")).first()
    if got.total is not None and got.total >= 0 and got.n != got.total:
        raise ContractError(f"{got.n} of {got.total} items came")
    return df


def landed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Raw JSON files that were fetched before; broken ones count as not there."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def lookup_media(items: DataFrame, media: DataFrame, key: str, fields: list[str], attempted: str = "attempted") -> tuple[DataFrame, DataFrame]:
    """(items with their media's fields, ledger of (key, field) that could not be read). A medium that is not there is no failure; one that was asked for without an answer is."""
    out = items.join(media, key, "left")
    failed = out.where(F.coalesce(F.col(attempted), F.lit(False)) & F.col("error").isNotNull())
    ledger = failed.select(key, F.explode(F.array(*map(F.lit, fields))).alias("column"))
    return out.drop(attempted, "error"), ledger


def check_failures(attempts: int, failures: int, *, most: float = 0.0, allow: bool = False) -> None:
    if failures and not allow and failures > most * max(1, attempts):
        raise ContractError(f"{failures} of {attempts} lookups failed")
