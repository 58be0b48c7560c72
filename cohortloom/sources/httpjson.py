"""A paged JSON service as a Spark data source, with replay from files and a durable page cache."""

from __future__ import annotations

import json
import re
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class FetchFailed(OSError):
    """A page that could not be had after all retries; a scan that meets one fails instead of ending early."""


def fetch(url: str, retries: int = 3, delay: float = 0.0, timeout: float = 30.0, body: dict | None = None, sleep: Callable[[float], None] = time.sleep) -> str:
    """The answer to a GET, or to a POST of ``body`` as JSON; ``file://`` addresses replay a saved answer.

    After success ``delay`` seconds pass. A failure is tried again after 1, 2, 4 ... seconds, an answer of 429 or 503
    after the seconds it asks for; an answer that says the address is wrong is not tried again.
    """
    last: Exception | None = None
    for attempt in range(max(1, retries)):
        wait = float(2**attempt) if url.startswith("http") else 0.0
        try:
            request = urllib.request.Request(url, json.dumps(body).encode() if body is not None and url.startswith("http") else None, {"Content-Type": "application/json"} if body is not None else {})
            with urllib.request.urlopen(request, timeout=timeout) as r:  # noqa: S310 - the scheme is the caller's
                text = r.read().decode("utf-8")
            sleep(delay)
            return text
        except urllib.error.HTTPError as e:
            last = e
            if e.code in (429, 503):
                asked = e.headers.get("Retry-After", "") if e.headers else ""
                wait = float(asked) if re.fullmatch(r"\d+", asked or "") else wait
            elif 400 <= e.code < 500:
                break
        except OSError as e:
            last = e
        if attempt + 1 < retries:
            sleep(wait)
    raise FetchFailed(f"{url}: {last}")


def page_url(base: str, params: dict[str, str], token: str | None) -> str:
    if base.startswith("file://"):
        return f"{base.rstrip('/')}/{token or 'first'}.json"
    extra = {"pageToken": token} if token else {}
    return f"{base}?{urllib.parse.urlencode({**params, **extra})}"


class _Query(InputPartition):
    def __init__(self, params: dict[str, str]):
        self.params = params


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        return [_Query(q) for q in json.loads(self.options.get("queries", "[{}]"))]

    def _page(self, params: dict, token: str | None, page: int) -> dict:
        base, o = self.options["url"], self.options
        ways = {"retries": int(o.get("retries", "3")), "delay": float(o.get("delay", "0"))}
        if o.get("method", "get").lower() == "post":  # the page's number goes into the body
            url = f"{base.rstrip('/')}/{page + 1}.json" if base.startswith("file://") else base
            return json.loads(fetch(url, body={**params, "pagination": {**params.get("pagination", {}), "page": page + 1}}, **ways))
        return json.loads(fetch(page_url(base, params, token), **ways))

    def read(self, partition: _Query) -> Iterator[tuple]:
        field, fields = self.options.get("items", "studies"), [f for f in self.options.get("fields", "").split(",") if f]
        limit, token, page = int(self.options.get("maxpages", "1000000")), None, 0
        while page < limit:
            data = self._page(partition.params, token, page)
            if self.options.get("single"):  # the answer is the item itself
                yield page, 0, json.dumps(data, ensure_ascii=False)
                return
            for i, item in enumerate(data.get(field) or []):
                yield page, i, json.dumps({f: item.get(f) for f in fields} if fields and isinstance(item, dict) else item, ensure_ascii=False)
            token, page = data.get("nextPageToken"), page + 1
            if not (token or (data.get("pagination") or {}).get("nextPage")):
                return


class HttpJson(DataSource):
    """``spark.read.format("httpjson")`` with url, queries (JSON list, one partition each), items, fields, maxpages, retries, delay.

    ``method`` post pages by a number in the body while ``pagination.nextPage`` says so, get by ``nextPageToken``;
    ``single`` takes the whole answer as one item; ``fields`` keeps only those fields of an item.
    """

    @classmethod
    def name(cls) -> str:
        return "httpjson"

    def schema(self) -> str:
        return "page int, pos int, item string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(HttpJson)


def details(keys: DataFrame, key: str, base: str, retries: int = 3, delay: float = 0.0) -> DataFrame:
    """The rows with ``item``, the answer of ``base``/<key>: a lookup join to a service, one call for each distinct key.

    A key that the service does not have (404, or no file in replay) gives a null item; any other failure fails.
    """
    distinct = keys.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("_key")).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[str | None] = []
            for k in b.column(0).to_pylist():
                url = f"{base.rstrip('/')}/{urllib.parse.quote(k, safe='')}" + (".json" if base.startswith("file://") else "")
                try:
                    out.append(fetch(url, retries, delay))
                except FetchFailed as e:
                    if "404" not in str(e) and "No such file" not in str(e):
                        raise
                    out.append(None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=["_key", "item"])

    found = distinct.mapInArrow(run, "_key string, item string")
    return keys.join(found, F.col(key).cast("string") == F.col("_key"), "left").drop("_key")


def eu_trials(spark: SparkSession, search: str, retrieve: str, criteria: dict, max_pages: int = 10, retries: int = 3, delay: float = 0.0) -> DataFrame:
    """(number, raw_trial) of the trials of a paged POST search, each with its full record from the service.

    Overviews without number, and trials the service has no record of, are left out; of repeats one row stays.
    """
    register(spark)
    query = [{"pagination": {"page": 1, "size": 100}, "sort": {"property": "decisionDate", "direction": "DESC"}, "searchCriteria": criteria}]
    options = {"url": search, "method": "post", "items": "data", "queries": json.dumps(query), "maxpages": str(max_pages), "retries": str(retries), "delay": str(delay)}
    found = spark.read.format("httpjson").options(**options).load().select(F.get_json_object("item", "$.ctNumber").alias("number")).where("number is not null and number <> ''").distinct()
    return details(found, "number", retrieve, retries, delay).where("item is not null").select("number", F.col("item").alias("raw_trial"))


def one_study(spark: SparkSession, url: str, retries: int = 3) -> DataFrame:
    """(item): one record by its address, which names the record."""
    register(spark)
    return spark.read.format("httpjson").options(url=url, single="1", retries=str(retries)).load().select("item")


def _files(spark: SparkSession, folder: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    return jvm, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def cache_pages(spark: SparkSession, base: str, params: dict[str, str], folder: str, max_pages: int = 1_000_000) -> int:
    """Save pages as ``page_NNNNNN.json``; resumes behind the last complete page, does nothing once all are there. Returns the pages saved now.

    Pages go through the Hadoop file system, so the folder can be on any storage that Spark reaches; a page is
    written aside and renamed, so one that is there is whole. Pages order by their number.
    """
    jvm, fs, path = _files(spark, folder)
    fs.mkdirs(path)
    numbers = sorted(int(m.group(1)) for f in fs.listStatus(path) if (m := re.fullmatch(r"page_(\d+)\.json", f.getPath().getName())))
    token, number = None, numbers[-1] + 1 if numbers else 0
    if numbers:
        last = next(f.getPath() for f in fs.listStatus(path) if re.fullmatch(rf"page_0*{numbers[-1]}\.json", f.getPath().getName()))
        stream = fs.open(last)
        token = json.loads(bytes(stream.readAllBytes()).decode()).get("nextPageToken")
        stream.close()
        if not token:
            return 0
    saved = 0
    while saved < max_pages:
        body = fetch(page_url(base, params, token))
        part, target = (jvm.org.apache.hadoop.fs.Path(path, f"{mark}page_{number + saved:06d}.json") for mark in ("_", ""))
        out = fs.create(part, True)
        out.write(bytearray(body.encode()))
        out.close()
        fs.rename(part, target)
        saved += 1
        token = json.loads(body).get("nextPageToken")
        if not token:
            break
    return saved
