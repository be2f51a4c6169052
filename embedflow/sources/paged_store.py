"""A paged store as a Spark data source: reader, committing writer and change feed (S15, X3, K3, S11, ST1).

Stores that hand out records page by page (cursor, offset or parallel arrays) are plugged in as a Python
``DataSource``; this one keeps its pages in a folder that driver and executors share:

    pages/<job>/<part>.arrow      an Arrow file per writing task; every record batch in it is a page
    pages/<job>/<part>.json       its index: per page the rows and the least and greatest value of the key columns
    _manifests/<number>.json      one per committed job: its parts with the same figures, append or overwrite

``register(spark)`` makes the formats known:

    df.write.format("paged_store").option("path", p).option("keys", "namespace,id").mode("append").save()
    spark.read.format("paged_store").option("path", p).load().where("namespace = 'ns1' AND id < 'v3'")
    spark.readStream.format("paged_feed").option("path", p).option("maxRowsPerTrigger", 100_000)...

* **Reading.**  A manifest is a snapshot: planning reads the manifests alone, drops parts whose figures rule
  out a pushed filter, and deals each part out in stretches of pages; a task reads its part's index, drops
  pages in the same way and opens the others.  Filters go on to Spark, too, which applies them to rows.
* **Writing.**  Two phases: tasks stage a file and its index and return a message; ``commit`` publishes one
  manifest, whole and once; ``abort`` removes what was staged.  Files that a lost or failed attempt left are
  in no manifest and are never read.  A job that is committed again under the same ``jobId`` changes nothing.
* **Feed.**  The stream's position is (manifest, keys): manifests in order, rows in order of their keys (such
  as updated_at, seq), so equal timestamps and late rows are neither lost nor repeated, and a range between
  two positions always holds the same rows.  ``maxRowsPerTrigger`` cuts at page borders,
  ``maxCommitsPerTrigger`` after so many manifests.  Spark does not tell a source where a query stands before
  it asks for more, so with a limit planned positions are kept in ``positionPath`` (a file beside the query's
  checkpoint).

The path is a local or mounted folder (plain or ``file:``); publishing needs hard links.
"""

from __future__ import annotations

import datetime as dt
import glob
import json
import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    StringStartsWith,
    WriterCommitMessage,
)

from ..storage import publish_local

PAGE_ROWS, PAGES_A_PARTITION = 4096, 64
KEYS = "namespace,id"


def _option(options, name: str, default=None):
    return options[name] if name in options else default


def _plain_path(path: str | None) -> str | None:
    if path and path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if path and "://" in path:
        raise ValueError(f"{path}: a paged store lies in a local or mounted folder")
    return path


def _folder(options) -> str:
    path = _plain_path(_option(options, "path"))
    if not path:
        raise ValueError("a paged store needs a path")
    return path


# ── figures of pages ─────────────────────────────────────────────────────────


def _plain(value):
    """A filter's value as the index has it: dates as days."""
    if isinstance(value, dt.date):
        return (value - dt.date(1970, 1, 1)).days
    return value


def _key_column(col: pa.Array) -> pa.Array:
    if pa.types.is_timestamp(col.type):
        return col.cast(pa.timestamp("us", col.type.tz)).cast(pa.int64())
    if pa.types.is_date(col.type):
        return col.cast(pa.int32())
    if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) or pa.types.is_integer(col.type):
        return col
    raise ValueError(f"a key of type {col.type} has no order to index")


def _figures(batch: pa.RecordBatch, keys: list[str]) -> dict:
    out = {"rows": batch.num_rows}
    for k in keys:
        col = _key_column(batch.column(k))
        ends = pc.min_max(col)
        out[k] = [ends["min"].as_py(), ends["max"].as_py(), col.null_count]
    return out


def _merged(figures: list[dict], keys: list[str]) -> dict:
    out = {"rows": sum(f["rows"] for f in figures)}
    for k in keys:
        least = [f[k][0] for f in figures if f[k][0] is not None]
        most = [f[k][1] for f in figures if f[k][1] is not None]
        out[k] = [min(least, default=None), max(most, default=None), sum(f[k][2] for f in figures)]
    return out


def may_hold(figures: dict, f: Filter) -> bool:
    """Can a page or part with these figures hold a row that the filter keeps?"""
    column = ".".join(getattr(f, "attribute", ()))
    if column not in figures or column == "rows":
        return True
    least, most, nulls = figures[column]
    if isinstance(f, IsNull):
        return nulls > 0
    if isinstance(f, EqualNullSafe) and f.value is None:
        return nulls > 0
    if least is None:  # nulls alone: no comparison is true of them
        return False
    if isinstance(f, IsNotNull):
        return True
    if isinstance(f, In):
        return any(isinstance(v, dt.datetime) or v is not None and least <= _plain(v) <= most for v in f.value)
    if isinstance(f.value, dt.datetime):  # its time zone is the session's: left to Spark
        return True
    v = _plain(f.value)
    if v is None:
        return False
    if isinstance(f, (EqualTo, EqualNullSafe)):
        return least <= v <= most
    if isinstance(f, GreaterThan):
        return most > v
    if isinstance(f, GreaterThanOrEqual):
        return most >= v
    if isinstance(f, LessThan):
        return least < v
    if isinstance(f, LessThanOrEqual):
        return least <= v
    if isinstance(f, StringStartsWith):
        return least[: len(v)] <= v and most >= v
    return True


USED = (EqualTo, EqualNullSafe, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual, In, IsNull, IsNotNull, StringStartsWith)


# ── manifests ────────────────────────────────────────────────────────────────


def manifests(folder: str) -> list[dict]:
    """All committed manifests, by number."""
    out = []
    for path in sorted(glob.glob(os.path.join(glob.escape(folder), "_manifests", "[0-9]*.json"))):
        with open(path, encoding="utf-8") as f:
            out.append(json.load(f))
    return out


def live(found: list[dict]) -> list[dict]:
    """From the last overwriting manifest on."""
    start = max((i for i, m in enumerate(found) if m["overwrite"]), default=0)
    return found[start:]


def _index(folder: str, part: dict) -> list[dict]:
    with open(os.path.join(folder, part["index"]), encoding="utf-8") as f:
        return json.load(f)


def _pages(folder: str, part: dict, numbers: list[int]) -> Iterator[pa.RecordBatch]:
    """The given pages of a part; the others are not read."""
    with pa.memory_map(os.path.join(folder, part["file"])) as f:
        reader = pa.ipc.open_file(f)
        for n in numbers:
            yield reader.get_batch(n)


# ── reader ───────────────────────────────────────────────────────────────────


@dataclass
class Stretch(InputPartition):
    """Pages ``first`` to ``last`` (exclusive) of a part."""

    part: dict
    first: int
    last: int


class PagesReader(DataSourceReader):
    def __init__(self, options):
        self.folder = _folder(options)
        self.pages_a_partition = int(_option(options, "pagesPerPartition", PAGES_A_PARTITION))
        self.found = live(manifests(self.folder))
        self.filters: list[Filter] = []

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, USED):
                self.filters.append(f)
            yield f  # figures rule out pages, not rows

    def parts(self) -> list[dict]:
        return [p for m in self.found for p in m["parts"] if all(may_hold(p["figures"], f) for f in self.filters)]

    def partitions(self):
        step = self.pages_a_partition
        return [Stretch(p, a, min(a + step, p["pages"])) for p in self.parts() for a in range(0, p["pages"], step)]

    def wanted(self, stretch: Stretch) -> list[int]:
        """Numbers of the pages that the filters leave."""
        index = _index(self.folder, stretch.part)
        return [n for n in range(stretch.first, stretch.last) if all(may_hold(index[n], f) for f in self.filters)]

    def read(self, partition):
        if partition is None:  # Spark's stand-in for no partitions at all
            return
        yield from _pages(self.folder, partition.part, self.wanted(partition))


# ── writer ───────────────────────────────────────────────────────────────────


@dataclass
class Staged(WriterCommitMessage):
    part: dict | None  # None: the task had no rows


class PagesWriter(DataSourceArrowWriter):
    """Stages pages in tasks, publishes a manifest in ``commit``."""

    def __init__(self, options, schema: T.StructType, overwrite: bool):
        self.folder = _folder(options)
        self.keys = [k for k in _option(options, "keys", KEYS).split(",") if k]
        self.page_rows = int(_option(options, "pageRows", PAGE_ROWS))
        self.overwrite = overwrite
        self.job = _option(options, "jobId") or uuid.uuid4().hex
        self.stage = f"{uuid.uuid4().hex[:12]}"  # two runs of one job id don't share files
        self.schema = schema.json()
        missing = [k for k in self.keys if k not in schema.fieldNames()]
        if missing:
            raise ValueError(f"key columns {missing} are not in the data")

    def write(self, iterator) -> Staged:
        part = f"{uuid.uuid4().hex}"
        stem = os.path.join("pages", self.stage, part)
        os.makedirs(os.path.join(self.folder, "pages", self.stage), exist_ok=True)
        index, sink, held, rows = [], None, [], 0

        def flush():
            page = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            sink.write_batch(page)
            index.append(_figures(page, self.keys))

        path = os.path.join(self.folder, stem + ".arrow")
        try:
            for batch in iterator:
                at = 0
                while at < batch.num_rows:
                    if sink is None:
                        sink = pa.ipc.new_file(path, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd"))
                    take = min(self.page_rows - rows, batch.num_rows - at)
                    held.append(batch.slice(at, take))
                    at, rows = at + take, rows + take
                    if rows == self.page_rows:
                        flush()
                        held, rows = [], 0
            if held:
                flush()
        finally:
            if sink is not None:
                sink.close()
        if sink is None:
            return Staged(None)
        with open(os.path.join(self.folder, stem + ".json"), "x", encoding="utf-8") as f:
            json.dump(index, f)
        figures = _merged(index, self.keys)
        return Staged({"file": stem + ".arrow", "index": stem + ".json", "pages": len(index), "figures": figures})

    def commit(self, messages) -> None:
        parts = [m.part for m in messages if m is not None and m.part is not None]
        parts.sort(key=lambda p: json.dumps(p["figures"], sort_keys=True))
        while True:
            found = manifests(self.folder)
            if any(m["job"] == self.job for m in found):  # committed before: this run's pages go
                self._withdraw()
                return
            number = found[-1]["number"] + 1 if found else 0
            entry = {"number": number, "job": self.job, "overwrite": self.overwrite, "keys": self.keys, "schema": self.schema, "parts": parts}
            if publish_local(os.path.join(self.folder, "_manifests", f"{number:012d}.json"), json.dumps(entry)):
                return

    def abort(self, messages) -> None:
        self._withdraw()

    def _withdraw(self) -> None:
        shutil.rmtree(os.path.join(self.folder, "pages", self.stage), ignore_errors=True)


# ── feed ─────────────────────────────────────────────────────────────────────


@dataclass
class Range(InputPartition):
    """Pages of a part, and the keys (exclusive, inclusive) between which their rows are wanted; None: no bound."""

    part: dict
    pages: list
    after: list | None
    upto: list | None


class FeedReader(DataSourceStreamReader):
    """Positions are ``{"manifest": m, "keys": [...]}``: rows of manifest m up to those keys, all of those before."""

    def __init__(self, options):
        self.folder = _folder(options)
        self.limit = int(_option(options, "maxRowsPerTrigger", 0))
        self.commits = int(_option(options, "maxCommitsPerTrigger", 0))
        self.position_path = _plain_path(_option(options, "positionPath"))
        if (self.limit or self.commits) and not self.position_path:
            raise ValueError("a limit per trigger needs positionPath, a file beside the query's checkpoint")
        self.planned: dict | None = None

    def initialOffset(self) -> dict:
        return {"manifest": -1, "keys": "[]"}

    def _last_planned(self) -> dict:
        if self.planned is None and self.position_path and os.path.exists(self.position_path):
            with open(self.position_path, encoding="utf-8") as f:
                self.planned = json.load(f)
        return self.planned or self.initialOffset()

    def latestOffset(self) -> dict:
        """The end of the feed; with a limit, the page border or commit at which what came since the last plan reaches it."""
        start = self._last_planned()
        found = [m for m in manifests(self.folder) if m["number"] >= max(start["manifest"], 0)]
        end, rows, commits = start, 0, 0
        for m in found:
            after = _keys(start) if m["number"] == start["manifest"] else None
            pages = [(_ends(p, m["keys"]), p["rows"]) for part in m["parts"] for p in _index(self.folder, part)] if self.limit else []
            for last, n in sorted(pages, key=lambda x: _order(x[0])):
                if after is not None and _order(last) <= _order(after):
                    continue
                end, rows = {"manifest": m["number"], "keys": json.dumps(last)}, rows + n
                if rows >= self.limit:
                    return end
            if not m["parts"]:
                continue
            last = max((_ends(p["figures"], m["keys"]) for p in m["parts"]), key=_order)
            if after is None or _order(last) > _order(after):
                end, commits = {"manifest": m["number"], "keys": json.dumps(last)}, commits + 1
            if commits and commits == self.commits:
                return end
        return end

    def partitions(self, start: dict, end: dict):
        if (end["manifest"], _order(_keys(end))) < (start["manifest"], _order(_keys(start))):
            raise ValueError(f"the query stands at {start}, beyond {end}: positionPath does not belong to its checkpoint")
        if self.position_path and end != self.planned:
            _put(self.position_path, json.dumps(end))
        self.planned = end
        out = []
        for m in manifests(self.folder):
            if not start["manifest"] <= m["number"] <= end["manifest"]:
                continue
            after = _keys(start) if m["number"] == start["manifest"] else None
            upto = _keys(end) if m["number"] == end["manifest"] else None
            for part in m["parts"]:
                pages = [n for n, p in enumerate(_index(self.folder, part)) if _meets(p, m["keys"], after, upto)]
                if pages:
                    out.append(Range({**part, "keys": m["keys"]}, pages, after, upto))
        return out

    def read(self, partition):
        keys = partition.part["keys"]
        for batch in _pages(self.folder, partition.part, partition.pages):
            columns = [_key_column(batch.column(k)) for k in keys]
            keep = pa.array([True] * batch.num_rows)
            if partition.after is not None:
                keep = pc.and_(keep, _beyond(columns, partition.after))
            if partition.upto is not None:
                keep = pc.and_(keep, pc.invert(_beyond(columns, partition.upto)))
            yield batch.filter(keep)

    def commit(self, end: dict) -> None:
        return None


def _put(path: str, text: str) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    temp = f"{path}.{uuid.uuid4().hex}"
    with open(temp, "x", encoding="utf-8") as f:
        f.write(text)
    os.replace(temp, path)


def _keys(position: dict) -> list:
    return json.loads(position["keys"])


def _order(keys: list) -> tuple:
    """Nulls come first."""
    return tuple((k is not None, k if k is not None else 0) for k in keys)


def _ends(figures: dict, keys: list[str]) -> list:
    """An upper bound of a page's keys: each key's greatest value."""
    return [figures[k][1] for k in keys]


def _meets(figures: dict, keys: list[str], after: list | None, upto: list | None) -> bool:
    lowest = [None if figures[k][2] else figures[k][0] for k in keys]
    return (after is None or _order(_ends(figures, keys)) > _order(after)) and (upto is None or _order(lowest) <= _order(upto))


def _beyond(columns: list[pa.Array], keys: list) -> pa.Array:
    """Rows whose keys come after ``keys``."""
    out = pa.array([False] * len(columns[0]))
    tied = pa.array([True] * len(columns[0]))
    for col, k in zip(columns, keys):
        if k is None:
            more, same = pc.is_valid(col), pc.is_null(col)
        else:
            more, same = (pc.fill_null(f(col, pa.scalar(k, col.type)), False) for f in (pc.greater, pc.equal))
        out, tied = pc.or_(out, pc.and_(tied, more)), pc.and_(tied, same)
    return out


# ── the formats ──────────────────────────────────────────────────────────────


class PagedStore(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_store"

    def schema(self):
        found = manifests(_folder(self.options))
        if not found:
            raise ValueError(f"nothing is committed at {_folder(self.options)}; give a schema to read it as empty")
        return T.StructType.fromJson(json.loads(found[-1]["schema"]))

    def reader(self, schema):
        return PagesReader(self.options)

    def writer(self, schema, overwrite):
        return PagesWriter(self.options, schema, overwrite)


class PagedFeed(PagedStore):
    @classmethod
    def name(cls) -> str:
        return "paged_feed"

    def streamReader(self, schema):
        return FeedReader(self.options)


def register(spark: SparkSession) -> None:
    """Make the formats known to a session, and let it push filters to them."""
    from ..session import ship_package

    ship_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PagedStore)
    spark.dataSource.register(PagedFeed)


def write_pages(df: DataFrame, path: str, keys: list[str], mode: str = "append", job_id: str | None = None, page_rows: int = PAGE_ROWS, ranges: int | None = None) -> None:
    """Write ``df`` clustered by its keys, so that pages hold narrow stretches of them and few meet a filter."""
    register(df.sparkSession)
    clustered = (df.repartitionByRange(ranges, *keys) if ranges else df.repartitionByRange(*keys)).sortWithinPartitions(*keys)
    w = clustered.write.format("paged_store").option("path", path).option("keys", ",".join(keys)).option("pageRows", str(page_rows))
    if job_id:
        w = w.option("jobId", job_id)
    w.mode(mode).save()


def read_pages(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    register(spark)
    r = spark.read.format("paged_store").option("path", path)
    return (r.schema(schema) if schema is not None else r).load()


def read_feed(spark: SparkSession, path: str, position_path: str | None = None, max_rows: int = 0, max_commits: int = 0) -> DataFrame:
    """A streaming DataFrame of the store's rows in the order of their commits and keys."""
    register(spark)
    r = spark.readStream.format("paged_feed").option("path", path)
    limits = {"maxRowsPerTrigger": max_rows, "maxCommitsPerTrigger": max_commits}
    for name, n in limits.items():
        if n:
            r = r.option(name, str(n))
    return (r.option("positionPath", position_path) if position_path else r).load()
