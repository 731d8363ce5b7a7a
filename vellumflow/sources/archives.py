"""Archives as Spark data sources: fixed-layout documents read page range by page range, conversions written and read as one archive each.

``register(spark)`` makes both known. Paths are opened by pyarrow's file systems (local, HDFS, S3, GCS), at the places that are needed only: a task
reads an archive's index and its own pages.
"""

from __future__ import annotations

import io
import json
import time
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow.fs
from pyspark.sql import Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.sql.types import StructType

from vellumflow.sources import xmldocs

LAST_PAGE = 2**31 - 1


def _system(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if "://" not in path and not path.startswith("/"):
        raise ValueError("paths of archives are absolute")
    return pyarrow.fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pyarrow.fs.LocalFileSystem(), path)


def _found(path: str, suffix: str) -> list[pyarrow.fs.FileInfo]:
    """The files of a folder (or the one file) that end in ``suffix``, by path."""
    system, at = _system(path)
    info = system.get_file_info(at)
    if info.type == pyarrow.fs.FileType.NotFound:
        raise FileNotFoundError(path)
    every = [info] if info.is_file else system.get_file_info(pyarrow.fs.FileSelector(at, recursive=True))
    return sorted((f for f in every if f.is_file and (f.path.lower().endswith(suffix) or info.is_file) and not f.base_name.startswith(("~$", "_", "."))), key=lambda f: f.path)


# ---------------------------------------------------------------- pages of fixed-layout archives


@dataclass
class Pages(InputPartition):
    """Whole files, or pages ``first`` to ``last`` of one."""

    files: list[str]
    first: int = 1
    last: int = LAST_PAGE

    def __post_init__(self):
        super().__init__(None)


@dataclass
class Wanted:
    """What the pushed filters leave of pages and paths."""

    first: int = 1
    last: int = LAST_PAGE
    pages: set[int] | None = None
    paths: set[str] | None = None
    null_page: bool = True

    def takes(self, page: int) -> bool:
        return self.first <= page <= self.last and (self.pages is None or page in self.pages)

    def push(self, f: Filter) -> bool:
        """Whether the filter is taken over."""
        name = f.attribute if hasattr(f, "attribute") else ()
        if name == ("page",) and isinstance(getattr(f, "value", None), int):
            if isinstance(f, EqualTo):
                self.first, self.last = max(self.first, f.value), min(self.last, f.value)
            elif isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.first = max(self.first, f.value + isinstance(f, GreaterThan))
            elif isinstance(f, (LessThan, LessThanOrEqual)):
                self.last = min(self.last, f.value - isinstance(f, LessThan))
            else:
                return False
            self.null_page = False
            return True
        if isinstance(f, In) and name == ("page",):
            self.null_page = False
            self.pages = set(f.value) if self.pages is None else self.pages & set(f.value)
            return True
        if name == ("path",) and isinstance(f, (EqualTo, In)):
            own = {f.value} if isinstance(f, EqualTo) else set(f.value)
            self.paths = own if self.paths is None else self.paths & own
            return True
        return False


class PageReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.per_task = options["path"], int(options.get("pagespertask", 16))
        self.large, self.bytes_per_task = int(options.get("largebytes", 8 << 20)), int(options.get("bytespertask", 64 << 20))
        self.wanted = Wanted()

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        return [f for f in filters if not self.wanted.push(f)]

    def partitions(self) -> list[InputPartition]:
        """Small files together up to ``bytesPerTask``; of files from ``largeBytes`` on the index is read here, and ranges of ``pagesPerTask`` pages
        that hold a wanted one are tasks."""
        out, held, size = [], [], 0
        for f in _found(self.path, ".ofd"):
            if self.wanted.paths is not None and f.path not in self.wanted.paths:
                continue
            if f.size >= self.large:
                try:
                    n = len(self._pages(f.path)[1])
                except Exception:  # the task that reads it says what is wrong
                    n = 1
                for first in range(1, n + 1, self.per_task):
                    last = min(first + self.per_task - 1, n)
                    if any(map(self.wanted.takes, range(first, last + 1))):
                        out.append(Pages([f.path], first, last))
                continue
            if held and size + f.size > self.bytes_per_task:
                out.append(Pages(held))
                held, size = [], 0
            held.append(f.path)
            size += f.size
        return out + ([Pages(held)] if held or not out else [])

    def _pages(self, path: str) -> tuple[xmldocs.Layout, list[str]]:
        system, _ = _system(self.path)
        layout = xmldocs.Layout(zipfile.ZipFile(system.open_input_file(path)))
        return layout, layout.pages

    def read(self, partition: Pages) -> Iterator[tuple]:
        for path in partition.files:
            try:
                layout, pages = self._pages(path)
            except Exception as e:  # an archive that cannot be opened is a row
                if not self.wanted.null_page:
                    continue
                yield path, None, None, None, None, None, None, None, None, f"{type(e).__name__}: {e}"[:300]
                continue
            for page in range(partition.first, min(partition.last, len(pages)) + 1):
                if not self.wanted.takes(page):
                    continue
                try:
                    found = layout.texts(page)
                except Exception as e:  # as is a page
                    yield path, page, None, None, None, None, None, None, None, f"{type(e).__name__}: {e}"[:300]
                    continue
                for n, x in enumerate(found):
                    yield path, page, n, x["text"], x["l"], x["t"], x["r"], x["b"], x["size"], None


class FixedLayoutPages(DataSource):
    """spark.read.format('fixed_layout_pages').load(file or folder): (path, page, n, text, l, t, r, b, size, error) of the text objects of every page."""

    @classmethod
    def name(cls) -> str:
        return "fixed_layout_pages"

    def schema(self) -> str:
        return "path string, page int, n int, text string, l double, t double, r double, b double, size double, error string"

    def reader(self, schema: StructType) -> PageReader:
        return PageReader({k.lower(): v for k, v in self.options.items()})


# ---------------------------------------------------------------- one archive for each conversion

#: Members of an archive, each a JSON file, and what stands for one that is missing.
MEMBERS = {"version": None, "status": None, "errors": [], "pages": [], "timings": {}, "confidence": {}, "document": None}
ARCHIVE = "doc_id string, " + ", ".join(f"{m} string" for m in MEMBERS)


@dataclass
class Written(WriterCommitMessage):
    """(temporary file, its place) of what a task wrote."""

    files: list[tuple[str, str]] = field(default_factory=list)


class ArchiveWriter(DataSourceWriter):
    """Tasks write to a folder of the job's own, which is there before they begin; commit() moves the files of the tasks that count to their
    places, abort() takes the folder away, and a task that goes on after that finds it gone and fails."""

    def __init__(self, path: str, schema: StructType, overwrite: bool):
        self.path, self.names, self.overwrite, self.job = path.rstrip("/"), schema.names, overwrite, uuid.uuid4().hex
        if "doc_id" not in self.names or not set(self.names) <= {"doc_id", *MEMBERS}:
            raise ValueError(f"columns are doc_id and some of {', '.join(MEMBERS)}")
        system, _, temporary = self._temporary()
        system.create_dir(temporary, recursive=True)

    def _temporary(self) -> tuple[pyarrow.fs.FileSystem, str, str]:
        system, at = _system(self.path)
        return system, at, f"{at}/_temporary-{self.job}"

    def write(self, iterator: Iterator[Row]) -> Written:
        system, at, temporary = self._temporary()
        folder, done = f"{temporary}/{uuid.uuid4().hex}", Written()
        system.create_dir(folder, recursive=False)
        for n, row in enumerate(iterator):
            values = dict(zip(self.names, row))
            name = str(values.pop("doc_id"))
            if not name or "/" in name or name in ("None", ".", ".."):
                raise ValueError(f"no file can be named {name!r}")
            raw = io.BytesIO()
            with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as z:
                for member, value in values.items():
                    if value is not None:
                        z.writestr(zipfile.ZipInfo(f"{member}.json"), value)
            with system.open_output_stream(f"{folder}/{n}.zip") as out:
                out.write(raw.getvalue())
            done.files.append((f"{folder}/{n}.zip", f"{at}/{name}.zip"))
        return done

    def commit(self, messages: list[Written | None]) -> None:
        system, at, temporary = self._temporary()
        places = [place for m in messages if m for _, place in m.files]
        if len(set(places)) < len(places):
            self.abort(messages)
            raise ValueError("two rows have one doc_id")
        before = [f.path for f in _found(self.path, ".zip") if "/_temporary-" not in f.path] if self.overwrite else []
        for m in messages:
            for file, place in m.files if m else ():
                system.move(file, place)
        for path in set(before) - set(places):
            system.delete_file(path)
        system.delete_dir(temporary)

    def abort(self, messages: list[Written | None]) -> None:
        system, _, temporary = self._temporary()
        for _ in range(20):  # a task may put a file in while this goes through the folder
            if system.get_file_info(temporary).type == pyarrow.fs.FileType.NotFound:
                return
            try:
                system.delete_dir(temporary)
            except OSError:
                time.sleep(0.1)


class ArchiveReader(DataSourceReader):
    def __init__(self, path: str, per_task: int):
        self.path, self.per_task = path, per_task

    def partitions(self) -> list[InputPartition]:
        files = [f.path for f in _found(self.path, ".zip") if "/_temporary-" not in f.path]
        return [Pages(files[k : k + self.per_task]) for k in range(0, max(1, len(files)), self.per_task)]

    def read(self, partition: Pages) -> Iterator[tuple]:
        """Members that are missing, or are no JSON, come as what stands for them."""
        system, _ = _system(self.path)
        for path in partition.files:
            name = path.rsplit("/", 1)[-1].removesuffix(".zip")
            got = {}
            try:
                with zipfile.ZipFile(system.open_input_file(path)) as z:
                    for member in MEMBERS:
                        try:
                            got[member] = z.read(f"{member}.json").decode()
                            json.loads(got[member])
                        except (KeyError, ValueError):
                            got.pop(member, None)
            except (zipfile.BadZipFile, ValueError):  # pyarrow's files say the latter of a place outside
                got = {"errors": json.dumps(["not an archive"])}
            yield (name, *(got.get(m, None if v is None else json.dumps(v)) for m, v in MEMBERS.items()))


class ConversionArchives(DataSource):
    """df.write.format('conversion_archives').save(folder) writes one archive for each row (doc_id and JSON members); load(folder) reads them."""

    @classmethod
    def name(cls) -> str:
        return "conversion_archives"

    def schema(self) -> str:
        return ARCHIVE

    def reader(self, schema: StructType) -> ArchiveReader:
        return ArchiveReader(self.options["path"], int(self.options.get("filesPerTask", 1000)))

    def writer(self, schema: StructType, overwrite: bool) -> ArchiveWriter:
        return ArchiveWriter(self.options["path"], schema, overwrite)


def register(spark: SparkSession) -> None:
    """Makes the formats 'fixed_layout_pages' and 'conversion_archives' known, and lets filters reach the first."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FixedLayoutPages)
    spark.dataSource.register(ConversionArchives)
