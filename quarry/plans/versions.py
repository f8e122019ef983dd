"""Published versions of a warehouse, with optimistic commits.

A load writes its tables to a folder of its own, which nobody reads. Committing
writes ``_versions/<n>.json`` under a number that must still be free: of several
loads that started from version n - 1 one gets the number, the others have to load
again on top of it. Readers open the highest number and see all of a load or
nothing.

The commit needs a store that creates a name only if it's free: a hard link on a
local or mounted folder, a rename elsewhere (HDFS refuses to rename onto a file).

:func:`vacuum` removes folders that no kept version refers to.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

VERSIONS = "version long, location string, published_at timestamp, skipped_rows long"
_NAME = re.compile(r"(\d{8})\.json")


class ConcurrentCommit(Exception):
    """Another load kept taking the next version number."""


@dataclass(frozen=True)
class Version:
    version: int
    location: str
    published_at: str
    skipped_rows: int
    #: Where the rows of each dimension lie (see ``operators.dimension_store``).
    dimensions: dict[str, dict] = field(default_factory=dict)

    def folders(self) -> set[str]:
        """All folders that a reader of this version opens."""
        return {self.location, *(p for d in self.dimensions.values() for p in d["paths"].values())}


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _names(spark: SparkSession, folder: str) -> list[tuple[str, float]]:
    """(name, time of the last change) of what lies in ``folder``."""
    fs, path = _path(spark, folder)
    if not fs.exists(path):
        return []
    return [(f.getPath().getName(), f.getModificationTime() / 1000) for f in fs.listStatus(path)]


def _numbers(spark: SparkSession, warehouse: str) -> list[int]:
    return sorted(int(m[1]) for name, _ in _names(spark, f"{warehouse}/_versions") if (m := _NAME.fullmatch(name)))


def read_version(spark: SparkSession, warehouse: str, number: int) -> Version:
    text = spark.read.text(f"{warehouse}/_versions/{number:08d}.json", wholetext=True).first()[0]
    return Version(**json.loads(text))


def latest(spark: SparkSession, warehouse: str) -> Version | None:
    numbers = _numbers(spark, warehouse)
    return read_version(spark, warehouse, numbers[-1]) if numbers else None


def published(spark: SparkSession, warehouse: str) -> DataFrame:
    """All published versions (an empty warehouse has none)."""
    if not _numbers(spark, warehouse):
        return spark.createDataFrame([], VERSIONS)
    return spark.read.schema(VERSIONS).json(f"{warehouse}/_versions/*.json")


def _claim(spark: SparkSession, fs, written, name) -> bool:
    """Give the file ``written`` the free ``name``; False if it's taken."""
    try:
        if fs.getScheme() == "file":  # a rename replaces files here, a link doesn't
            files, file = spark._jvm.java.nio.file.Files, spark._jvm.java.io.File
            files.createLink(file(name.toUri().getPath()).toPath(), file(written.toUri().getPath()).toPath())
            return True
        return not fs.exists(name) and fs.rename(written, name)
    except Py4JJavaError as e:
        if e.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    finally:
        fs.delete(written, False)


def commit(spark: SparkSession, warehouse: str, number: int, location: str, skipped_rows: int,
           dimensions: dict[str, dict] | None = None) -> bool:
    """Publish ``location`` as version ``number``; False if another load has that number."""
    entry = Version(number, location, datetime.now(timezone.utc).isoformat(), skipped_rows, dimensions or {})
    folder = f"{warehouse}/_versions"
    fs, written = _path(spark, f"{folder}/.{uuid.uuid4().hex}.json")
    fs.mkdirs(_path(spark, folder)[1])
    out = fs.create(written, True)
    out.write(bytearray(json.dumps(asdict(entry)).encode()))
    out.close()
    return _claim(spark, fs, written, _path(spark, f"{folder}/{number:08d}.json")[1])


def new_location(warehouse: str, number: int) -> str:
    """A folder for a load that hopes to become version ``number``."""
    return f"{warehouse}/v{number:06d}-{uuid.uuid4().hex[:12]}"


def drop(spark: SparkSession, location: str) -> None:
    fs, path = _path(spark, location)
    fs.delete(path, True)


def vacuum(spark: SparkSession, warehouse: str, keep: int, older_than_seconds: float = 24 * 3600) -> list[str]:
    """Remove load folders that none of the last ``keep`` versions opens; their names.

    Folders changed within ``older_than_seconds`` stay: they may belong to loads that are
    still running. Entries of older versions go as well; a version that is kept stays whole.
    """
    if keep < 1:
        raise ValueError("the current version must be kept")
    numbers = _numbers(spark, warehouse)
    used = {p for n in numbers[-keep:] for p in read_version(spark, warehouse, n).folders()}
    mine = re.compile(r"v\d{6}-[0-9a-f]{12}")
    gone = []
    for name, changed in _names(spark, warehouse):
        folder = f"{warehouse}/{name}"
        if not mine.fullmatch(name) or time.time() - changed < older_than_seconds:
            continue
        inside = {p for p in used if p == folder or p.startswith(folder + "/")}
        if not inside:
            drop(spark, folder)
            gone.append(name)
        elif folder not in used:  # an older version's folder whose dimension files are still in use
            gone += _drop_unused(spark, folder, inside)
    for n in numbers[:-keep]:
        drop(spark, f"{warehouse}/_versions/{n:08d}.json")
    return sorted(gone)


def _drop_unused(spark: SparkSession, folder: str, used: set[str]) -> list[str]:
    """Tables of ``folder``, or buckets of its tables, that aren't in ``used``."""
    gone = []
    for table, _ in _names(spark, folder):
        path = f"{folder}/{table}"
        if not any(p.startswith(path + "/") for p in used):
            drop(spark, path)
            gone.append(path)
            continue
        for bucket, _ in _names(spark, path):
            if bucket.startswith("bucket=") and f"{path}/{bucket}" not in used:
                drop(spark, f"{path}/{bucket}")
                gone.append(f"{path}/{bucket}")
    return gone

