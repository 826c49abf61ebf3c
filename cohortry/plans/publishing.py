"""Published views that outlive the session and can be replaced while being read.

A publication is a folder:

    versions/<id>/<view>    parquet files of one version, never changed again
    log/<number>            a small file: which folder is version ``number``

Publishing writes all views of a version to a new folder and then commits the log
entry.  Readers resolve the entry when they open a view and keep reading that
version's files, whatever is published later.  A publish that fails leaves no entry,
so readers go on with the version before.  All views of a version become visible by
one entry: nobody sees a revenue view of today beside an RFM view of yesterday.

Old versions stay until ``retire`` removes them.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohortry.plans.ledger import Ledger

# Times a commit is tried again after another publisher took the number.
_TRIES = 20
# A folder without a log entry may belong to a publish that still runs.
UNCOMMITTED_SECONDS = 24 * 3600


@dataclass(frozen=True)
class Version:
    """A committed version: its number, folder, and per view the rows and schema."""

    number: int
    folder: str
    rows: Mapping[str, int]
    schemas: Mapping[str, StructType]
    published_ms: int


def _log(spark: SparkSession, path: str) -> Ledger:
    return Ledger(spark, f"{path.rstrip('/')}/log")


def _version(number: int, entry: dict) -> Version:
    return Version(
        number, entry["folder"], entry["rows"],
        {name: StructType.fromJson(json.loads(text)) for name, text in entry["schemas"].items()},
        entry["published_ms"],
    )


def versions(spark: SparkSession, path: str) -> list[Version]:
    """All committed versions, oldest first."""
    log = _log(spark, path)
    return [_version(number, log.read(number)) for number in log.numbers()]


def current_version(spark: SparkSession, path: str) -> Version:
    found = _log(spark, path).latest()
    if found is None:
        raise LookupError(f"nothing is published at {path}")
    return _version(*found)


def _commit(log: Ledger, entry: dict) -> Version:
    """Commit under the next free number; the last committed version wins."""
    for _ in range(_TRIES):
        numbers = log.numbers()
        number = (numbers[-1] if numbers else 0) + 1
        if log.commit(number, entry):
            return _version(number, entry)
    raise RuntimeError("other publishers took every number that was tried")


def publish(
    views: Mapping[str, DataFrame], path: str, partition_by: str | Sequence[str] | None = None
) -> Version:
    """Publish the views as one new version.

    Each view is written once and its rows are counted on the way.  ``partition_by``
    holds for every view.
    """
    folder = f"versions/{uuid.uuid4().hex}"
    rows, schemas, log = {}, {}, None
    for name, view in views.items():
        log = log or _log(view.sparkSession, path)
        counted = Observation()
        writer = view.observe(counted, F.count(F.lit(1)).alias("rows")).write
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(f"{path.rstrip('/')}/{folder}/{name}")
        rows[name] = counted.get["rows"]
        schemas[name] = view.schema.json()
    if log is None:
        raise ValueError("there is no view to publish")
    return _commit(
        log,
        {"folder": folder, "rows": rows, "schemas": schemas, "published_ms": time.time_ns() // 1_000_000},
    )


def read_published(
    spark: SparkSession, path: str, name: str, number: int | None = None
) -> DataFrame:
    """A view as of the current version, or of version ``number``.

    The version is settled now: later publishes do not change what is read.
    """
    version = (
        current_version(spark, path)
        if number is None
        else _version(number, _log(spark, path).read(number))
    )
    return _open(spark, path, version, name)


def _open(spark: SparkSession, path: str, version: Version, name: str) -> DataFrame:
    if name not in version.schemas:
        raise LookupError(f"version {version.number} at {path} has no view {name}")
    where = f"{path.rstrip('/')}/{version.folder}/{name}"
    names = version.schemas[name].fieldNames()
    return spark.read.schema(version.schemas[name]).parquet(where).select(*[f"`{n}`" for n in names])


def attach(spark: SparkSession, path: str, number: int | None = None) -> list[str]:
    """Register every view of one version for Spark SQL in this session.

    All names come from the same version.  Attach again to see a newer one.
    """
    version = (
        current_version(spark, path)
        if number is None
        else _version(number, _log(spark, path).read(number))
    )
    for name in version.schemas:
        _open(spark, path, version, name).createOrReplaceTempView(name)
    return list(version.schemas)


def restore(spark: SparkSession, path: str, number: int) -> Version:
    """Make an older version current again, as a new number over the same files."""
    log = _log(spark, path)
    return _commit(log, {**log.read(number), "published_ms": time.time_ns() // 1_000_000})


def retire(
    spark: SparkSession, path: str, keep: int = 2, uncommitted_seconds: int = UNCOMMITTED_SECONDS
) -> list[int]:
    """Forget all but the newest ``keep`` versions; returns the forgotten numbers.

    Folders that no remaining version names go, too, but those that never had an
    entry only once they have not changed for ``uncommitted_seconds``.  Keep enough
    versions for the longest report that may still read one.
    """
    if keep < 1:
        raise ValueError("the current version cannot be retired")
    log = _log(spark, path)
    entries = {number: log.read(number)["folder"] for number in log.numbers()}
    old = sorted(entries)[:-keep]
    kept = {entries[number] for number in entries if number not in old}
    for number in old:
        log.remove(number)
    known = set(entries.values())
    since = time.time() * 1000 - uncommitted_seconds * 1000
    base = path.rstrip("/")
    for name, changed in log.folders(f"{base}/versions").items():
        folder = f"versions/{name}"
        if folder not in kept and (folder in known or changed < since):
            log.remove_folder(f"{base}/{folder}")
    return old


def publish_built(
    views: Mapping[str, Callable[..., DataFrame]], tables, path: str
) -> Version:
    """Build every view of a business area over its tables and publish them together."""
    return publish({name: build(tables) for name, build in views.items()}, path)
