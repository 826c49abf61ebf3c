"""Funnel stages per user, kept in a bucketed table that new events are merged into.

What a funnel report needs of a user are flags and earliest dates.  Both merge: the
state after another day is the larger flag and the smaller date of the state before
and of that day's events.  So a day costs one shuffle of that day's users and a
rewrite of the state, and never a pass over the event log; merging a day twice changes
nothing.

Users and state are stored in the same number of buckets by ``user_id``.  Reports over
both join bucket by bucket, without an exchange of either.

A merge writes a new version and then commits it (see ``plans.ledger``), so a report
that runs meanwhile, or a merge that fails, leaves the version before in place.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohortry.operators.funnel import STAGES, UserStages, user_stages
from cohortry.plans.ledger import Ledger

# Buckets of a new table; as many as a stage of the cluster has tasks.
BUCKETS = 200
KEY = "user_id"


class UserState:
    """The funnel state and the users below ``path``, in ``buckets`` buckets each.

    The number of buckets is settled by the first version; later calls keep it.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self._spark, self._path = spark, path.rstrip("/")
        self._logs = {kind: Ledger(spark, f"{self._path}/log/{kind}") for kind in ("users", "stages")}
        known = [found[1]["buckets"] for log in self._logs.values() if (found := log.latest())]
        self.buckets = known[0] if known else buckets

    def _save(self, kind: str, frame: DataFrame, after: int) -> None:
        """Write a version and commit it as the one after ``after``."""
        name = uuid.uuid4().hex
        where = f"{self._path}/{kind}/{name}"
        # The table's entry in the session's catalog goes again; its files stay.
        table = f"{kind}_{name}"
        writer = frame.write.format("parquet").bucketBy(self.buckets, KEY).sortBy(KEY)
        try:
            writer.option("path", where).saveAsTable(table)
        finally:
            self._spark.sql(f"DROP TABLE IF EXISTS {table}")
        entry = {"folder": f"{kind}/{name}", "buckets": self.buckets, "schema": frame.schema.json()}
        if not self._logs[kind].commit(after + 1, entry):
            raise RuntimeError(f"another writer has changed the {kind} meanwhile; merge again")

    def _read(self, kind: str) -> tuple[int, DataFrame] | None:
        """The newest version, as a table that Spark knows the buckets of."""
        found = self._logs[kind].latest()
        if found is None:
            return None
        number, entry = found
        table = entry["folder"].replace("/", "_")
        if not self._spark.catalog.tableExists(table):
            schema = StructType.fromJson(json.loads(entry["schema"]))
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            self._spark.sql(
                f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({KEY}) SORTED BY ({KEY})"
                f" INTO {entry['buckets']} BUCKETS LOCATION '{self._path}/{entry['folder']}'"
            )
        return number, self._spark.table(table)

    def set_users(self, users: DataFrame) -> None:
        """Store the users, one row per ``user_id``."""
        found = self._logs["users"].latest()
        self._save("users", users.repartition(self.buckets, KEY), found[0] if found else 0)

    def users(self) -> DataFrame:
        found = self._read("users")
        if found is None:
            raise LookupError(f"no users are stored at {self._path}")
        return found[1]

    def merge(self, events: DataFrame) -> None:
        """Bring further events into the state: any events, also ones merged before."""
        new = user_stages(events)
        found = self._read("stages")
        if found is None:
            self._save("stages", new.repartition(self.buckets, KEY), 0)
            return
        number, old = found
        both = old.alias("o").join(new.alias("n"), F.col(f"o.{KEY}") == F.col(f"n.{KEY}"), "full")
        merged = both.select(
            F.coalesce(f"o.{KEY}", f"n.{KEY}").alias(KEY),
            *[F.greatest(f"o.did_{s}", f"n.did_{s}").alias(f"did_{s}") for s in STAGES],
            *[F.least(f"o.{s}_date", f"n.{s}_date").alias(f"{s}_date") for s in STAGES],
        )
        self._save("stages", merged, number)

    def stages(self) -> UserStages:
        """The state, for the reports of ``operators.funnel``."""
        found = self._read("stages")
        if found is None:
            raise LookupError(f"no events were merged at {self._path}")
        return UserStages(found[1])

    def retire(self, keep: int = 2) -> int:
        """Remove all but the newest ``keep`` versions; returns how many went."""
        if keep < 1:
            raise ValueError("the current version cannot be retired")
        removed = 0
        for log in self._logs.values():
            for number in log.numbers()[:-keep]:
                folder = log.read(number)["folder"]
                log.remove(number)
                self._spark.sql(f"DROP TABLE IF EXISTS {folder.replace('/', '_')}")
                log.remove_folder(f"{self._path}/{folder}")
                removed += 1
        return removed
