"""The tables at rest: versions, actions, run ledger.

``versions`` are immutable Parquet folders, one per load, split by state, price
month and a bucket of the symbol.  ``commits`` holds one small file per source
and commit, naming the folders it puts in force; a commit is the creation of
that file, which fails if another writer of the source was faster, so of two
loads of one source the second one is refused and loads of different sources do
not meet.  A load rewrites the active slots it changes and appends the versions
it closed; everything else is referenced, not copied.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterable
from datetime import datetime, timedelta, timezone
from hashlib import md5
from re import sub
from urllib.parse import urlparse
from uuid import uuid4
from zlib import crc32

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitbars.operators import asof, checks, ledger
from pitbars.operators.adjust import adjust_close, in_scope
from pitbars.operators.normalize import instant_literal
from pitbars.schemas import ACTION, KEYS, RUN, VERSION, VERSION_COLUMNS

COMMIT = (
    "commit_id long, committed_at timestamp, source_name string, state string, price_month int, bucket int, "
    "folder string, replaces boolean, rows long, since timestamp, until timestamp"
)
EVENT = T.StructType([*RUN.fields, T.StructField("event_seq", T.LongType(), False)])
SLOT = ("price_month", "bucket")
# Buckets of the symbols of a month; a corrected bar rewrites one of them.
BUCKETS = 4


class ConflictError(RuntimeError):
    """Another writer of the source committed since this one looked."""


def price_month() -> F.Column:
    """Partition value of a bar, e.g. 202604."""
    return (F.year("price_ts") * 100 + F.month("price_ts")).cast("int")


def bucket() -> F.Column:
    return (F.crc32(F.col("symbol").cast("binary")) % BUCKETS).cast("int")


def bucket_of(symbol: str) -> int:
    return crc32(symbol.encode()) % BUCKETS


def source_key(source: str) -> str:
    """Folder name of a source."""
    return sub(r"[^A-Za-z0-9_]", "_", source) + "-" + md5(source.encode()).hexdigest()[:8]


class Store:
    """Opens the tables under *root*, creating empty ones the first time."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        for folder in ("commits", "ledger", "actions"):
            self._fs().mkdirs(self._path(folder))

    # -- files ------------------------------------------------------------

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _fs(self):
        return self._path("").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _create_once(self, name: str, text: str) -> bool:
        """Create a file with its whole content unless it exists; readers never see a part of it."""
        fs, folder = self._fs(), name.rpartition("/")[0]
        fs.mkdirs(self._path(folder))
        attempt = f"{folder}/_{uuid4().hex}"
        out = fs.create(self._path(attempt))
        out.write(bytearray(text.encode()))
        out.close()
        try:
            if fs.getScheme() != "file":
                return fs.rename(self._path(attempt), self._path(name))
            # A local rename would replace the file; a link does not.
            base = urlparse(self.root).path
            os.link(f"{base}/{attempt}", f"{base}/{name}")
            return True
        except FileExistsError:
            return False
        finally:
            fs.delete(self._path(attempt), False)

    def remove(self, folder: str) -> None:
        """Delete a folder given by its full path."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def work_folder(self, run_id: str) -> str:
        """Shared folder for intermediate tables: the cluster's checkpoint folder, else the store."""
        shared = self.spark.conf.get("spark.checkpoint.dir", None)
        return f"{(shared or self.root + '/work').rstrip('/')}/pitbars-{run_id}"

    # -- versions ---------------------------------------------------------

    def commits(self) -> DataFrame:
        """Metadata: one row per commit, state, month and bucket."""
        return self.spark.read.schema(COMMIT).option("recursiveFileLookup", True).json(f"{self.root}/commits")

    def head(self, source: str) -> int:
        own = self.commits().where(F.col("source_name") == source)
        return own.agg(F.coalesce(F.max("commit_id"), F.lit(0)).alias("id")).first()["id"]

    def in_force(
        self,
        source: str | None = None,
        state: str | None = None,
        months: Iterable[int] | None = None,
        as_of: datetime | None = None,
    ) -> DataFrame:
        """Commit rows whose folders hold the table now; *as_of* leaves out folders by their knowledge times."""
        rows = self.commits()
        if source is not None:
            rows = rows.where(F.col("source_name") == source)
        emptied = rows.where("state IS NULL").groupBy("source_name").agg(F.max("commit_id").alias("emptied_at"))
        rows = rows.where("state IS NOT NULL").join(emptied, "source_name", "left").where("commit_id > coalesce(emptied_at, 0)")
        if state is not None:
            rows = rows.where(F.col("state") == state)
        if months is not None:
            rows = rows.where(F.col("price_month").isin(*months))
        slot = ("source_name", "state", *SLOT)
        since = rows.where("replaces").groupBy(*slot).agg(F.max("commit_id").alias("replaced_at"))
        live = rows.join(since, list(slot), "left").where("commit_id >= coalesce(replaced_at, 0)")
        if as_of is not None:
            moment = instant_literal(as_of)
            live = live.where((F.col("since") <= moment) & (F.col("until").isNull() | (F.col("until") > moment)))
        return live

    def folders(self, *where, **also) -> list[str]:
        return sorted(row["folder"] for row in self.in_force(*where, **also).select("folder").distinct().collect())

    def versions(
        self, source: str | None = None, state: str | None = None, months: Iterable[int] | None = None
    ) -> DataFrame:
        """The versions table as last committed."""
        return self.read(self.folders(source, state, months)).select(*VERSION_COLUMNS)

    def current(self, source: str | None = None, months: Iterable[int] | None = None) -> DataFrame:
        """Active versions; closed folders are not even listed."""
        return self.versions(source, "active", months)

    def snapshot_as_of(self, as_of: datetime, source: str | None = None) -> DataFrame:
        """The table as believed at a moment; folders whose knowledge times rule them out stay closed."""
        return asof.snapshot_as_of(self.read(self.folders(source, as_of=as_of)), as_of)

    def price_as_of(self, source: str, symbol: str, price_ts: datetime, as_of: datetime) -> DataFrame:
        """Point lookup that opens only the folders of the bar's source, month and bucket."""
        utc = price_ts.astimezone(timezone.utc) if price_ts.tzinfo else price_ts
        near = self.in_force(source, months=[utc.year * 100 + utc.month], as_of=as_of)
        near = near.where(F.col("bucket") == bucket_of(symbol.upper()))
        held = self.read([row["folder"] for row in near.select("folder").distinct().collect()])
        return asof.price_as_of(held, source, symbol, price_ts, as_of)

    def read(self, folders: list[str]) -> DataFrame:
        """Version folders as one table, with their state, price month and bucket."""
        slot = [T.StructField("state", T.StringType()), *[T.StructField(name, T.IntegerType()) for name in SLOT]]
        schema = T.StructType([*VERSION.fields, *slot])
        if not folders:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.root}/{folder}" for folder in folders]
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/versions").parquet(*paths)

    def write_versions(self, rows: DataFrame, source: str, load_id: str, watch: tuple | None = None) -> str:
        """Write versions to a fresh folder that no reader sees yet.

        Rows are rebalanced by slot, so a slot is a few files however many tasks
        there are.  Sorting by key lets Parquet statistics skip pages on lookups.
        *watch* (an observation and its metrics) is taken in the writing stage,
        whose tasks count once each even when an executor is lost.
        """
        folder = f"versions/feed={source_key(source)}/load={load_id}"
        state = F.when(F.col("valid_to").isNull(), "active").otherwise("closed")
        placed = rows.select(*rows.columns, state.alias("state"), price_month().alias("price_month"), bucket().alias("bucket"))
        ordered = placed.hint("rebalance", "state", *SLOT).sortWithinPartitions("state", *SLOT, *KEYS)
        if watch is not None:
            ordered = ordered.observe(*watch)
        ordered.select(*VERSION_COLUMNS, "state", *SLOT).write.partitionBy("state", *SLOT).parquet(f"{self.root}/{folder}")
        return folder

    def written(self, folder: str) -> DataFrame:
        """Read back a folder before it is committed."""
        return self.read([folder])

    def commit(self, folder: str, source: str, head: int, replace: Iterable[str] = ("active",)) -> int:
        """Put a written folder in force; *replace* names the states it supersedes slot by slot."""
        slots = self.written(folder).groupBy("state", *SLOT).agg(
            F.count("*").alias("rows"), F.date_format(F.min("valid_from"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("since"),
            F.date_format(F.when(F.count("*") == F.count("valid_to"), F.max("valid_to")), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("until"),
        ).collect()
        replaced = set(replace)
        rows = [
            {**s.asDict(), "folder": f"{folder}/state={s['state']}/price_month={s['price_month']}/bucket={s['bucket']}",
             "replaces": s["state"] in replaced}
            for s in slots
        ]
        return self._commit(source, head, rows) if rows else head

    def _commit(self, source: str, head: int, rows: list[dict]) -> int:
        at = datetime.now(timezone.utc).isoformat()
        lines = [json.dumps({"commit_id": head + 1, "committed_at": at, "source_name": source, **row}) for row in rows]
        if self.head(source) != head or not self._create_once(f"commits/{source_key(source)}/{head + 1:012d}.json", "\n".join(lines)):
            raise ConflictError(f"another load of {source!r} committed after {head}")
        return head + 1

    def clear(self) -> None:
        """Commit empty versions of every source and forget all runs."""
        for row in self.commits().groupBy("source_name").agg(F.max("commit_id").alias("head")).collect():
            self._commit(row["source_name"], row["head"], [{"state": None, "replaces": True}])
        for day in self._days():
            self.remove(f"{self.root}/ledger/{day}")

    def compact_closed(self, source: str) -> int:
        """Rewrite the closed versions of a source as one folder per slot; returns the folders that went."""
        head, before = self.head(source), self.folders(source, "closed")
        if len(before) < 2:
            return 0
        folder = self.write_versions(self.read(before).select(*VERSION_COLUMNS), source, uuid4().hex)
        self.commit(folder, source, head, replace=("closed",))
        return len(before)

    # -- corporate actions ------------------------------------------------

    def actions(self) -> DataFrame:
        return self.spark.read.schema(ACTION).parquet(f"{self.root}/actions")

    def add_actions(self, actions: DataFrame) -> None:
        """Append actions after checking them together with those already held."""
        fresh = actions.select(*[F.col(f.name).cast(f.dataType) for f in ACTION.fields])
        checks.demand_actions(self.actions().unionByName(fresh))
        fresh.write.mode("append").parquet(f"{self.root}/actions")

    def recompute_adjusted_close(
        self, source: str, symbol: str | None = None, recorded_at: datetime | None = None, zone: str = "UTC"
    ) -> int:
        """Adjusted close of every version in scope, closed ones too; returns the rows touched.

        Only the slots that hold the symbol are rewritten, and their checks are
        taken while they are written.
        """
        head = self.head(source)
        moment = recorded_at or datetime.now(timezone.utc)
        live = self.in_force(source)
        if symbol is not None:
            live = live.where(F.col("bucket") == bucket_of(symbol.upper()))
        held = self.read(sorted(row["folder"] for row in live.select("folder").distinct().collect()))
        touched = in_scope(held, source, symbol).groupBy(*SLOT).agg(F.count("*").alias("n")).collect()
        if not touched:
            return 0
        months = sorted({row["price_month"] for row in touched})
        rows = held.where(F.col("price_month").isin(*months)).select(*VERSION_COLUMNS)
        fresh = adjust_close(rows, self.actions(), source, symbol, moment, zone)
        if symbol is not None:
            fresh = fresh.unionByName(rows.where(F.col("symbol") != F.upper(F.lit(symbol))))
        seen = Observation()
        watch = (seen, *checks.violation_columns(self._adjusted_rules()))
        folder = self.write_versions(fresh, source, uuid4().hex, watch)
        checks.demand(seen.get)
        self.commit(folder, source, head, replace=("active", "closed"))
        return sum(row["n"] for row in touched)

    @staticmethod
    def _adjusted_rules() -> dict:
        """A recomputed value is never NULL: NULL means it left the working precision."""
        return {**checks.version_rules(), "adjusted_close_range": F.col("adjusted_close").isNull()}

    # -- run ledger -------------------------------------------------------

    # Events lie under the day on which their run was recorded, so retention touches past days only and
    # never what a running load appends.

    def _days(self) -> list[str]:
        """Folders of the ledger, one a day."""
        found = self._fs().listStatus(self._path("ledger"))
        return sorted(name for name in (f.getPath().getName() for f in found) if name.startswith("day="))

    def _events(self) -> DataFrame:
        if not self._days():
            return self.spark.createDataFrame([], EVENT)
        layout = T.StructType([*EVENT.fields, T.StructField("day", T.StringType())])
        return self.spark.read.schema(layout).parquet(f"{self.root}/ledger")

    def _append(self, events: DataFrame, mode: str = "append") -> None:
        dated = events.withColumn("day", F.to_date("created_at").cast("string"))
        dated.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(f"{self.root}/ledger")

    def runs(self) -> DataFrame:
        """One row per run that retention has kept, in its latest state."""
        return ledger.state(self._events().select(*EVENT.fieldNames()))

    def run(self, run_id: str) -> dict:
        """One ledger row; a missing run is an error."""
        row = ledger.lookup(self.runs(), run_id).first()
        if row is None:
            raise LookupError(f"no ledger row for run {run_id}")
        return row.asDict()

    def log(self, event: dict, seq: int) -> None:
        """Append one event of a run; the highest *seq* of a run is its state.

        The ledger's constraints hold here: known states, and a run starts once.
        """
        checks.demand_run(event)
        if seq == 0 and not self._events().where(F.col("run_id") == event["run_id"]).isEmpty():
            raise checks.ConstraintError({"unique_run": 1})
        row = tuple({**event, "event_seq": seq}.get(name) for name in EVENT.fieldNames())
        rows = self.spark.createDataFrame([row], EVENT).coalesce(1)
        self._append(rows)

    def prune_runs(self, days: int, now: datetime | None = None) -> int:
        """Delete runs recorded before the retention cutoff, by the clock of the store; returns how many.

        Days before the cutoff's are dropped as a whole, the cutoff's own is written anew without the
        runs that are too old. Both lie at least a day back, so no event of a younger run is touched.
        """
        moment = now or datetime.now(timezone.utc)
        cutoff = ledger.retention_cutoff(moment, days)
        last = (moment - timedelta(days=days)).astimezone(timezone.utc).strftime("day=%Y-%m-%d")
        past = [day for day in self._days() if day <= last]
        if not past:
            return 0
        events = self._events().where(F.col("day") <= last.removeprefix("day="))
        counted = events.groupBy("day").agg(F.count_distinct(F.when(F.col("created_at") < cutoff, F.col("run_id"))).alias("gone"), F.count_if(F.col("created_at") >= cutoff).alias("kept"))
        gone = 0
        for row in counted.collect():  # a row per day
            gone += row["gone"]
            if row["gone"] and row["kept"]:
                self._append(events.where((F.col("day") == row["day"]) & (F.col("created_at") >= cutoff)).select(*EVENT.fieldNames()).coalesce(1), "overwrite")
            elif row["gone"]:
                self.remove(f"{self.root}/ledger/day={row['day']}")
        return gone

    def reconciliation(self, run_id: str) -> DataFrame:
        """Per-symbol reconciliation of one run."""
        return self.spark.read.parquet(f"{self.root}/reconciliation/run_id={run_id}")
