"""Lake tables: definitions, reads, streaming appends, sealed days and gold overwrites.

A bronze, silver or gold table is a folder of commits, each a folder of files that is written once and never changed,
and a manifest (``commits.Manifest``) of those that belong to it. The manifest decides. The catalog is told what it says: a
table of partitions that point at the commits' folders, and a view of the table's name over it. Appends add
partitions; whatever takes folders out (overwriting, sealing) registers a new table and moves the view, one catalog call.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemart.functions.measures import since
from tidemart.operators.bronze import route
from tidemart.schemas import RAW_EVENTS, RUN_LOG, SILVER_EVENT, column_ddl, silver_schema
from tidemart.sources.commits import Manifest, Part, State
from tidemart.sources.files import Store

# A layer's names are views; what they show is registered in a layer of its own.
LAYERS = ("bronze", "silver", "gold", "bronze_files", "silver_files", "gold_files", "ops")

# Fixed value: how Spark names the folder of a null partition value.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"

# A manifest is summed up after so many entries, of which as many are kept for streams that follow and for history.
KEPT_ENTRIES = 32
# Folders that no entry names are left alone for so long: a run may be writing them.
LEFT_ALONE_SECONDS = 86_400.0


@dataclass(frozen=True)
class Layout:
    """Contract columns, plus the column the files are partitioned by."""

    columns: T.StructType
    partition: T.StructField | None = None

    @property
    def stored(self) -> T.StructType:
        return T.StructType([*self.columns, *([self.partition] if self.partition else [])])


# Bronze files lie in one folder per silver table they feed, so each silver stream reads its
# own share of the raw events; silver files lie in one folder per day, which the gold jobs'
# date bound prunes.
LAYOUTS: dict[tuple[str, str], Layout] = {
    ("bronze", "raw_events"): Layout(RAW_EVENTS, T.StructField("route", T.StringType())),
    **{
        ("silver", name): Layout(silver_schema(name), T.StructField("event_date", T.DateType()))
        for name in SILVER_EVENT
    },
    ("ops", "run_log"): Layout(RUN_LOG, T.StructField("entry", T.StringType())),
}

_PARTITION_VALUE = {"route": route, "event_date": lambda: F.to_date("timestamp")}


class Lake:
    """Tables under one shared folder, registered as ``<prefix><layer>.<table>``."""

    def __init__(self, spark: SparkSession, root: str, prefix: str = ""):
        self.spark, self.root, self.prefix = spark, root.rstrip("/"), prefix
        self._manifests: dict[tuple[str, str], Manifest] = {}
        self._shown: dict[tuple[str, str], tuple[str, int]] = {}

    def name(self, layer: str, table: str) -> str:
        return f"{self.prefix}{layer}.{table}"

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def checkpoint(self, job: str) -> str:
        return f"{self.root}/checkpoints/{job}"

    def manifest(self, layer: str, table: str) -> Manifest:
        key = (layer, table)
        if key not in self._manifests:
            self._manifests[key] = Manifest(self.spark, f"{self.path(*key)}/manifest")
        return self._manifests[key]

    @property
    def _store(self) -> Store:
        return Store(self.spark, self.root)

    # definition ---------------------------------------------------------------------------

    def create(self) -> Lake:
        """Create schemas and tables that do not exist yet."""
        for layer in LAYERS:
            self.spark.sql(
                f"CREATE SCHEMA IF NOT EXISTS {self.prefix}{layer} LOCATION '{self.root}/{layer}'"
            )
        for (layer, table), layout in LAYOUTS.items():
            if layer == "ops":
                # Partition folders are found from the files, not listed in the catalog.
                self.spark.sql(
                    f"CREATE TABLE IF NOT EXISTS {self.name(layer, table)} "
                    f"({column_ddl(layout.stored)}) USING parquet "
                    f"LOCATION '{self.path(layer, table)}' "
                    "TBLPROPERTIES ('parquet.compression'='snappy')"
                )
            else:
                self._show(layer, table)
        return self

    def _registered(self, layer: str, table: str, generation: str) -> str:
        return self.name(f"{layer}_files", f"{table}_{generation}")

    def _folder(self, layer: str, table: str, part: Part) -> str:
        value, commit = part
        return f"{self.path(layer, table)}/files/commit={commit}/{_partition(layer, table)}={value or NULL_FOLDER}"

    def _show(self, layer: str, table: str) -> bool:
        """Make the catalog show what the manifest says; whether the table exists.

        Also registers tables anew that a catalog without memory has forgotten.
        """
        state, view = self.manifest(layer, table).state(), self.name(layer, table)
        known, layout = LAYOUTS.get((layer, table)), self.spark.catalog
        if known is None and state.columns is None:
            return False
        now = (state.generation, state.version)
        if self._shown.get((layer, table)) == now and layout.tableExists(view):
            return True
        partition = _partition(layer, table)
        columns = column_ddl(known.stored) if known else state.columns
        registered = self._registered(layer, table, state.generation)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {registered} ({columns}, `commit` string) USING parquet "
            f"PARTITIONED BY ({partition}, `commit`) LOCATION '{self.path(layer, table)}/files'"
        )
        there = {row.partition for row in self.spark.sql(f"SHOW PARTITIONS {registered}").collect()}
        missing = [p for p in state.live if f"{partition}={p[0] or NULL_FOLDER}/commit={p[1]}" not in there]
        if missing:
            each = " ".join(
                f"PARTITION ({partition}={f"'{value}'" if value else 'NULL'}, `commit`='{commit}') "
                f"LOCATION '{self._folder(layer, table, (value, commit))}'"
                for value, commit in missing
            )
            self.spark.sql(f"ALTER TABLE {registered} ADD IF NOT EXISTS {each}")
        if not layout.tableExists(view) or self._generation(view) != state.generation:
            names = known.stored.names if known else [f.name for f in T.StructType.fromDDL(columns)]
            self.spark.sql(
                f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES ('generation' = '{state.generation}') "
                f"AS SELECT {', '.join(f'`{n}`' for n in names)} FROM {registered}"
            )
        layout.refreshTable(view)
        self._shown[layer, table] = now
        return True

    def _generation(self, view: str) -> str:
        """The generation that a view shows."""
        return self.spark.sql(f"SHOW TBLPROPERTIES {view} ('generation')").first()["value"]

    # reads --------------------------------------------------------------------------------

    def read(self, layer: str, table: str, day=None) -> DataFrame:
        """A table's contract columns; ``day`` keeps rows of that day or later.

        The bound names both the time and the folder column, so whole days are skipped before
        any file is opened.
        """
        name = self.name(layer, table)
        if layer == "ops":
            self.spark.catalog.refreshTable(name)
        else:
            self._show(layer, table)
        rows, layout = self.spark.table(name), LAYOUTS.get((layer, table))
        if day is not None:
            rows = rows.where(since(F.col("timestamp"), day))
            if layout and layout.partition and layout.partition.name == "event_date":
                rows = rows.where(F.col("event_date") >= F.lit(day).cast("date"))
        return rows.select(*layout.columns.names) if layout else rows

    def rows_of(self, layer: str, table: str, parts: list[Part]) -> DataFrame:
        """The contract columns of some parts of a table."""
        folders = [self._folder(layer, table, p) for p in parts]
        return self.spark.read.schema(LAYOUTS[layer, table].columns).parquet(*folders)

    def added(self, layer: str, table: str, after: int | None, newest: int, value: str | None = None) -> tuple[list[Part], int]:
        """The parts that came in after an entry, up to another one, and the entry they are complete to.

        With ``after`` None from the first entry on; where entries or folders of that time are gone, all that the table holds.
        Parts that only hold old rows anew, as sealed ones do, are left out.
        """
        manifest = self.manifest(layer, table)

        def between(first: int, last: int) -> list[Part]:
            entries = manifest.entries(first, last)
            return [tuple(p) for e in entries if not e.get("same") for p in e.get("add", ())]

        if after is None:
            state = manifest.state()
            try:
                parts, upto = between(-1, newest), newest
                whole = set(parts) <= set(state.live)
            except LookupError:
                whole = False
            if not whole:
                parts, upto = state.live, state.version
        else:
            upto = max(after, newest)
            parts = between(after, upto)
        return [p for p in parts if value is None or p[0] == value], upto

    def follow(
        self, layer: str, table: str, take: Callable[[int], None], *, job: str, trigger: dict,
        value: str | None = None, commits: int | None = None,
    ) -> StreamingQuery:
        """Call ``take`` with the newest entry of a table's manifest, again and again as entries come in.

        The stream reads one small note for each commit: those with rows of the partition ``value``, if one is given. So
        ``commits`` bounds a batch by what it will read, and no batch is without rows.
        """
        notes = f"{self.path(layer, table)}/notes/{value or 'all'}"
        self._store.make_folder(notes)
        self._announce(layer, table)
        reader = self.spark.readStream.schema("version long").format("json")
        if commits:
            reader = reader.option("maxFilesPerTrigger", str(commits))

        def each(rows: DataFrame, batch: int) -> None:
            newest = rows.agg(F.max("version")).first()[0]
            if newest is not None:
                take(newest)

        writer = reader.load(notes).writeStream.queryName(f"{self.prefix}{job}").foreachBatch(each)
        return writer.option("checkpointLocation", self.checkpoint(job)).trigger(**trigger).start()

    def tables(self, layer: str = "silver") -> list[str]:
        """Names of a layer's tables, from the catalog."""
        found = self.spark.sql(f"SHOW TABLES IN {self.prefix}{layer}").where("NOT isTemporary")
        return sorted(row.tableName for row in found.collect())

    def inventory(self, layer: str = "silver") -> DataFrame:
        """Row count per table of a layer."""
        counts = [
            self.read(layer, t).agg(F.count(F.lit(1)).alias("row_count"))
            .select(F.lit(layer).alias("layer"), F.lit(t).alias("table_name"), "row_count")
            for t in self.tables(layer)
        ]
        whole = counts[0]
        for part in counts[1:]:
            whole = whole.unionByName(part)
        return whole

    # writes -------------------------------------------------------------------------------

    def _write(self, rows: DataFrame, layer: str, table: str, commit: str, totals=None) -> list[Part]:
        """Write a commit's folder, and return its parts. What an earlier attempt left there goes.

        Rows are shuffled by folder first, so that a commit has few files however many tasks make it; adaptive execution
        splits a folder with many rows. Without it one task would get them all, and rows stay where they are.
        """
        partition, folder = _partition(layer, table), f"{self.path(layer, table)}/files/commit={commit}"
        if rows.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
            rows = rows.hint("rebalance", partition)
        if totals is not None:
            rows = rows.observe(totals[0], *totals[1])
        rows.write.mode("overwrite").partitionBy(partition).option("compression", "snappy").parquet(folder)
        return self._parts(layer, table, commit)

    def _parts(self, layer: str, table: str, commit: str) -> list[Part]:
        lead = f"{_partition(layer, table)}="
        found = self._store.list(f"{self.path(layer, table)}/files/commit={commit}")
        values = sorted(n.removeprefix(lead) for n in found if n.startswith(lead))
        return [(None if v == NULL_FOLDER else v, commit) for v in values]

    def append_stream(
        self, rows: DataFrame, layer: str, table: str, *, job: str, trigger: dict
    ) -> StreamingQuery:
        """Append a stream to a table, one commit a batch. A batch that is run again finds its commit, or its
        complete files, and neither loses nor repeats rows."""
        partition = LAYOUTS[layer, table].partition.name
        checkpoint = self.checkpoint(job)

        def each(batch_rows: DataFrame, batch: int) -> None:
            query = json.loads(self._store.read(f"{checkpoint}/metadata"))["id"]
            self.append(batch_rows.withColumn(partition, _PARTITION_VALUE[partition]()), layer, table, job=query, batch=batch)

        writer = rows.writeStream.queryName(f"{self.prefix}{job}").foreachBatch(each)
        return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()

    def append(self, rows: DataFrame, layer: str, table: str, *, job: str, batch: int) -> None:
        """Add a batch to a table, once; ``rows`` has the column the files are partitioned by."""
        manifest, commit = self.manifest(layer, table), f"{job}-{batch}"

        def entry(state: State) -> dict | None:
            return None if state.jobs.get(job, -1) >= batch else {"add": parts, "job": [job, batch]}

        if manifest.state().jobs.get(job, -1) < batch:
            # Complete files of an attempt that did not come to its entry may not be made anew: rows carry times.
            whole = self._store.exists(f"{self.path(layer, table)}/files/commit={commit}/_SUCCESS")
            parts = self._parts(layer, table, commit) if whole else self._write(rows, layer, table, commit)
            if parts:
                manifest.append(entry)
        self._settle(layer, table)

    def append_followed(self, rows: DataFrame, layer: str, table: str, *, after: int | None, upto: int) -> bool:
        """Add what was made of the entries after ``after``, up to ``upto``, of the table that is followed, once."""
        partition = LAYOUTS[layer, table].partition.name
        commit = f"from-{0 if after is None else after + 1}-{upto}"
        parts = self._write(rows.withColumn(partition, _PARTITION_VALUE[partition]()), layer, table, commit)

        def entry(state: State) -> dict | None:
            return {"add": parts, "upto": upto} if state.upto == after else None

        done = self.manifest(layer, table).append(entry) is not None
        self._settle(layer, table)
        return done

    def _settle(self, layer: str, table: str) -> None:
        """After an entry: tell the streams and the catalog, and keep the manifest small."""
        if layer == "bronze":
            self._announce(layer, table)
        self._show(layer, table)
        if (self.manifest(layer, table).state().version + 1) % KEPT_ENTRIES == 0:
            self.trim(layer, table, KEPT_ENTRIES)

    def _announce(self, layer: str, table: str) -> None:
        """Leave a note of each entry that has none yet, for the streams that follow."""
        notes, manifest = f"{self.path(layer, table)}/notes", self.manifest(layer, table)
        told = max((int(n.split(".")[0]) for n in self._store.list(f"{notes}/all") if n[0].isdigit()), default=None)
        version = manifest.state().version
        if told is None and version >= 0:
            told = min((s.version for s in manifest.history()), default=-1)
            entries = [{"version": told, "add": manifest.history()[0].live}] if told >= 0 else []
            entries += manifest.entries(told, version)
        else:
            entries = manifest.entries(told, version) if told is not None else []
        for entry in entries:
            if entry.get("same") or not entry.get("add"):
                continue
            # The note for all comes last: while it is missing the others are made again.
            for value in [*sorted({v for v, _ in entry["add"] if v}), "all"]:
                self._store.make_folder(f"{notes}/{value}")
                self._store.create(f"{notes}/{value}/{entry['version']:012d}.json", json.dumps({"version": entry["version"]}))

    def _passed(self, layer: str) -> int | None:
        """The entry of the bronze table that all silver tables have got to; None if there is no bound.

        A table none of whose rows came in since counts as having got to the newest, and is told so.
        """
        if layer != "bronze":
            return None
        raw = self.manifest("bronze", "raw_events")
        newest, got = raw.state().version, []
        for table, kind in SILVER_EVENT.items():
            own = self.manifest("silver", table)
            upto = own.state().upto
            if upto is None:  # it will start from all there is
                continue
            waiting = [e["version"] for e in raw.entries(upto, max(upto, newest)) if not e.get("same") and any(v == kind for v, _ in e.get("add", ()))]
            passed = min(waiting, default=newest + 1) - 1
            if passed >= upto + KEPT_ENTRIES:
                own.append(lambda state, upto=upto, passed=passed: {"upto": passed} if state.upto == upto else None)
                upto = own.state().upto
            got.append(upto)
        return min(got, default=None)

    def trim(self, layer: str, table: str, keep: int = KEPT_ENTRIES) -> None:
        """Sum up a manifest and delete its old entries and notes, but none that a silver table has yet to read."""
        gone = self.manifest(layer, table).trim(keep, self._passed(layer))
        notes = f"{self.path(layer, table)}/notes"
        for value in self._store.list(notes) if gone >= 0 else ():
            for name in sorted(n for n in self._store.list(f"{notes}/{value}") if n[0].isdigit())[:-1]:
                if int(name.split(".")[0]) <= gone:
                    self._store.delete(f"{notes}/{value}/{name}")

    def seal(self, layer: str, table: str, before=None, least: int = 2) -> list[str]:
        """Rewrite the parts of each day (of each route, in bronze) that ``least`` commits or more share into large files.

        ``before`` leaves that day and later ones alone. The rows stay the same, and the table shows the old files or the new
        ones, wherever a run stops: one entry takes the new ones in and the old ones out. These stay until ``vacuum``. In
        a day the rows of a user lie together. Returns the values that were sealed.
        """
        manifest = self.manifest(layer, table)
        by_value: dict[str | None, list[Part]] = {}
        for part in manifest.state().live:
            if before is None or (part[0] is not None and part[0] < str(before)):
                by_value.setdefault(part[0], []).append(part)
        old = [p for parts in by_value.values() if len(parts) >= least for p in parts]
        if not old:
            return []
        layout, commit = LAYOUTS[layer, table], f"sealed-{uuid.uuid4().hex[:12]}"
        partition = layout.partition.name
        rows = self.rows_of(layer, table, old).withColumn(partition, _PARTITION_VALUE[partition]())
        lie = [c for c in (partition, "user_id", "product_id") if c in rows.columns]
        rows = rows.hint("rebalance", partition).sortWithinPartitions(*lie)
        folder = f"{self.path(layer, table)}/files/commit={commit}"
        rows.write.partitionBy(partition).option("compression", "snappy").parquet(folder)
        parts = self._parts(layer, table, commit)

        def entry(state: State) -> dict | None:
            return {"add": parts, "drop": old, "same": True, "generation": commit.replace("-", "_")} if set(old) <= set(state.live) else None

        if manifest.append(entry) is None:  # someone else was faster
            return []
        self._show(layer, table)
        return sorted(v for v, _ in parts if v)

    def append_entry(self, row: tuple, table: str) -> None:
        """Append one row to an ops table, as a folder of its own: jobs that end at the same
        time do not meet in one."""
        entry = self.spark.createDataFrame([row], LAYOUTS["ops", table].columns)
        entry.coalesce(1).write.parquet(f"{self.path('ops', table)}/entry={uuid.uuid4().hex}")

    def overwrite_gold(
        self,
        rows: DataFrame,
        table: str,
        mode: str = "replace",
        totals: tuple[Observation, list[Column]] | None = None,
    ) -> None:
        """Write a gold table partitioned by ``date``.

        ``replace``: the table then holds these rows only. ``dynamic``: only the dates among these rows are replaced. Either
        way the rows go to a new folder, and a new version of the table points at it, and at the old folders of the dates that stay.
        The version is logged first, then one catalog call moves the table's view to it: a run that stops anywhere leaves the
        old rows or the new ones, and no other name.

        The rebalance hint gives each date as many files as its size calls for. ``totals`` are gathered after that
        shuffle, in the writing tasks themselves: each of those counts once, where a task
        before a shuffle that runs again after a lost executor would count twice.
        """
        if mode not in ("replace", "dynamic"):
            raise ValueError(f"unknown write mode {mode!r}")
        commit = uuid.uuid4().hex
        kept = [f for f in rows.schema if f.name != "date"]
        columns = column_ddl(T.StructType([*kept, rows.schema["date"]]))
        parts = self._write(rows, "gold", table, commit, totals)
        renewed = {value for value, _ in parts}

        def entry(state: State) -> dict:
            old = [p for p in state.live if mode == "replace" or p[0] in renewed]
            return {"add": parts, "drop": old, "generation": commit, "columns": columns}

        self.manifest("gold", table).append(entry)
        self._show("gold", table)

    # housekeeping -------------------------------------------------------------------------

    def vacuum(self, layer: str, table: str, keep: int = 1, left_alone: float = LEFT_ALONE_SECONDS) -> list[str]:
        """Delete commits, or days of them, that none of a table's newest ``keep`` versions holds, and no stream has yet to read.

        A version is the table after an entry. Commits that no entry names are left alone for ``left_alone`` seconds, in
        case a run is writing them. Never done unasked: queries that still read an old version lose their files.
        """
        if keep < 1:
            raise ValueError("at least one version is kept")
        states = self.manifest(layer, table).history()
        passed = self._passed(layer)
        held = [s for k, s in enumerate(states) if len(states) - k <= keep or (passed is not None and s.version >= passed)]
        kept = {part for s in held for part in s.live}
        named = {commit for s in states for _, commit in s.live}
        files, gone = f"{self.path(layer, table)}/files", []
        for folder, changed in self._store.list(files).items():
            commit = folder.removeprefix("commit=")
            if commit == folder or (commit not in named and time.time() - changed <= left_alone):
                continue
            parts = self._parts(layer, table, commit)
            unused = [p for p in parts if p not in kept]
            if len(unused) == len(parts):
                self._store.delete(f"{files}/{folder}")
                gone.append(commit)
            else:  # some days of it are still shown
                for part in unused:
                    self._store.delete(self._folder(layer, table, part))
                    gone.append(f"{commit}/{part[0]}")
        used = {f"{table}_{s.generation}" for s in held}
        for name in self.tables(f"{layer}_files"):
            if name.startswith(f"{table}_") and name not in used:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.name(f'{layer}_files', name)}")
        return sorted(gone)

    def vacuum_gold(self, table: str, keep: int) -> list[str]:
        """``vacuum`` of a gold table; one never written has nothing to delete."""
        if keep < 1:
            raise ValueError("at least one version is kept")
        return self.vacuum("gold", table, keep) if self._show("gold", table) else []


def _partition(layer: str, table: str) -> str:
    return "date" if layer == "gold" else LAYOUTS[layer, table].partition.name
