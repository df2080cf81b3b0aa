"""Where a run keeps its tables: Parquet folders under one root on shared storage.

    bronze/<table>/ingestion_id=<id>            all landed rows, one folder per run
    silver_daily/<table>/ingestion_id=<id>/is_rejected=<0|1>
    changes/<table>/ingestion_id=<id>           matches and changes of a merge
    silver/<table>/data/version=<v>/state=<s>/month=<m>/slot=<k>
                                                main table, copy on write by part, in buckets of the key
    silver/<table>/manifest/<n>.json            the parts in force and their rows
    quarantine/table_name=<table>/ingestion_id=<id>
    logs/<log>/...                              file log and run log
    registry/ingestion_id=<id>                  the files of a run
    batches/<id>.<stage>                        what is finished, and <id>.<table>.epoch

Parquet has no row-level merge, and a path cannot be overwritten while it is read. So a merge writes
the parts it changes to a version folder of its own and then creates the next manifest; a reader always
sees one whole version, and a run that dies, or that another one overtakes, leaves the last version in
force. Rows that ended stand in parts of their own, which are only ever added to.

A version is read through a catalog table over its parts, which tells Spark that they are bucketed and
sorted by key. So a merge joins its batch bucket by bucket and moves no row of the main table.
"""

from __future__ import annotations

import datetime as dt
import json
import threading
import uuid
from collections.abc import Callable, Iterable
from typing import NamedTuple

from pyspark.sql import Column as Col
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import month_of
from tidemark.operators.metrics import FILE_LOG, RUN_LOG
from tidemark.sources.files import Files
from tidemark.sources.layers import empty
from tidemark.spec import Batch, TableSpec

WHOLE = "all"
# Rows in force, and rows of a history that have ended.
CURRENT, CLOSED = "current", "closed"
# Where versions are known by name, and how many parts are named to the catalog at once.
DATABASE, NAMED = "tidemark_versions", 500
# Rows of a bucket of a small first batch, which gets a few buckets at most, and of a large one.
SMALL, FEW, LARGE = 1 << 17, 8, 1 << 23
PLACE = "version string, state string, month string, slot int"
# Of what is read once or kept for long. Landed rows are split among tasks by their size, so theirs stay as they are.
PACKED = {"compression": "zstd"}

QUARANTINE = (
    "id bigint, flagged_at timestamp_ntz, reject_reason string, raw_row string, table_name string, ingestion_id bigint"
)
REGISTRY = "file_name string, path string, length bigint, modified bigint, table_name string"


class Part(NamedTuple):
    """One folder of a main table: the rows of one state, month and slot that one version has written."""

    version: str
    state: str
    month: str
    slot: int
    rows: int

    @property
    def place(self) -> tuple[str, int]:
        return self.month, self.slot

    @property
    def label(self) -> str:
        return f"{self.version}/{self.state}/{self.month}/{self.slot}"


class Manifest(tuple):
    """The number of a version, and the number of the version that wrote each month of its rows in force.

    ``parts`` are all its parts. ``buckets`` and ``slots`` never change in a table's life. ``name`` is the
    version's own, which no other attempt at the same number has; ``maker`` is the run that wrote it.
    """

    def __new__(cls, number: int, parts: Iterable[Part], buckets: int, slots: int, name: str = "", maker: int = 0):
        parts = tuple(parts)
        months: dict[str, int] = {}
        for p in parts:
            if p.state == CURRENT:
                months[p.month] = max(months.get(p.month, 0), int(p.version.split("-")[0]))
        self = super().__new__(cls, (number, {m: str(v) for m, v in months.items()}))
        self.number, self.parts, self.buckets, self.slots, self.name, self.maker = number, parts, buckets, slots, name, maker
        return self

    @property
    def rows(self) -> int:
        """Rows in force, known from the parts without reading them."""
        return sum(p.rows for p in self.parts if p.state == CURRENT)

    def text(self) -> str:
        kept = {k: getattr(self, k) for k in ("buckets", "slots", "name", "maker")}
        return json.dumps(kept | {"parts": self.parts})

    @classmethod
    def of(cls, number: int, text: str) -> Manifest:
        held = json.loads(text)
        return cls(number, [Part(*p) for p in held.pop("parts")], **held)


class Lake:
    """Reads and writes the layers of one root folder.

    ``buckets`` is how many parts by key each folder of a new main table gets; a table keeps the number
    it began with. Without it the rows of the first batch decide, which suits tables that grow little.
    A task of a merge holds one bucket of the parts it rewrites, so a table that will grow to terabytes
    wants some thousands from the start.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.files = Files(spark)
        self.buckets = buckets
        self._known: set[str] = set()
        self._lock = threading.Lock()

    # ---- folders of one run ----

    def _run(self, layer: str, spec: TableSpec, ingestion_id: int) -> str:
        return f"{self.root}/{layer}/{spec.name}/ingestion_id={ingestion_id}"

    def write_bronze(self, spec: TableSpec, rows: DataFrame, ingestion_id: int) -> None:
        """Write one run's landed rows; a repeated run replaces its own folder only."""
        rows.write.mode("overwrite").parquet(self._run("bronze", spec, ingestion_id))

    def has_bronze(self, spec: TableSpec, ingestion_id: int) -> bool:
        return self.files.exists(f"{self._run('bronze', spec, ingestion_id)}/_SUCCESS")

    def bronze_daily(self, spec: TableSpec, ingestion_id: int) -> DataFrame:
        """The rows one run landed."""
        return self.spark.read.schema(spec.bronze_schema()).parquet(
            self._run("bronze", spec, ingestion_id)
        )

    def bronze(self, spec: TableSpec) -> DataFrame:
        """Everything ever landed, with its ``ingestion_id``."""
        schema = spec.bronze_schema().add("ingestion_id", T.LongType())
        return self.spark.read.schema(schema).parquet(self.bronze_path(spec))

    def bronze_path(self, spec: TableSpec) -> str:
        return f"{self.root}/bronze/{spec.name}"

    def retire_bronze(self, spec: TableSpec, ingestion_id: int) -> None:
        """Drop a merged run's landed rows, for those who keep no bronze history."""
        self.files.drop(self._run("bronze", spec, ingestion_id))

    def write_tagged(self, spec: TableSpec, tagged: DataFrame, ingestion_id: int) -> DataFrame:
        """Write good and rejected rows apart in one pass, and read them back."""
        is_rejected = F.col("reject_reason").isNotNull().cast("int").alias("is_rejected")
        path = self._run("silver_daily", spec, ingestion_id)
        tagged.select("*", is_rejected).write.mode("overwrite").partitionBy("is_rejected").options(
            **PACKED
        ).parquet(path)
        return self.tagged(spec, ingestion_id)

    def tagged(self, spec: TableSpec, ingestion_id: int) -> DataFrame:
        schema = (
            spec.daily_schema()
            .add("reject_reason", T.StringType())
            .add("is_rejected", T.IntegerType())
        )
        return self.spark.read.schema(schema).parquet(
            self._run("silver_daily", spec, ingestion_id)
        )

    def daily(self, spec: TableSpec, ingestion_id: int) -> DataFrame:
        """The clean rows of one run."""
        rows = self.tagged(spec, ingestion_id).filter("is_rejected = 0")
        return rows.drop("is_rejected", "reject_reason")

    def write_changes(
        self, spec: TableSpec, step: str, rows: DataFrame, ingestion_id: int
    ) -> DataFrame:
        """Write an intermediate result of a merge, cutting its lineage, and read it back."""
        path = f"{self._run('changes', spec, ingestion_id)}/step={step}"
        rows.write.mode("overwrite").options(**PACKED).parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def write_quarantine(self, spec: TableSpec, rows: DataFrame, ingestion_id: int) -> None:
        """Write one run's rejects; a repeated run replaces its own."""
        path = f"{self.root}/quarantine/table_name={spec.name}/ingestion_id={ingestion_id}"
        numbered = rows.drop("table_name", "ingestion_id").withColumn(
            "id", F.monotonically_increasing_id()
        )
        numbered.write.mode("overwrite").options(**PACKED).parquet(path)

    def quarantine(self) -> DataFrame:
        schema, path = self.logs()["quarantine"]
        if not self.files.exists(path):
            return empty(self.spark, schema)
        return self.spark.read.schema(schema).parquet(path)

    def logs(self) -> dict[str, tuple[T.StructType, str]]:
        """Schema and folder of rejected rows and of both logs, each in parts by table and run."""
        kinds = {"quarantine": QUARANTINE, "file_log": FILE_LOG, "run_log": RUN_LOG}
        paths = {"quarantine": "quarantine", "file_log": "logs/files", "run_log": "logs/runs"}
        return {k: (T.StructType.fromDDL(v), f"{self.root}/{paths[k]}") for k, v in kinds.items()}

    # ---- main tables ----

    def _main(self, spec: TableSpec) -> str:
        return f"{self.root}/silver/{spec.name}"

    def _manifests(self, spec: TableSpec) -> str:
        return f"{self._main(spec)}/manifest"

    def manifest(self, spec: TableSpec, before: int | None = None) -> Manifest:
        """The version in force, number 0 before the first; or the newest that the run ``before`` has not made."""
        for name in reversed(self.files.names(self._manifests(spec))):
            try:
                held = Manifest.of(int(name.split(".")[0]), self.files.read_text(f"{self._manifests(spec)}/{name}"))
            except json.JSONDecodeError:
                continue  # being written just now
            if before is None or held.maker != before:
                return held
        return Manifest(0, (), spec.slots, spec.slots)

    def begun(self, spec: TableSpec, rows: int) -> Manifest:
        """What a main table starts from whose first batch has so many rows."""
        wanted = self.buckets or max(min(FEW, rows // SMALL), rows // LARGE, 1)
        # Every bucket lies in one slot.
        return Manifest(0, (), -(-wanted // spec.slots) * spec.slots, spec.slots)

    def named(self, spec: TableSpec, held: Manifest) -> str:
        """The catalog table over the parts of a version. Whoever reads it first makes it."""
        name = f"{DATABASE}.{spec.name}_{held.number}_{held.name}"
        with self._lock:
            if name in self._known:
                return name
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.main_schema())
            keys = ", ".join(f"`{k}`" for k in spec.key)
            run = self.spark.sql
            run(f"CREATE DATABASE IF NOT EXISTS {DATABASE}")
            run(
                f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {PLACE}) USING parquet "
                f"PARTITIONED BY (version, state, month, slot) CLUSTERED BY ({keys}) SORTED BY ({keys}) "
                f"INTO {held.buckets} BUCKETS LOCATION '{self._main(spec)}/data'"
            )
            # Another process may have made the table and not its parts yet; adding them again changes nothing.
            for at in range(0, len(held.parts), NAMED):
                parts = " ".join(
                    f"PARTITION (version='{p.version}', state='{p.state}', month='{p.month}', slot={p.slot})"
                    for p in held.parts[at : at + NAMED]
                )
                run(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
            self._known.add(name)
        return name

    def rows(self, spec: TableSpec, held: Manifest, wanted: Callable[[Part], bool] | None = None) -> DataFrame:
        """The rows of a version, or of its wanted parts; no other part is listed or opened."""
        parts = [p for p in held.parts if wanted is None or wanted(p)]
        names = spec.main_schema().names
        if not parts:
            return empty(self.spark, spec.main_schema())
        whole = self.spark.table(self.named(spec, held))
        current = [p for p in held.parts if p.state == CURRENT]
        if parts == current and len(parts) < len(held.parts):
            whole = whole.filter(F.col("state") == CURRENT)
        elif len(parts) < len(held.parts):
            label = F.concat_ws("/", "version", "state", "month", F.col("slot").cast("string"))
            whole = whole.filter(label.isin([p.label for p in parts]))
        return whole.select(*names)

    def main(self, spec: TableSpec) -> DataFrame:
        """The main table as of its last finished merge."""
        return self.rows(spec, self.manifest(spec))

    def current(self, spec: TableSpec, held: Manifest | None = None) -> DataFrame:
        """The rows in force, without those of a history that have ended."""
        return self.rows(spec, held or self.manifest(spec), lambda p: p.state == CURRENT)

    def main_between(self, spec: TableSpec, first: dt.date, last: dt.date) -> DataFrame:
        """Main rows dated from ``first`` to ``last``; only the months in between are opened."""
        low, high = f"{first:%Y-%m}", f"{last:%Y-%m}"
        found = self.rows(spec, self.manifest(spec), lambda p: low <= p.month <= high)
        return found.filter(F.col(spec.month_of).cast("date").between(first, last))

    def month(self, spec: TableSpec) -> Col:
        """The month of a main row."""
        return month_of(F.col(spec.month_of)) if spec.month_of else F.lit(WHOLE)

    def slot(self, spec: TableSpec, slots: int) -> Col:
        """The slot of a main row. It follows the hash that Spark's buckets follow."""
        return F.pmod(F.hash(*spec.key), F.lit(slots))

    def state(self, spec: TableSpec) -> Col:
        return F.when(F.col("is_valid"), CURRENT).otherwise(CLOSED) if spec.history else F.lit(CURRENT)

    def dealt(self, spec: TableSpec, rows: DataFrame, held: Manifest) -> DataFrame:
        """Rows dealt to tasks by bucket, for those that no join has dealt so."""
        return rows.repartition(held.buckets, *spec.key)

    def rewrite(
        self,
        spec: TableSpec,
        touched: Callable[[Part], bool],
        rows_of: Callable[[DataFrame], DataFrame],
        held: Manifest,
        maker: int = 0,
    ) -> Manifest:
        """Write new contents of some parts and put them in force, if no other merge got there first.

        ``rows_of`` turns the present rows of those parts into their new rows. All other parts stay where
        they are. Two attempts at one version write folders of different names, so the one that comes too
        late harms nothing but its own.
        """
        attempt = uuid.uuid4().hex[:12]
        version, number = f"{held.number + 1}-{attempt}", held.number + 1
        path = f"{self._main(spec)}/data/version={version}"
        folders, target = ["state", "month", "slot"], path
        if not spec.history:
            # All rows have one state. As a column it would come first in the sort that a write needs, and tell no rows apart.
            folders, target = folders[1:], f"{path}/state={CURRENT}"
        places = {"state": self.state(spec), "month": self.month(spec), "slot": self.slot(spec, held.slots)}
        rows = rows_of(self.rows(spec, held, touched)).select(
            *spec.main_schema().names, *[places[f].alias(f) for f in folders]
        )
        if sum(p.rows for p in held.parts if touched(p)) < LARGE:
            # So few rows are dealt out anew by the files that they go to: a task writes a file at a time.
            rows = rows.withColumn("_file", self.slot(spec, held.buckets)).hint("rebalance", "month", "_file").drop("_file")
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {DATABASE}")
        # Buckets can be written by a table name only; the name goes again, the files stay.
        name = f"{DATABASE}.writing_{attempt}"
        rows.write.format("parquet").partitionBy(*folders).bucketBy(held.buckets, *spec.key).sortBy(
            *spec.key
        ).options(path=target, **PACKED).saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")
        schema = T.StructType.fromDDL("state string, month string, slot int")
        found = self.spark.read.schema(T.StructType([*spec.main_schema(), *schema])).parquet(path)
        # Counts come from the files' footers.
        counts = found.groupBy(*schema.names).count().collect()
        written = [Part(version, r["state"], r["month"], r["slot"], r["count"]) for r in counts]
        kept = [p for p in held.parts if not touched(p)]
        new = Manifest(number, sorted(kept + written), held.buckets, held.slots, attempt, maker)
        self.files.create_text(f"{self._manifests(spec)}/{number:09d}.json", new.text())
        return new

    def rewrite_months(
        self, spec: TableSpec, months: set[str], rows_of: Callable[[DataFrame], DataFrame], held: Manifest, maker: int = 0
    ) -> Manifest:
        """Write new contents of whole months."""
        return self.rewrite(spec, lambda p: p.state == CURRENT and p.month in months, rows_of, held, maker)

    def expire(self, spec: TableSpec, keep: int = 2) -> int:
        """Drop parts that none of the last ``keep`` versions use; returns how many.

        Readers of older versions must be finished. Only folder names are handled here. What an overtaken
        attempt has left behind goes too.
        """
        names = self.files.names(self._manifests(spec))
        held = [Manifest.of(int(n.split(".")[0]), self.files.read_text(f"{self._manifests(spec)}/{n}")) for n in names]
        live = {p.label for version in held[-keep:] for p in version.parts}
        used = {label.split("/")[0] for label in live}
        data, dropped = f"{self._main(spec)}/data", 0
        newest = held[-1].number if held else 0
        for folder in self.files.names(data):
            version = folder.removeprefix("version=")
            if int(version.split("-")[0]) > newest:
                continue  # a merge that has not committed yet
            leaves = [
                (f"{folder}/{state}/{month}/{slot}", "/".join(x.split("=", 1)[1] for x in (folder, state, month, slot)))
                for state in self.files.names(f"{data}/{folder}") if "=" in state
                for month in self.files.names(f"{data}/{folder}/{state}") if "=" in month
                for slot in self.files.names(f"{data}/{folder}/{state}/{month}")
            ]
            for path, label in leaves:
                if label not in live:
                    self.files.drop(f"{data}/{path}")
                    dropped += 1
            if version not in used:
                self.files.drop(f"{data}/{folder}")
        for name, old in zip(names[:-keep], held[:-keep]):
            table = f"{DATABASE}.{spec.name}_{old.number}_{old.name}"
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {DATABASE}")
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            self._known.discard(table)
            self.files.drop(f"{self._manifests(spec)}/{name}")
        return dropped

    def drop_staging(self, spec: TableSpec, ingestion_id: int) -> None:
        """Drop a merged run's intermediate tables."""
        for layer in ("silver_daily", "changes"):
            self.files.drop(self._run(layer, spec, ingestion_id))

    # ---- files of runs ----

    def _registry(self, ingestion_id: int) -> str:
        return f"{self.root}/registry/ingestion_id={ingestion_id}"

    def has_registry(self, ingestion_id: int) -> bool:
        return self.files.exists(f"{self._registry(ingestion_id)}/_SUCCESS")

    def write_registry(self, files: DataFrame, ingestion_id: int) -> None:
        """Write down the files of a run, those no table claims included."""
        names = T.StructType.fromDDL(REGISTRY).names
        files.select(*names).write.mode("overwrite").parquet(self._registry(ingestion_id))

    def registry(self) -> DataFrame:
        """Every file that a run has claimed, with its ``ingestion_id``."""
        schema = T.StructType.fromDDL(f"{REGISTRY}, ingestion_id bigint")
        path = f"{self.root}/registry"
        if not self.files.exists(path):
            return empty(self.spark, schema)
        return self.spark.read.schema(schema).parquet(path)

    # ---- logs and finished work ----

    def write_log(self, log: str, rows: DataFrame, table: str, ingestion_id: int) -> None:
        path = f"{self.root}/logs/{log}/table_name={table}/ingestion_id={ingestion_id}"
        rows.drop("table_name", "ingestion_id").write.mode("overwrite").parquet(path)

    def _log(self, log: str, schema: str) -> DataFrame:
        path = f"{self.root}/logs/{log}"
        fields = T.StructType.fromDDL(schema)
        if not self.files.exists(path):
            return empty(self.spark, fields)
        return self.spark.read.schema(fields).parquet(path).select(*fields.names)

    def file_log(self) -> DataFrame:
        return self._log("files", FILE_LOG)

    def run_log(self) -> DataFrame:
        return self._log("runs", RUN_LOG)

    def next_ingestion_id(self) -> int:
        """A number no finished or started run has used."""
        started = [int(n.split(".")[0]) for n in self.files.names(f"{self.root}/batches")]
        return max(started, default=0) + 1

    def is_done(self, ingestion_id: int, stage: str) -> bool:
        return self.files.exists(f"{self.root}/batches/{ingestion_id}.{stage}")

    def bind_epoch(self, spec: TableSpec, ingestion_id: int, epoch: int) -> None:
        """Tie a run of one table to a micro-batch. A run already tied to another one is refused."""
        path = f"{self.root}/batches/{ingestion_id}.{spec.name}.epoch"
        if not self.files.exists(path):
            self.files.create_text(path, str(epoch))
        elif (held := self.files.read_text(path)) != str(epoch):
            raise ValueError(
                f"run {ingestion_id} of {spec.name} holds micro-batch {held}; micro-batch {epoch} needs a run of its own"
            )

    def mark_done(self, batch: Batch, stage: str) -> None:
        if not self.is_done(batch.ingestion_id, stage):
            self.files.create_text(
                f"{self.root}/batches/{batch.ingestion_id}.{stage}", batch.as_of.isoformat()
            )
