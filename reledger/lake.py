"""The tables of the lake and the few ways of changing them."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reledger.functions.calendar import REPORT_MONTH, in_months
from reledger.operators.rollup import metrics_select_sql
from reledger.sources.footers import footers, stamped
from reledger.storage import Files, shuffles_freed

LAYERS = ("bronze", "silver", "gold")

# Sorted dates and counters shrink under delta encoding; low-cardinality text falls back to
# dictionary pages.
FILE_OPTIONS = {
    "compression": "zstd",
    "parquet.compression.codec.zstd.level": "3",
    "parquet.writer.version": "PARQUET_2_0",
}
# Statements of others that write to these tables overwrite by partition.
TABLE_OPTIONS = {**FILE_OPTIONS, "partitionOverwriteMode": "dynamic"}

# Below the location of a table: a folder a load, and a short file a commit.
LOADS = "_loads"
COMMITS = "_commits"
SEEN = "reledger.commit"
STATEMENT_PARTITIONS = 500
MERGED_COMMITS = 64


@dataclass(frozen=True)
class Table:
    """The contract of one table: columns in order, partition columns, clustering columns."""

    layer: str
    name: str
    columns: tuple[tuple[str, str], ...]
    partitions: tuple[str, ...]
    clustering: tuple[str, ...]
    lookups: tuple[str, ...] = ()

    @property
    def file_options(self) -> dict[str, str]:
        """How files are written: columns looked up by value get a bloom filter a row group,
        no larger than their distinct values need."""
        blooms = {f"parquet.bloom.filter.enabled#{column}": "true" for column in self.lookups}
        sized = {"parquet.bloom.filter.adaptive.enabled": "true"} if blooms else {}
        return {**FILE_OPTIONS, **blooms, **sized}

    @property
    def column_order(self) -> list[str]:
        """Columns as Spark lays them out: the partition columns come last."""
        stored = [name for name, _ in self.columns if name not in self.partitions]
        return [*stored, *self.partitions]

    def type_of(self, column: str) -> str:
        return dict(self.columns)[column]


TECHNICAL = (
    ("_source", "string"),
    ("_source_file", "string"),
    ("_extracted_at", "date"),
    ("_ingested_at", "timestamp"),
)
EXTRACTION = ("_source", "_extracted_at")
COMPONENT_COLUMNS = (
    ("spend_eur", "decimal(18,6)"),
    ("clicks", "bigint"),
    ("impressions", "bigint"),
    ("conversions", "bigint"),
    ("revenue_eur", "decimal(18,6)"),
)

BASELINE = Table(
    "bronze",
    "ads_raw",
    (
        *TECHNICAL,
        ("account_id", "string"),
        ("campaign_id", "string"),
        ("report_date", "date"),
        ("cost_micros", "bigint"),
        ("clicks", "bigint"),
        ("impressions", "decimal(20,0)"),
        ("conversions", "bigint"),
    ),
    EXTRACTION,
    ("account_id", "report_date", "campaign_id"),
)

# An extraction may revise several months. Keeping them apart below the extraction lets a
# month be republished from its own files alone, and tells which months an extraction holds
# by listing partitions instead of scanning rows.
GOOGLE_RAW = Table(
    "bronze",
    "google_ads_raw",
    (
        *TECHNICAL,
        ("account_id", "string"),
        ("campaign_id", "string"),
        ("product_id", "string"),
        ("segments_date", "date"),
        ("cost_micros", "bigint"),
        ("clicks", "bigint"),
        ("impressions", "bigint"),
        ("conversions", "bigint"),
        ("revenue_eur", "decimal(18,2)"),
        (REPORT_MONTH, "int"),
    ),
    (*EXTRACTION, REPORT_MONTH),
    ("account_id", "segments_date", "campaign_id", "product_id"),
)

META_RAW = Table(
    "bronze",
    "meta_ads_raw",
    (
        *TECHNICAL,
        ("account_id", "string"),
        ("campaign_id", "string"),
        ("date_start", "date"),
        ("spend", "decimal(18,2)"),
        ("clicks", "bigint"),
        ("impressions", "bigint"),
        ("conversions", "bigint"),
        ("revenue_eur", "decimal(18,2)"),
        (REPORT_MONTH, "int"),
    ),
    (*EXTRACTION, REPORT_MONTH),
    ("account_id", "date_start", "campaign_id"),
)

SILVER = Table(
    "silver",
    "ads_daily",
    (
        ("source", "string"),
        ("account_id", "string"),
        ("report_date", "date"),
        ("campaign_id", "string"),
        ("product_id", "string"),
        *COMPONENT_COLUMNS,
        ("_extracted_at", "date"),
        (REPORT_MONTH, "int"),
    ),
    (REPORT_MONTH,),
    ("source", "account_id", "report_date", "campaign_id", "product_id"),
    lookups=("campaign_id", "product_id"),
)

GOLD = Table(
    "gold",
    "campaign_daily",
    (
        ("source", "string"),
        ("account_id", "string"),
        ("campaign_id", "string"),
        ("report_date", "date"),
        *COMPONENT_COLUMNS,
        (REPORT_MONTH, "int"),
    ),
    (REPORT_MONTH,),
    ("source", "account_id", "campaign_id", "report_date"),
)

TABLES = (BASELINE, GOOGLE_RAW, META_RAW, SILVER, GOLD)
METRICS_VIEW = "campaign_daily_metrics"

PartitionSpec = dict[str, str]


@dataclass(frozen=True)
class Replaced:
    """The rows written, the partitions that hold them, and those of the scope that are empty."""

    rows: int
    written: list[PartitionSpec]
    emptied: list[PartitionSpec]


@dataclass(frozen=True)
class Lake:
    """Where the tables live. `prefix` keeps several lakes apart within one catalog."""

    spark: SparkSession
    root: str
    prefix: str = ""

    def database(self, layer: str) -> str:
        return f"{self.prefix}{layer}"

    def name(self, table: Table) -> str:
        return f"{self.database(table.layer)}.{table.name}"

    def location(self, table: Table) -> str:
        return f"{self.root}/{table.layer}/{table.name}"

    @property
    def landing(self) -> str:
        return f"{self.root}/raw"

    @property
    def metrics_view(self) -> str:
        return f"{self.database('gold')}.{METRICS_VIEW}"

    def table(self, table: Table) -> DataFrame:
        """The rows of a table as of its last commit."""
        self.sync(table)
        return self.spark.table(self.name(table))

    # --- definitions -------------------------------------------------------------------

    def ensure_tables(self, *, attach: bool = True) -> None:
        """Create what is missing; a second call changes nothing.

        A table met for the first time by this catalog may already have files, whose
        partitions are then listed once. `attach=False` says that there are none.
        """
        for layer in LAYERS:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database(layer)}")
        for table in TABLES:
            if not self.spark.catalog.tableExists(self.name(table)):
                self._create(table)
                if attach:
                    Files(self.spark, self.location(table)).make(".")  # one to list must exist
                    self.spark.sql(f"MSCK REPAIR TABLE {self.name(table)}")
            self.sync(table)
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.metrics_view} AS "
            + metrics_select_sql(self.name(GOLD), [*dict(GOLD.columns)])
        )

    def _create(self, table: Table) -> None:
        columns = ", ".join(f"{name} {ddl_type}" for name, ddl_type in table.columns)
        options = ", ".join(f"'{key}'='{value}'" for key, value in TABLE_OPTIONS.items())
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({columns}) USING parquet "
            f"OPTIONS ({options}) PARTITIONED BY ({', '.join(table.partitions)}) "
            f"LOCATION '{self.location(table)}'"
        )

    def _write_nothing(self, table: Table, mode: str) -> None:
        empty = self.spark.createDataFrame([], self.spark.table(self.name(table)).schema)
        empty.write.mode(mode).option("partitionOverwriteMode", "static").partitionBy(
            *table.partitions
        ).parquet(self.location(table))

    def clone_structure(self, table: Table, new_name: str) -> str:
        """An empty table shaped and partitioned like `table`, in the same database."""
        clone = f"{self.database(table.layer)}.{new_name}"
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {clone} LIKE {self.name(table)} "
            f"LOCATION '{self.root}/{table.layer}/{new_name}'"
        )
        return clone

    # --- commits -----------------------------------------------------------------------

    def sync(self, table: Table) -> None:
        """Bring the catalog up to the last commit of a table.

        A commit is a short file that says which partitions of a table a load replaced, and
        in which folder their rows are. It is the one instant at which a load takes effect:
        whoever was lost before it has changed nothing, and whatever was lost after it is made
        up for here. The number of the last commit a catalog has seen is a table property.
        """
        files = Files(self.spark, self.location(table))
        seen = self._seen(table)
        missed = [number for number in _commit_numbers(files) if number > seen]
        if missed:
            known = {_folder(table, spec) for spec in self._listed(table)}
            for number in missed:
                self._apply(table, number, _read_commit(files, number), known)

    def _seen(self, table: Table) -> int:
        properties = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(table)}").collect()
        return next((int(row[1]) for row in properties if row[0] == SEEN), 0)

    def _commit(self, table: Table, placed: dict[str, str], dropped: list[str]) -> None:
        """Make a load take effect, then delete what it replaced.

        `placed` names the load that holds each partition, `dropped` the partitions to forget.
        """
        files = Files(self.spark, self.location(table))
        number = max([self._seen(table), *_commit_numbers(files)]) + 1
        files.make(COMMITS)
        _write_commit(files, number, placed, dropped)
        self.sync(table)
        self._sweep(table, files, number)

    def _apply(self, table: Table, number: int, commit: dict, known: set[str]) -> None:
        """Point the catalog at the folders of one commit; doing so twice changes nothing."""
        name, placed, dropped = self.name(table), commit["placed"], commit["dropped"]

        def part(folder: str) -> str:
            return f"PARTITION ({_literals(table, _spec(folder))})"

        def place(folder: str) -> str:
            return f"LOCATION '{self.location(table)}/{LOADS}/{placed[folder]}/{folder}'"

        added = [folder for folder in placed if folder not in known]
        for first in range(0, len(added), STATEMENT_PARTITIONS):
            some = added[first : first + STATEMENT_PARTITIONS]
            parts = " ".join(f"{part(folder)} {place(folder)}" for folder in some)
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
        for folder in placed:
            if folder in known:
                self.spark.sql(f"ALTER TABLE {name} {part(folder)} SET {place(folder)}")
        if dropped:
            parts = ", ".join(part(folder) for folder in dropped)
            self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {parts}")
        known.update(placed)
        known.difference_update(dropped)
        self._mark_seen(table, number)
        self.spark.catalog.refreshTable(name)

    def _mark_seen(self, table: Table, number: int) -> None:
        self.spark.sql(f"ALTER TABLE {self.name(table)} SET TBLPROPERTIES ('{SEEN}'='{number}')")

    def _sweep(self, table: Table, files: Files, number: int) -> None:
        """Delete the folders a commit replaced, and merge commits when there are many."""
        numbers = [earlier for earlier in _commit_numbers(files) if earlier <= number]
        commits = [_read_commit(files, earlier) for earlier in numbers]
        before, after = _state(commits[:-1]), _state(commits)
        for folder in {*commits[-1]["placed"], *commits[-1]["dropped"]}:
            files.delete(folder)  # where statements of others put rows
            if folder in before:
                files.delete(f"{LOADS}/{before[folder]}/{folder}")
        for load in set(before.values()) - set(after.values()):
            files.delete(f"{LOADS}/{load}")
        # A dropped partition may come back by a statement, so its commit must not outlive it.
        if commits[-1]["dropped"] or len(numbers) > MERGED_COMMITS:
            _write_commit(files, number + 1, after, [])
            if self._seen(table) == number:
                self._mark_seen(table, number + 1)
            for earlier in numbers:
                files.delete(f"{COMMITS}/{earlier:012d}")

    def remove_abandoned(self, table: Table) -> list[str]:
        """Delete the partition folders that no commit refers to: of loads that were lost before
        their commit, or after it and before the deletions. No load may be under way."""
        self.sync(table)
        files = Files(self.spark, self.location(table))
        state = _state([_read_commit(files, number) for number in _commit_numbers(files)])
        pattern = "/".join(["*", *(f"{column}=*" for column in table.partitions)])
        live = {f"{load}/{folder}" for folder, load in state.items()}
        left = [folder for folder in files.matches(LOADS, pattern) if folder not in live]
        for folder in left:
            files.delete(f"{LOADS}/{folder}")
        for load in set(files.names(LOADS)) - set(state.values()):
            files.delete(f"{LOADS}/{load}")
        return left

    # --- partitions --------------------------------------------------------------------

    def partitions(
        self, table: Table, within: PartitionSpec | None = None
    ) -> list[PartitionSpec]:
        """The partitions of a table, or of one leading part, from the catalog alone."""
        self.sync(table)
        return self._listed(table, within)

    def _listed(self, table: Table, within: PartitionSpec | None = None) -> list[PartitionSpec]:
        only = f" PARTITION ({_literals(table, within)})" if within else ""
        listed = self.spark.sql(f"SHOW PARTITIONS {self.name(table)}{only}").collect()
        return [_spec(row[0]) for row in listed]

    def months(self, table: Table) -> list[int]:
        """The report months a table holds, in order, from the catalog alone."""
        return sorted({int(spec[REPORT_MONTH]) for spec in self.partitions(table)})

    def stored_bytes(self, table: Table, months: list[int]) -> int:
        """The bytes of the files that hold some months, from a listing of their folders."""
        plan = in_months(self.table(table), months)._jdf.queryExecution().optimizedPlan()
        return int(str(plan.stats().sizeInBytes()))

    def replace_partitions(
        self,
        table: Table,
        rows: DataFrame | Iterable[DataFrame],
        scope: Iterable[PartitionSpec],
    ) -> Replaced:
        """Make `rows` the whole content of the partitions in `scope`.

        The rows are written to a fresh folder, which a job that fails leaves without effect.
        One commit then replaces all partitions at once, and the old files go last. Partitions
        of the scope that receive no row stay listed as empty ones, and are reported so that
        the caller can drop them when nothing needs them as a record any more.

        Each partition is gathered into files of the advisory size, and a hot one is split over
        several tasks, so the plan is the same for one partition and for thousands. Rows given
        in slices are written slice by slice, and only one of them has its shuffles on disk.
        """
        load = uuid.uuid4().hex
        files = Files(self.spark, self.location(table))
        try:
            slices = [rows] if isinstance(rows, DataFrame) else rows
            count = sum(self._write(table, some, f"{LOADS}/{load}") for some in slices)
        except Exception:
            files.delete(f"{LOADS}/{load}")
            raise
        written = files.matches(f"{LOADS}/{load}", "/".join(f"{c}=*" for c in table.partitions))
        held = set(written)
        emptied = [spec for spec in scope if _folder(table, spec) not in held]
        for spec in emptied:
            files.make(f"{LOADS}/{load}/{_folder(table, spec)}")
        folders = [*written, *(_folder(table, spec) for spec in emptied)]
        self._commit(table, dict.fromkeys(folders, load), [])
        return Replaced(count, [_spec(folder) for folder in written], emptied)

    def _write(self, table: Table, rows: DataFrame, folder: str) -> int:
        """Add rows to a folder of a table, laid out as the table is; return how many."""
        counted = Observation()
        typed = [F.col(c).cast(table.type_of(c)).alias(c) for c in table.column_order]
        placed = stamped(rows.select(*typed), table.file_options).hint(
            "rebalance", *table.partitions
        )
        with shuffles_freed(self.spark):
            (
                placed.observe(counted, F.count(F.lit(1)).alias("rows"))
                .sortWithinPartitions(*table.partitions, *table.clustering)
                .write.mode("append")
                .options(**table.file_options)
                .partitionBy(*table.partitions)
                .parquet(f"{self.location(table)}/{folder}")
            )
        return counted.get["rows"]

    def append(self, table: Table, rows: DataFrame) -> None:
        """Add rows to a table, matched by column name."""
        self.sync(table)
        rows.select(*table.column_order).write.insertInto(self.name(table), overwrite=False)

    def drop_partitions(self, table: Table, specs: Iterable[PartitionSpec]) -> None:
        """Remove partitions, files included, which DROP alone does not do for a table
        that has its own location. No Spark job runs, however many there are."""
        folders = [_folder(table, spec) for spec in specs]
        if folders:
            self._commit(table, {}, folders)

    def files(self, table: Table) -> DataFrame:
        """The files of a table from their footers, with the partition each belongs to.

        Row groups of a file should follow each other in the order of the clustering columns.
        """
        self.sync(table)
        state = Files(self.spark, self.location(table))
        loads = f"{self.location(table)}/{LOADS}"
        folders = [f"{loads}/{load}" for load in state.names(LOADS)]
        if not folders:
            state.make(LOADS)
        partition = F.regexp_extract("path", f"/{LOADS}/[^/]+/(.*)/[^/]+$", 1)
        found = footers(self.spark, folders or [loads], table.clustering)
        return found.withColumn("partition", partition)

    def columns(self) -> DataFrame:
        """Every column of every table: its declared type, the catalog's and that of the files.

        A column conforms if all three agree; partition columns are not in the files, and a table
        without files has no stored types. Only names and types pass through the driver.
        """
        sides = []
        for table in TABLES:
            label, declared = f"{table.layer}.{table.name}", dict(table.columns)
            known = {one.name: one for one in self.spark.catalog.listColumns(self.name(table))}
            for name in dict.fromkeys([*declared, *known]):
                found = known.get(name)
                partition = found.isPartition if found else name in table.partitions
                kind = found.dataType if found else None
                sides.append((label, name, declared.get(name), kind, partition))
        schema = (
            "table_name string, column_name string, declared_type string,"
            " catalogued_type string, is_partition boolean"
        )
        stored = None
        for table in TABLES:
            one = (
                self.files(table)
                .select("row_count", F.explode("columns").alias("column"))
                .groupBy(F.col("column.name").alias("column_name"))
                .agg(
                    F.array_join(F.sort_array(F.collect_set("column.type")), "|").alias("stored_type"),
                    F.sum("row_count").alias("stored_rows"),
                )
                .withColumn("table_name", F.lit(f"{table.layer}.{table.name}"))
            )
            stored = one if stored is None else stored.unionByName(one)
        both = self.spark.createDataFrame(sides, schema).join(
            stored, ["table_name", "column_name"], "full"
        )
        declared = F.col("declared_type")
        agree = declared.eqNullSafe(F.col("catalogued_type")) & declared.isNotNull()
        in_files = F.col("stored_type").isNull() | (F.col("stored_type") == declared)
        return both.withColumn("conforms", agree & F.coalesce(in_files, F.lit(False)))

    def truncate(self, table: Table) -> None:
        """Empty a table and forget its partitions."""
        self._write_nothing(table, "overwrite")
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")
        self._create(table)


def scratch_lake(spark: SparkSession) -> Lake:
    """A lake of its own in the shared folder of the cluster, for trials and checks."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        shared = tempfile.gettempdir()
    tag = uuid.uuid4().hex[:12]
    lake = Lake(spark, f"{shared.rstrip('/')}/reledger-{tag}", prefix=f"trial_{tag}_")
    lake.ensure_tables(attach=False)
    return lake


def _commit_numbers(files: Files) -> list[int]:
    return [int(name) for name in files.names(COMMITS) if name.isdigit()]


def _read_commit(files: Files, number: int) -> dict:
    return json.loads(files.read(f"{COMMITS}/{number:012d}"))


def _write_commit(
    files: Files, number: int, placed: dict[str, str], dropped: list[str]
) -> None:
    text = json.dumps({"placed": placed, "dropped": dropped})
    files.publish(f"{COMMITS}/{number:012d}", text)


def _state(commits: Iterable[dict]) -> dict[str, str]:
    """The load that holds each partition after some commits, in order."""
    state: dict[str, str] = {}
    for commit in commits:
        state.update(commit["placed"])
        for folder in commit["dropped"]:
            state.pop(folder, None)
    return state


def _folder(table: Table, spec: PartitionSpec) -> str:
    return "/".join(f"{column}={spec[column]}" for column in table.partitions)


def _spec(folder: str) -> PartitionSpec:
    pairs = (part.split("=", 1) for part in folder.split("/"))
    return {column: unquote(value) for column, value in pairs}


def _literals(table: Table, spec: PartitionSpec) -> str:
    quote = {"int": "{}={}", "date": "{}=DATE'{}'"}
    return ", ".join(
        quote.get(table.type_of(column), "{}='{}'").format(column, value)
        for column, value in spec.items()
    )
