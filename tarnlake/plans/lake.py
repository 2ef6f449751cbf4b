"""The layers of a lake: dimensions, and bronze, silver and gold for each feed."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tarnlake.functions import with_lineage
from tarnlake.operators.gold import (
    customer_line_totals,
    monthly_product_count,
    purchase_value,
    quarter_quantities_by_product,
    quarter_quantities_by_product_key,
)
from tarnlake.operators.history import enrich_as_of, first_states, next_states
from tarnlake.operators.roles import enrich
from tarnlake.operators.sketches import Profile, audit_commits, measure_quantiles
from tarnlake.operators.skew import HotKeys
from tarnlake.operators.tables import create_gold, quoted, stage_dim, write_dim
from tarnlake.operators.versions import Check, Version, publish_all, roll_back, unique_key
from tarnlake.plans.star import (
    DIMENSION_KEYS,
    GOLD_MONTHLY_ORDERS,
    GOLD_PRODUCT_ORDERS,
    GOLD_PURCHASE_VALUE,
    GOLD_QUARTER_QUANTITIES,
    INVENTORY_TRANSACTIONS,
    ORDERS,
    PURCHASE_ORDERS,
    Feed,
)
from tarnlake.plans.workspace import exists, remove, stored
from tarnlake.sources import infer_schema_once
from tarnlake.sources.schema_log import SchemaLog, as_one, filled_back
from tarnlake.streaming import (
    Ledger,
    append_once,
    append_stream,
    complete_stream,
    dead_letters,
    replay_as_csv,
    stream_json,
    stream_table,
    update_stream,
)
from tarnlake.streaming.ingest import FILES_PER_BATCH, RESCUED_COLUMN
from tarnlake.streaming.segments import COMPACT_AFTER

#: Bronze files whose rows are met with dimensions, and shuffled where these are large, at once.
FILES_PER_JOIN = 100


def _named(name: str, check: Check) -> Check:
    """``check``, saying which dimension it refuses."""

    def named(staged: DataFrame, current: DataFrame | None) -> None:
        try:
            check(staged, current)
        except ValueError as error:
            raise ValueError(f"{name} is refused: {error}") from error

    return named


@dataclass(frozen=True)
class Lake:
    """A database and the shared folder that holds its tables and checkpoints.

    Every method is one bounded, restartable step and returns the table it filled.
    Names are always qualified, so the session's current database does not matter; temp
    views carry the database in their name. ``gold_max_files`` bounds the micro-batches of
    the streamed gold, each of which writes the whole result: by default a run is one.
    ``silver_max_files`` bounds those of silver further than ``max_files`` does, as a
    micro-batch's rows lie on disk once more while they are shuffled to large dimensions.
    """

    spark: SparkSession
    database: str
    root: str
    fmt: str = "parquet"
    max_files: int | None = FILES_PER_BATCH
    gold_max_files: int | None = None
    silver_max_files: int | None = FILES_PER_JOIN

    def create(self, comment: str = "Lakehouse tables") -> Lake:
        self.spark.sql(
            f"CREATE DATABASE IF NOT EXISTS {self.database} "
            f"COMMENT {quoted(comment)} LOCATION {quoted(self.root + '/tables')}"
        )
        return self

    def drop(self) -> None:
        """Delete the database and everything under the lake's folder."""
        self.spark.sql(f"DROP DATABASE IF EXISTS {self.database} CASCADE")
        remove(self.spark, self.root)

    def qualified(self, table: str) -> str:
        return f"{self.database}.{table}"

    def table(self, name: str) -> DataFrame:
        return self.spark.table(self.qualified(name))

    def dims(self) -> dict[str, DataFrame]:
        """The loaded dimensions, as they are now."""
        return {
            name: self.table(name)
            for name in DIMENSION_KEYS
            if self.spark.catalog.tableExists(self.qualified(name))
        }

    def _stream_folders(self, feed: Feed, layer: str) -> dict[str, str]:
        # Data, checkpoint and schema never nest in each other.
        base = f"{self.root}/{feed.name}/{layer}"
        return {"path": f"{base}/data", "checkpoint": f"{base}/checkpoint"}

    def view(self, name: str) -> str:
        """Name of a temp view of this lake."""
        return f"{self.database}_{name}"

    def load_dims(
        self, dims: Mapping[str, DataFrame], unique: bool = True, checks: Mapping[str, Sequence[Check]] | None = None
    ) -> dict[str, DataFrame]:
        """Replace the given dimension tables in full, all of them or none.

        Every dimension is written beside the rows in use and checked there: its key must be
        unique, unless told not to check, and ``checks`` must pass. Only then are the
        tables pointed at the new rows; what broke off or was refused changes nothing.
        """
        staged: list[Version] = []
        try:
            for name, df in dims.items():
                staged.append(stage_dim(df, self.qualified(name), self.fmt, self._dim_folder(name)))
        except BaseException:
            for version in staged:
                version.discard()
            raise
        loads = [
            (version, [*([_named(name, unique_key(DIMENSION_KEYS[name]))] if unique else []), *(checks or {}).get(name, ())])
            for name, version in zip(dims, staged, strict=True)
        ]
        return dict(zip(dims, publish_all(loads, [f"Dimension {name}" for name in dims]), strict=True))

    def note_dims(self, at: datetime | None = None) -> dict[str, DataFrame]:
        """Add the dimensions as they are now to their histories, as of ``at`` (by default now).

        Call it after ``load_dims`` and before the next silver run.
        """
        at = at or datetime.now(timezone.utc)
        noted = {}
        for name, dim in self.dims().items():
            table, key = self.qualified(f"{name}_history"), DIMENSION_KEYS[name]
            known = self.spark.catalog.tableExists(table)
            states = next_states(self.spark.table(table), dim, key, at) if known else first_states(dim, at)
            noted[name] = write_dim(states, table, self.fmt, f"{self.root}/histories/{name}", f"States of {name}")
        return noted

    def rebuilt_silver(self, feed: Feed, time: str = "receipt_time") -> DataFrame:
        """Silver made again from all bronze rows, with the dimensions as they were at ``time``.

        That is what ``silver`` made if it ran before dimensions changed again after the receipt.
        """
        bronze = self.table(feed.bronze_table)
        histories = {role.dim: self.table(f"{role.dim}_history") for role in feed.roles}
        return enrich_as_of(bronze, histories, feed.roles, time, feed.silver_columns)

    def roll_back_dim(self, name: str) -> DataFrame:
        """The dimension as it was before its last load."""
        return roll_back(self.spark, self.qualified(name), self._dim_folder(name), self.fmt)

    def roll_back_gold(self, table: str) -> DataFrame:
        """A gold table as it was before its last build; not for one kept up by a stream."""
        return roll_back(self.spark, self.qualified(table), f"{self.root}/gold/{table}", self.fmt)

    def _dim_folder(self, name: str) -> str:
        return f"{self.root}/dimensions/{name}"

    def bronze(
        self,
        feed: Feed,
        landing: str,
        multi_line: bool = True,
        schema: str | StructType | None = None,
        once: bool = False,
        **options: str,
    ) -> DataFrame:
        """Append newly landed records, unfiltered, with their lineage.

        With ``once`` a ledger beside the table keeps a file from being added twice even if
        the checkpoint is lost. A table is filled with it always or never.

        Fields that the schema lacks and values that do not fit it are kept in
        ``_rescued``. ``schema`` is the feed's own unless given; ``inferred`` gives one.
        """
        raw = stream_json(
            self.spark, landing, schema or feed.schema, multi_line, self.max_files,
            view=self.view(f"{feed.name}_raw"), rescue=True, **options,
        )
        rows, table, folders = with_lineage(raw), self.qualified(feed.bronze_table), self._stream_folders(feed, "bronze")
        if once:
            return append_once(rows, table, folders["checkpoint"], self.ledger(feed))
        return append_stream(rows, table, fmt=self.fmt, **folders)

    def ledger(self, feed: Feed) -> Ledger:
        """The source files that the feed's bronze table holds, if it is filled ``once``."""
        base = f"{self.root}/{feed.name}/bronze"
        profile = Profile(StructType.fromDDL(feed.schema).names[0], feed.measures)
        return Ledger(self.spark, f"{base}/ledger", f"{base}/data", self.fmt, profile)

    def audit_once(self, feed: Feed, exact: bool = True) -> DataFrame:
        """The audit of a bronze table filled ``once``: from its commits' notes, not its rows."""
        return audit_commits(self.ledger(feed), feed.bronze_table, exact)

    def quantiles(self, feed: Feed, fractions: Sequence[float]) -> DataFrame:
        """Quantiles of the measures of a bronze table filled ``once``, from its commits' notes."""
        return measure_quantiles(self.ledger(feed), fractions)

    def dead_letters(self, feed: Feed) -> DataFrame:
        """Landed files of a feed, filled ``once``, with records that did not parse, and what was done about them."""
        return dead_letters(self.table(feed.bronze_table), self.ledger(feed))

    def salvage(self, feed: Feed, schema: str | StructType | None = None, **options: str) -> int:
        """Append what dead letters hold that are CSV files in truth; returns how many those were.

        A file is replayed once, whenever this is called and whatever stopped an earlier call.
        """
        bronze, key = self.table(feed.bronze_table), StructType.fromDDL(feed.schema).names[0]
        replayed = replay_as_csv(bronze, self.ledger(feed), schema or feed.schema, key, **options)
        self.spark.catalog.refreshTable(self.qualified(feed.bronze_table))
        return replayed

    def bronze_following(
        self, feed: Feed, landing: str, multi_line: bool = True, pinned: Collection[str] | None = None, **options: str
    ) -> DataFrame:
        """As ``bronze`` with ``once``, but the schema follows what lands; returns ``followed``.

        The feed's schema is the first version. What a delivery brings beyond the version it is
        read with is kept in ``_rescued``; after the run it makes the next version, with which
        the next start reads. Rows of each version lie in a folder of their own, so none is
        written again. Keys of roles and of the feed keep their types, unless ``pinned``
        names others: their misfits stay in ``_rescued``.
        """
        log = self.schema_log(feed)
        if log.latest() is None:
            log.append(StructType.fromDDL(feed.schema))
        number, schema = log.latest()
        if pinned is None:
            pinned = {StructType.fromDDL(feed.schema).names[0], *(role.fact_key for role in feed.roles)}
        raw = stream_json(
            self.spark, landing, schema, multi_line, self.max_files,
            view=self.view(f"{feed.name}_raw"), rescue=True, **options,
        )
        ledger = self._ledger_of(feed, number)
        table = self.qualified(f"{feed.bronze_table}_v{number}")
        append_once(with_lineage(raw), table, f"{self._followed_folder(feed)}/checkpoint", ledger)
        last = ledger.last()
        log.follow(schema, ledger.committed_after(log.seen()), RESCUED_COLUMN, pinned)
        log.see(last)
        return self.followed(feed)

    def followed(self, feed: Feed) -> DataFrame:
        """Rows of all versions with the latest schema, filled back out of what was kept beside them.

        Also the view ``<feed>_followed``. Only rows of earlier versions pay for it.
        """
        versions = self.schema_log(feed).versions()
        latest = versions[max(versions)]
        parts = []
        for number in versions:
            ledger = self._ledger_of(feed, number)
            if exists(self.spark, ledger.data):
                rows = self.spark.read.format(self.fmt).load(ledger.data)
                parts.append(filled_back(rows, latest, RESCUED_COLUMN))
        rows = as_one(parts)
        rows.createOrReplaceTempView(self.view(f"{feed.name}_followed"))
        return rows

    def schema_log(self, feed: Feed) -> SchemaLog:
        return SchemaLog(self.spark, f"{self._followed_folder(feed)}/schemas")

    def _followed_folder(self, feed: Feed) -> str:
        return f"{self.root}/{feed.name}/followed"

    def _ledger_of(self, feed: Feed, version: int) -> Ledger:
        # One ledger for all versions, so that a file counts once, whatever it was read with.
        base = self._followed_folder(feed)
        return Ledger(self.spark, f"{base}/ledger", f"{base}/data/version-{version:09d}", self.fmt)

    def inferred(self, feed: Feed, landing: str, multi_line: bool = True, **options: str) -> StructType:
        """The schema of what first landed, with the feed's own types where it names a field."""
        store = f"{self.root}/{feed.name}/schema"
        return infer_schema_once(self.spark, landing, store, feed.schema, multi_line, **options)

    def enriched(
        self,
        feed: Feed,
        hot: Mapping[str, HotKeys] | None = None,
        columns: Sequence[str] | None = None,
    ) -> DataFrame:
        """The silver rows (or some columns of them) of new bronze rows, as a stream."""
        files = min((n for n in (self.max_files, self.silver_max_files) if n is not None), default=None)
        bronze = stream_table(self.spark, self.qualified(feed.bronze_table), files)
        silver = enrich(bronze, self.dims(), feed.roles, columns or feed.silver_columns, hot)
        silver.createOrReplaceTempView(self.view(f"{feed.silver_table}_stream"))
        return silver

    def silver(
        self,
        feed: Feed,
        hot: Mapping[str, HotKeys] | None = None,
        partition_by: Sequence[str] = (),
    ) -> DataFrame:
        """Append new bronze rows, enriched with the dimensions as of this run."""
        return append_stream(
            self.enriched(feed, hot),
            self.qualified(feed.silver_table),
            fmt=self.fmt,
            partition_by=partition_by,
            **self._stream_folders(feed, "silver"),
        )

    def gold_monthly_orders(self, by_year: bool = False, **layout: Sequence) -> DataFrame:
        """Order lines counted per customer and month name."""
        silver = self.table(ORDERS.silver_table)
        return self._gold(monthly_product_count(silver, by_year), GOLD_MONTHLY_ORDERS, **layout)

    def gold_product_orders(self, share: float = 1e-5, **layout: Sequence) -> DataFrame:
        """Order lines, each with the line count of its customer."""
        counts = f"{self.root}/gold/{GOLD_PRODUCT_ORDERS}-counts-{uuid4().hex[:12]}"
        totals = customer_line_totals(
            self.table(ORDERS.silver_table), keep=lambda df: stored(df, counts), share=share
        )
        gold = self._gold(totals, GOLD_PRODUCT_ORDERS, **layout)
        remove(self.spark, counts)
        return gold

    def gold_purchases(self, **layout: Sequence) -> DataFrame:
        """Purchase value per supplier and product at current names and prices."""
        silver = self.table(PURCHASE_ORDERS.silver_table)
        return self._gold(purchase_value(silver, self.dims()), GOLD_PURCHASE_VALUE, **layout)

    def quantities_by_key(self) -> DataFrame:
        """Quantity by created quarter, type and product key, as a stream of bronze keys.

        Only the calendar is joined below the aggregate. Products are met by its groups, so
        one with any share of the lines is a partial sum per task.
        """
        bronze = stream_table(
            self.spark, self.qualified(INVENTORY_TRANSACTIONS.bronze_table), self.gold_max_files
        )
        return quarter_quantities_by_product_key(bronze, self.dims())

    def gold_inventory(self) -> DataFrame:
        """Quantity per quarter, type and product, kept up by a complete-mode stream.

        Lines of unknown products, which silver has not, are left out with their groups.
        """
        dims = self.dims()
        base = f"{self.root}/{INVENTORY_TRANSACTIONS.name}/gold"
        return complete_stream(
            self.quantities_by_key(),
            self.qualified(GOLD_QUARTER_QUANTITIES),
            checkpoint=f"{base}/checkpoint",
            path=f"{base}/data",
            finish=lambda keyed: quarter_quantities_by_product(keyed, dims, "inner"),
            fmt=self.fmt,
        )

    def gold_inventory_changes(self, compact_after: int = COMPACT_AFTER) -> DataFrame:
        """As ``gold_inventory``, but each run writes the groups that changed and readers merge them.

        Products are met by the merged groups when the result is read, at their current names.
        """
        base = f"{self.root}/{INVENTORY_TRANSACTIONS.name}/gold-changes"
        keyed = self.quantities_by_key()
        keys = [name for name in keyed.columns if name != "quantity"]
        merged = update_stream(
            keyed, f"{base}/data", f"{base}/checkpoint", keys, self.fmt, compact_after, self.view(GOLD_QUARTER_QUANTITIES)
        )
        return quarter_quantities_by_product(merged, self.dims(), "inner")

    def _gold(self, df: DataFrame, table: str, **layout: Sequence) -> DataFrame:
        return create_gold(df, self.qualified(table), self.fmt, f"{self.root}/gold/{table}", **layout)
