"""Staged tables of one ledger: raw snapshot, cleaned ledger, core and marts.

Each stage is a written Parquet table in the shared scratch folder, so later stages start from
files instead of a long lineage and survive lost executors.  A stage is written once per
application and input folder.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from ..operators import cleaning, core, marts
from ..schema import CORE_TABLES, DEFAULT_SOURCE_SYSTEM
from ..session import STAGED_CODEC, drop_scratch, limit_splits, scratch_dir, shuffles_released
from ..sources import adapter, sheets
from ..sources.fingerprint import ledger_fingerprint

# Snapshot day for the adapted order tables: the day after the last possible order.
REFERENCE_DATE = date(2001, 8, 2)

MART_ORDER = {
    "mart_daily_sales": ["calendar_day", "country"],
    "mart_customer_daily": ["calendar_day"],
    "mart_customer_snapshot": ["primary_country"],
}
MARTS = list(MART_ORDER)


def _ledger(placed: DataFrame) -> DataFrame:
    return adapter.ledger_columns(placed).withColumnsRenamed(
        {
            "invoice": "Invoice",
            "stock_code": "StockCode",
            "description": "Description",
            "quantity": "Quantity",
            "invoice_date": "InvoiceDate",
            "price": "Price",
            "customer_id": "Customer ID",
            "country": "Country",
        }
    )


class Warehouse:
    """Lazily staged tables; every attribute access returns a DataFrame over written files."""

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        *,
        source_system: str = DEFAULT_SOURCE_SYSTEM,
        reference_date: date = REFERENCE_DATE,
        root: str | None = None,
    ):
        self.spark = spark
        limit_splits(spark)
        self.folder = folder
        self.source_system = source_system
        self.reference_date = reference_date
        label = hashlib.sha256(folder.encode()).hexdigest()[:12]
        self.root = root or f"{scratch_dir(spark)}/ledgerloom/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:8]}"
        # Staged files never change, so one opened DataFrame per table serves every query.
        self._frames: dict[str, DataFrame] = {}
        self._fingerprint: str | None = None

    # -- raw and clean ------------------------------------------------------------------

    def raw(self) -> DataFrame:
        path = f"{self.root}/raw"
        if "raw" not in self._frames:
            with shuffles_released(self.spark):
                rows = adapter.line_count(self.spark, self.folder)
                placed = adapter.placed_lines(self.spark, self.folder, sheets.snapshot_tasks(self.spark, rows))
                sheets.write_raw_snapshot(placed, path, adapter.SOURCE_ORDER, rows, task="task", parted=True, finish=_ledger)
            folders = sheets.snapshot_sheets(path, adapter.SHEETS)
            self._frames["raw"] = sheets.read_sheets(self.spark, folders, snapshot=True)
        return self._frames["raw"]

    def fingerprint(self) -> str:
        if self._fingerprint is None:
            with shuffles_released(self.spark):
                self._fingerprint = ledger_fingerprint(self.raw()).first()["sha256"]
        return self._fingerprint

    def stage(self, name: str, build, sort_by: list[str] = ()) -> DataFrame:
        """Write a table once and read it back.

        ``sort_by`` orders rows inside each task's files only (no shuffle), so that row groups
        cover narrow ranges and later filters on these columns skip most of them.
        """
        if name not in self._frames:
            path = f"{self.root}/{name}"
            with shuffles_released(self.spark):
                frame = build()
                if sort_by:
                    frame = frame.sortWithinPartitions(*sort_by)
                frame.write.mode("overwrite").option(*STAGED_CODEC).parquet(path)
            # The known schema saves the job that would infer it from file footers.
            self._frames[name] = self.spark.read.schema(frame.schema).parquet(path)
        return self._frames[name]

    def clean(self) -> DataFrame:
        if "clean" not in self._frames:
            with shuffles_released(self.spark):
                self._frames["clean"] = cleaning.write_clean_ledger(self.raw(), f"{self.root}/clean")
        return self._frames["clean"]

    # -- core and marts -----------------------------------------------------------------

    def core(self) -> dict[str, DataFrame]:
        missing = [name for name in CORE_TABLES if name not in self._frames]
        if missing:
            self._inputs()
            self._together(*[lambda name=name: self.table(name) for name in missing])
        return {name: self.table(name) for name in CORE_TABLES}

    def _inputs(self) -> tuple[DataFrame, str]:
        """The cleaned ledger and the fingerprint; both start from the raw snapshot."""
        self.raw()
        self._together(self.clean, self.fingerprint)
        return self.clean(), self.fingerprint()

    def _together(self, *steps: Callable) -> None:
        """Run steps that do not wait for each other, so that one's last tasks leave no core idle."""
        with ThreadPoolExecutor(len(steps)) as pool:
            for step in [pool.submit(inheritable_thread_target(self.spark)(step)) for step in steps]:
                step.result()

    def stored_core(self) -> dict[str, DataFrame]:
        """The core tables opened with the schema that their files have, not the declared one."""
        self.core()
        return {name: self.spark.read.parquet(f"{self.root}/{name}") for name in CORE_TABLES}

    def close(self) -> None:
        """Remove this run's staged tables; the folder is this warehouse's own."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
        drop_scratch(self.spark)
        self._frames.clear()
        _OPEN.pop((self.spark.sparkContext.applicationId, self.folder), None)

    def table(self, name: str) -> DataFrame:
        if name in MARTS:
            # The lines are summed per customer and day once for two marts.
            daily = self.table("mart_customer_daily") if name == "mart_customer_snapshot" else None
            return self.stage(name, lambda: self.build_mart(name, daily), MART_ORDER[name])
        builder = {
            "customers": core.build_customers,
            "products": core.build_products,
            "invoices": core.build_invoices,
            "invoice_lines": core.build_lines,
        }[name]

        def build() -> DataFrame:
            cleaned, fingerprint = self._inputs()
            return builder(cleaned, self.source_system, fingerprint)

        return self.stage(name, build)

    def register_views(self) -> None:
        """Expose core tables and marts to ``spark.sql`` under their own names."""
        self.core()
        for name in [*CORE_TABLES, *MARTS]:
            self.table(name).createOrReplaceTempView(name)

    def build_mart(self, name: str, daily: DataFrame | None = None) -> DataFrame:
        lines, invoices = self.table("invoice_lines"), self.table("invoices")
        if name == "mart_daily_sales":
            return marts.daily_sales(
                lines, invoices, self.table("products"), source_system=self.source_system
            )
        if name == "mart_customer_daily":
            return marts.customer_daily(lines, invoices, source_system=self.source_system)
        return marts.customer_snapshot(
            self.table("customers"),
            lines,
            invoices,
            reference_date=self.reference_date,
            source_system=self.source_system,
            daily=daily,
        )


_OPEN: dict[tuple, Warehouse] = {}


def warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """The application's warehouse for an input folder, staged on first use."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _OPEN:
        _OPEN[key] = Warehouse(spark, folder)
    return _OPEN[key]
