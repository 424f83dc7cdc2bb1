"""Publishing the four core tables per namespace, all or nothing, by any number of writers, on plain Parquet.

A publisher notes the version it starts from, writes its tables into a folder that nobody else has, and commits by creating the record
of the next version, which fails if that file exists. A record names its parent, namespace and folder. The published
versions are the chain of records in which each names the one before as its parent; a record that is cut short or whose
parent has been replaced is not part of it. So readers see the old or the new tables, a writer that dies leaves nothing visible and blocks
nobody, and of two writers that start from the same version one commits and the other gets ``PublicationConflict``.
"""

from __future__ import annotations

import json
import time
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import CORE_SCHEMAS, CORE_TABLES

_RECORD = "source_system string, version long, parent long, folder string, complete boolean"


class PublicationConflict(RuntimeError):
    """Another writer published the namespace in the meantime."""


class CoreStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # -- files ---------------------------------------------------------------------------

    def _files(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _create(self, path: str, text: str) -> bool:
        """Write a new file; False if it exists."""
        where, files = self._files(path)
        try:
            out = files.create(where, False)
        except Exception as error:
            if "AlreadyExists" in str(error) or "already exists" in str(error):
                return False
            raise
        out.write(bytearray(text.encode()))
        out.close()
        return True

    # -- log -----------------------------------------------------------------------------

    def _records(self) -> DataFrame:
        """One row per record file, cut ones included (with nulls)."""
        read = self.spark.read.schema(_RECORD).json(f"{self.root}/log/*")
        return read.select("*", F.regexp_extract("_metadata.file_path", r"/(\d+)\.json$", 1).cast("long").alias("number"))

    def _chains(self) -> tuple[dict[str, list], dict[str, int]]:
        """Published records per namespace, oldest first, and the highest number taken; one row per publication on the driver."""
        where, files = self._files(f"{self.root}/log")
        if not files.exists(where):
            return {}, {}
        taken: dict[str, int] = {}
        for status in files.listStatus(where):
            name = status.getPath().getName()
            for record in files.listStatus(status.getPath()):
                number = record.getPath().getName().removesuffix(".json")
                if number.isdigit():
                    taken[name] = max(taken.get(name, 0), int(number))
        chains: dict[str, list] = {}
        rows = self._records().where("complete").collect() if taken else []
        for row in sorted(rows, key=lambda r: (r.source_system, r.version)):
            chain = chains.setdefault(row.source_system, [])
            if row.parent == (chain[-1].version if chain else 0):
                chain.append(row)
        return chains, taken

    def current(self) -> dict[str, int]:
        """Published version per namespace."""
        return {system: chain[-1].version for system, chain in self._chains()[0].items()}

    # -- writing -------------------------------------------------------------------------

    def publish(
        self, core: dict[str, DataFrame], source_system: str, *, parent: int | None = None, fail_after: str | None = None
    ) -> dict[str, int]:
        """Replace one namespace; returns the row count of each table.

        ``parent`` is the version that the caller's tables were made from, by default the one published now.
        ``fail_after="write"`` raises between writing and publishing, for recovery tests.
        """
        if parent is None:
            parent = self.current().get(source_system, 0)
        folder = f"{uuid.uuid4().hex}"
        for table in CORE_TABLES:
            core[table].write.parquet(f"{self.root}/data/{folder}/{table}")
        if fail_after == "write":
            raise RuntimeError("stopped after writing, before publishing")
        counts = {table: self.spark.read.parquet(f"{self.root}/data/{folder}/{table}").count() for table in CORE_TABLES}
        chains, taken = self._chains()
        if (chains[source_system][-1].version if source_system in chains else 0) != parent:
            raise PublicationConflict(f"{source_system} is no longer at version {parent}")
        name = _folder_name(source_system)
        version = max(taken.get(name, 0), parent) + 1
        record = {"source_system": source_system, "version": version, "parent": parent, "folder": folder, "complete": True}
        created = self._create(f"{self.root}/log/{name}/{version}.json", json.dumps(record))
        # A writer whose record was under way when this one was numbered may have become the parent's successor.
        chain = self._chains()[0].get(source_system, [])
        if not created or not any(r.folder == folder for r in chain):
            raise PublicationConflict(f"{source_system} is no longer at version {parent}")
        return counts

    def clean_up(self, keep: int = 1, older_than: float = 86_400.0) -> list[str]:
        """Remove folders that none of the last ``keep`` versions of a namespace uses, once they are ``older_than`` seconds old."""
        used = {r.folder for chain in self._chains()[0].values() for r in chain[-keep:]}
        where, files = self._files(f"{self.root}/data")
        removed = []
        for status in files.listStatus(where) if files.exists(where) else []:
            name, age = status.getPath().getName(), time.time() - status.getModificationTime() / 1000
            if name not in used and age >= older_than:
                files.delete(status.getPath(), True)
                removed.append(name)
        return removed

    # -- reading -------------------------------------------------------------------------

    def table(self, table: str) -> DataFrame:
        """All published namespaces of a table."""
        parts = [
            self.spark.read.schema(CORE_SCHEMAS[table]).parquet(f"{self.root}/data/{chain[-1].folder}/{table}")
            for _, chain in sorted(self._chains()[0].items())
        ]
        if not parts:
            return self.spark.createDataFrame([], CORE_SCHEMAS[table])
        return reduce(lambda a, b: a.unionByName(b), parts)

    def core(self) -> dict[str, DataFrame]:
        return {table: self.table(table) for table in CORE_TABLES}


def _folder_name(source_system: str) -> str:
    """A namespace as a folder name: letters and digits as they are, all else by its code."""
    return "".join(c if c.isascii() and c.isalnum() else f"_{ord(c):x}_" for c in source_system)
