"""Where the tables live."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventmart.schemas import TABLES, TableSpec

BUCKET = "_bucket"


@dataclass(frozen=True)
class Table:
    """One stored table: its spec, its paths and its bucket count.

    Each run writes to a folder of its own below ``stage_path`` until its files move to ``path``.
    """

    name: str
    spec: TableSpec
    buckets: int
    path: str
    stage_path: str
    log_path: str

    @property
    def columns(self) -> list[str]:
        return list(self.spec.columns)

    @property
    def keys(self) -> list[str]:
        return list(self.spec.keys)

    @property
    def stored_ddl(self) -> str:
        return f"{self.spec.ddl}, {BUCKET} int"

    def bucket(self) -> Column:
        """The bucket of a row, from its key columns."""
        stripe = ", ".join(self.spec.stripe).format(buckets=self.buckets)
        return F.expr(f"cast(pmod(xxhash64({stripe}), {self.buckets}) as int)")


class Layout:
    """All tables below one root path on shared storage.

    ``buckets`` overrides the default bucket counts, with one number for all
    tables or a mapping by table name.  A table's count is fixed once it holds
    rows (``upsert`` refuses another one).  Choose it so that a bucket of the
    full-grown table is at most a few gigabytes: a bucket is the unit that incremental
    reads and merges prune to, though not a unit of parallelism, since large buckets are
    read and written by many tasks.
    """

    def __init__(self, root: str, buckets: int | Mapping[str, int] | None = None):
        self.root = root.rstrip("/")
        self.tables: dict[str, Table] = {}
        for name, spec in TABLES.items():
            count = buckets if isinstance(buckets, int) else (buckets or {}).get(name, spec.buckets)
            layer, short = name.split(".")
            self.tables[name] = Table(
                name=name,
                spec=spec,
                buckets=count,
                path=f"{self.root}/{layer}/{short}",
                stage_path=f"{self.root}/{layer}_staging/{short}_stage",
                log_path=f"{self.root}/merge_log/{layer}_{short}",
            )

    def rejects_path(self, name: str) -> str:
        """Where the lines of raw files that could not be read for a table are kept."""
        layer, short = name.split(".")
        return f"{self.root}/{layer}_rejects/{short}"

    def __getitem__(self, name: str) -> Table:
        return self.tables[name]
