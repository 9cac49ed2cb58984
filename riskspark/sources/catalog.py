"""Logical table catalog.

Every analysis takes a ``Tables`` object and asks it for logical tables by
name (``tables["dim_user"]``).  A catalog is either a plain mapping of
DataFrames (unit tests, production tables) or a set of lazy builders (the
driver-data adapter), so an analysis only ever plans the scans it needs.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

LOGICAL_TABLES = (
    "dim_user", "audit_log", "fp_login_list", "ato_merchant", "employee", "credential",
    "daily_payment", "lifetime_payment", "fake_unit", "card_activity", "settlement_entry",
    "login_event", "page_click", "mobile_click", "legacy_activity", "chargeback", "fx_rate",
    "dispute", "risk_evaluation", "payment", "enrolled_merchant", "allowed_payment",
    "risk_alert", "merchant_signup", "dim_date", "user_segment", "page_view",
)


class Tables:
    """Logical name -> DataFrame, resolved lazily and memoised per catalog."""

    def __init__(self, spark: SparkSession,
                 frames: Mapping[str, DataFrame] | None = None,
                 builders: Mapping[str, Callable[["Tables"], DataFrame]] | None = None):
        self.spark = spark
        self._frames: dict[str, DataFrame] = dict(frames or {})
        self._builders = dict(builders or {})
        self._derived: dict = {}
        self._stages: list[str] = []
        self._stage_tables: list[str] = []

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name not in self._builders:
                raise KeyError(f"logical table {name!r} is not in this catalog")
            self._frames[name] = self._builders[name](self)
        return self._frames[name]

    def __contains__(self, name: str) -> bool:
        return name in self._frames or name in self._builders

    def derived(self, name: str, key, build: Callable[[], DataFrame]) -> DataFrame:
        """Memoised intermediate result ``name`` for parameter set ``key``.

        Analyses ask for shared intermediates through this, so one plan that
        reads an intermediate twice holds the same subtree twice (Spark then
        reuses its shuffles), and a caller can pre-set a materialised copy
        (see ``materialize``).
        """
        k = ("derived", name, key)
        if k not in self._derived:
            self._derived[k] = build()
        return self._derived[k]

    def materialize(self, name: str, key, build: Callable[[], DataFrame],
                    stage_root: str | None = None, by: str | None = None,
                    buckets: int | None = None) -> DataFrame:
        """Compute an intermediate once as a Parquet table under
        ``stage_root`` (default: the session's checkpoint directory; shared
        storage on a cluster, so it survives the loss of executors).  Later
        readers prune its columns and push their filters into it.
        ``drop_stages`` removes it.

        With ``by`` the table is bucketed and sorted by that column (into
        ``buckets``, default: the session's shuffle partitions): joins,
        groupings and windows on it need no shuffle of the staged side, and
        none at all where both sides are staged so.  Spark keeps buckets only
        in its catalog, so the table is registered in the current database
        until it is dropped.  ``by`` should have no hot value: here it is a
        key of which a table holds at most one row a day.
        """
        from ..session import ensure_checkpoint_dir, shared_path
        root = shared_path(self.spark, stage_root) if stage_root else ensure_checkpoint_dir(self.spark)
        df = self.derived(name, key, build)
        run = uuid.uuid4().hex
        path = f"{root}/stage-{name}-{run}"
        self._stages.append(path)
        if by is None:
            df.write.parquet(path)
            staged = self.spark.read.schema(df.schema).parquet(path)
        else:
            n = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            table = f"stage_{name}_{run}"
            self._stage_tables.append(table)
            # dealt as the buckets are, so that each bucket is one file
            (df.repartition(n, by).write.format("parquet").option("path", path)
             .bucketBy(n, by).sortBy(by).saveAsTable(table))
            staged = self.spark.table(table)
        self._derived[("derived", name, key)] = staged
        return staged

    def drop_stages(self) -> None:
        """Delete the tables ``materialize`` wrote and forget what was
        derived, so that later analyses do not read them."""
        from ..sinks import delete_path
        for table in self._stage_tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        for path in self._stages:
            delete_path(self.spark, path)
        self._stages.clear()
        self._stage_tables.clear()
        self._derived.clear()

    def drop_later(self, path: str) -> None:
        """Have ``drop_stages`` delete ``path`` too."""
        self._stages.append(path)

    def with_derived(self, frames: Mapping[tuple, DataFrame]) -> "Tables":
        """A copy of this catalog with the intermediates (name, key) of
        ``frames`` given; all others are derived anew from them."""
        out = Tables(self.spark, self._frames, self._builders)
        out._derived = {("derived", name, key): df for (name, key), df in frames.items()}
        return out

    def with_tables(self, **frames: DataFrame) -> "Tables":
        """A copy of this catalog with some logical tables replaced."""
        out = Tables(self.spark, self._frames, self._builders)
        out._frames.update(frames)
        out._derived = dict(self._derived)
        return out

    @classmethod
    def from_names(cls, spark: SparkSession, names: Mapping[str, str]) -> "Tables":
        """Catalog over metastore tables: logical name -> qualified table name."""
        return cls(spark, builders={k: (lambda t, v=v: t.spark.table(v)) for k, v in names.items()})

    @classmethod
    def from_parquet(cls, spark: SparkSession, paths: Mapping[str, str]) -> "Tables":
        """Catalog over parquet locations: logical name -> path."""
        return cls(spark, builders={k: (lambda t, v=v: t.spark.read.parquet(v)) for k, v in paths.items()})
