"""Sinks (S6-S8): the 7-table snowflake warehouse, dashboard datasets, cleaned exports.

Each keyed load computes the next state as a DataFrame (anti-join + union, see
``operators.load``), cuts the lineage with a reliable checkpoint in the shared folder (the
next state is read from the very table it replaces), checks the constraints and only then writes.

Facts (results by election, indicator values by year) are partitioned, and a load reads, checks and
overwrites only the partitions it touches.  Dimensions are small: every load writes a
new version folder next to the old ones and readers take the newest complete one, so a
failed write leaves the table as it was.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as SC
from ..operators import load as L
from ..session import cut_lineage
from .schema import to_canonical

KEEP_VERSIONS = 2


class ConstraintError(RuntimeError):
    pass


class Warehouse:
    """Parquet warehouse rooted at `root` (a shared file system / object store path)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    # files -----------------------------------------------------------------
    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _folders(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []

    def _delete(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.delete(p, True)

    def _versions(self, name: str) -> list[str]:
        """Complete version folders, oldest first."""
        def complete(v: str) -> bool:
            fs, p = self._fs(f"{self.path(name)}/{v}/_SUCCESS")
            return fs.exists(p)

        return [v for v in self._folders(self.path(name)) if v.startswith("v") and complete(v)]

    # reading ---------------------------------------------------------------
    def read(self, name: str) -> DataFrame:
        t = SC.WAREHOUSE[name]
        if t.partition:
            where = self.path(name) if self._folders(self.path(name)) else None
        else:
            versions = self._versions(name)
            where = f"{self.path(name)}/{versions[-1]}" if versions else None
        if where is None:
            return self.spark.createDataFrame([], t.schema)
        return self.spark.read.schema(t.schema).parquet(where).select(*t.schema.names)

    # constraints -----------------------------------------------------------
    def check(self, name: str, df: DataFrame) -> None:
        """Primary key, natural keys, NOT NULL and foreign keys; raises before anything is written."""
        t = SC.WAREHOUSE[name]
        for key in (t.pk, *t.unique):
            if not L.pk_violations(df, key).isEmpty():
                raise ConstraintError(f"{name}: duplicate key {list(key)}")
        not_null = [f.name for f in t.schema.fields if not f.nullable]
        nulls = L.null_violations(df, not_null).first()
        bad = [c for c, n in zip(not_null, nulls) if n]
        if bad:
            raise ConstraintError(f"{name}: nulls in NOT NULL columns {bad}")
        for fk, dim, dim_key in t.fks:
            if not L.fk_violations(df, self.read(dim), list(fk), list(dim_key)).isEmpty():
                raise ConstraintError(f"{name}: rows without a {dim} row for {list(fk)}")

    # writing ---------------------------------------------------------------
    def _write_dimension(self, name: str, df: DataFrame) -> int:
        state = cut_lineage(to_canonical(df, SC.WAREHOUSE[name].schema))
        self.check(name, state)
        versions = self._versions(name)
        number = int(versions[-1][1:]) + 1 if versions else 1
        state.write.parquet(f"{self.path(name)}/v{number:08d}")
        for old in self._versions(name)[:-KEEP_VERSIONS]:
            self._delete(f"{self.path(name)}/{old}")
        return state.count()

    def _write_partitions(self, name: str, incoming: DataFrame, change: Callable[[DataFrame], DataFrame]) -> int:
        """Replace the partitions that ``incoming`` has rows of by ``change(their rows)``."""
        t = SC.WAREHOUSE[name]
        touched = cut_lineage(incoming.select(F.col(t.partition).cast(t.schema[t.partition].dataType)).distinct())
        current = self.read(name).join(touched, t.partition, "left_semi")  # prunes partitions at run time
        state = cut_lineage(to_canonical(change(current), t.schema))
        self.check(name, state)
        state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(t.partition).parquet(self.path(name))
        return state.count()

    def _load(self, name: str, incoming: DataFrame, change) -> int:
        """Rows in the written partitions (facts) or in the table (dimensions) after the load."""
        inc = cut_lineage(to_canonical(incoming, SC.WAREHOUSE[name].schema))
        if SC.WAREHOUSE[name].partition:
            return self._write_partitions(name, inc, lambda current: change(current, inc))
        return self._write_dimension(name, change(self.read(name), inc))

    # keyed loads -----------------------------------------------------------
    def insert_ignore(self, name: str, incoming: DataFrame) -> int:
        return self._load(name, incoming, lambda cur, inc: L.insert_ignore(cur, inc, SC.WAREHOUSE[name].pk))

    def upsert(self, name: str, incoming: DataFrame) -> int:
        return self._load(name, incoming, lambda cur, inc: L.upsert(cur, inc, SC.WAREHOUSE[name].pk))

    def replace_slice(self, name: str, incoming: DataFrame, inside: Column) -> int:
        """L4: in the incoming rows' partitions, rows ``inside`` the slice go and the incoming rows come."""
        return self._load(name, incoming,
                          lambda cur, inc: cur.where(~F.coalesce(inside, F.lit(False))).unionByName(inc))

    def get_or_create(self, name: str, incoming: DataFrame, nk: Sequence[str]) -> DataFrame:
        """L1: new members get ids; attributes beside the natural key come with them."""
        pk = SC.WAREHOUSE[name].pk[0]
        members = incoming.dropDuplicates(list(nk))
        state = L.assign_keys(self.read(name), members, nk, pk)
        self._write_dimension(name, state)
        return self.read(name)


def write_dashboard_tables(datasets: Mapping[str, DataFrame], root: str, fmt: str = "parquet",
                           sort_by: Mapping[str, Sequence[str]] | None = None) -> list[str]:
    """One folder per dashboard dataset (rendering is out of scope).

    O1: a dataset listed in `sort_by` is written range-sorted (nulls last), so its
    part files read back in order.
    """
    out = []
    for name, df in datasets.items():
        keys = (sort_by or {}).get(name)
        if keys:
            df = df.orderBy(*[F.col(k).asc_nulls_last() for k in keys])
        path = os.path.join(root, name)
        df.write.mode("overwrite").format(fmt).option("header", True).save(path)
        out.append(path)
    return out


def export_clean(df: DataFrame, path: str, fmt: str = "csv", partition_by: Sequence[str] = ()) -> None:
    """Cleaned dataset export (CSV with header, or Parquet)."""
    w = df.write.mode("overwrite").format(fmt).option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
