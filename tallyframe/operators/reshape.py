"""Reshape operators (R1-R6): wide <-> long, ragged groups, matrices, unions.

All are single narrow projections (generators / unpivot) except the pivot,
which is one aggregation with explicit column values (no extra job to
discover them).
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def melt_pairs(df: DataFrame, ids: Sequence[str], pairs: Sequence[tuple[str, str, str | None]],
               label_col: str = "label", votes_col: str = "votes_raw",
               share_col: str = "share_raw") -> DataFrame:
    """(label, votes column, share column or None) triples -> long rows, one generator."""
    if not pairs:
        return df.select(*ids, F.lit(None).cast("string").alias(label_col),
                         F.lit(None).cast("string").alias(votes_col),
                         F.lit(None).cast("string").alias(share_col)).where(F.lit(False))
    structs = [F.struct(F.lit(label).alias(label_col),
                        F.col(v).cast("string").alias(votes_col),
                        (F.col(s).cast("string") if s else F.lit(None).cast("string")).alias(share_col))
               for label, v, s in pairs]
    return df.select(*ids, F.inline(F.array(*structs)))


def melt_measures(df: DataFrame, ids: Sequence[str], cols: Sequence[str],
                  label_col: str = "label", value_col: str = "raw", labels: Sequence[str] | None = None) -> DataFrame:
    """R2: single-measure columns -> (label, raw) rows.  Nulls are kept (filter later).

    ``labels`` are the rows' labels in the order of ``cols`` (default: the column names).
    """
    if labels is not None:
        cells = [F.struct(F.lit(n).alias(label_col), F.col(f"`{c}`").cast("string").alias(value_col)) for n, c in zip(labels, cols, strict=True)]
        none = F.array().cast(f"array<struct<{label_col}:string,{value_col}:string>>")
        return df.select(*ids, F.inline(F.array(*cells) if cells else none))
    narrow = df.select(*ids, *[F.col(c).cast("string").alias(c) for c in cols])
    return narrow.unpivot(list(ids), list(cols), label_col, value_col)


def explode_groups(df: DataFrame, tokens: str, start: Column | int, stride: int,
                   fields: dict[str, int], ids: Sequence[str], keep: Callable[[Column], Column] | None = None,
                   ) -> DataFrame:
    """Repeated fixed-width groups in a token array -> one row per group.

    Group i covers tokens[start + i*stride ...]; a group is complete when the
    token at the largest used offset exists (truncated tail groups are dropped);
    `keep` filters groups (e.g. blank panel).
    """
    return df.select(*ids, F.inline(group_array(tokens, start, stride, fields, keep)))


def group_count(tokens: str, start: Column | int, stride: int, need: int) -> Column:
    """Number of complete groups of a token array: those whose token at offset `need` exists."""
    start_c = start if isinstance(start, Column) else F.lit(start)
    return F.greatest(F.lit(0), F.floor((F.size(F.col(tokens)) - start_c - need - 1) / stride) + 1)


def group_array(tokens: str, start: Column | int, stride: int, fields: dict[str, int],
                keep: Callable[[Column], Column] | None = None) -> Column:
    """The complete, kept groups of a token array as an array of structs (see explode_groups)."""
    arr = F.col(tokens)
    start_c = start if isinstance(start, Column) else F.lit(start)
    n_groups = group_count(tokens, start, stride, max(fields.values()))
    idx = F.sequence(F.lit(0), n_groups - 1)

    def group(i):
        base = start_c + i * stride
        return F.struct(*[F.element_at(arr, (base + off + 1).cast("int")).alias(name)
                          for name, off in fields.items()])

    groups = F.transform(F.when(n_groups > 0, idx).otherwise(F.array().cast("array<int>")), group)
    if keep is not None:
        groups = F.filter(groups, keep)
    return groups


def melt_periods(df: DataFrame, ids: Sequence[str], period_cols: Sequence[str],
                 period_col: str = "year", value_col: str = "raw") -> DataFrame:
    """A<yyyy> columns -> (year, raw); the year comes from the column name."""
    long = melt_measures(df, ids, period_cols, "__period", value_col)
    return long.withColumn(period_col, F.substring("__period", 2, 4).cast("int")).drop("__period")


def pivot_matrix(df: DataFrame, row: str, col: str, val: str, col_values: Sequence,
                 row_order: DataFrame | None = None) -> DataFrame:
    """Rows x explicit columns matrix; optional driving row list (missing -> null row).

    A (row, col) pair that occurs twice is an error: the aggregate checks it while it runs, so
    it costs no extra pass.
    """
    one = F.when(F.count(F.lit(1)) <= 1, F.max(val)).otherwise(
        F.raise_error(F.concat(F.lit(f"more than one row for a cell of {row} x {col}: "), F.max(F.col(row)).cast("string"))))
    cells = df.groupBy(row, col).agg(one.alias("__cell"))
    m = cells.groupBy(row).pivot(col, list(col_values)).agg(F.max("__cell"))
    m = m.toDF(row, *[str(v) for v in col_values])
    if row_order is not None:
        m = row_order.select(row).join(m, row, "left")
    return m


def sparse_matrix(df: DataFrame, row: str, col: str, val: str, row_order: DataFrame | None = None) -> DataFrame:
    """R5 for any number of columns: (row, cells), cells being an array of (column, value) ordered by column.

    One aggregation, whose plan doesn't grow with the columns; a row's array has at most one entry per column of the matrix.  A
    (row, col) pair that occurs twice is an error, as in ``pivot_matrix``; rows of `row_order` without data have no cells.
    """
    one = F.when(F.count(F.lit(1)) <= 1, F.max(val)).otherwise(
        F.raise_error(F.concat(F.lit(f"more than one row for a cell of {row} x {col}: "), F.max(F.col(row).cast("string")))))
    cells = df.groupBy(row, col).agg(one.alias("__cell"))
    m = cells.groupBy(row).agg(F.array_sort(F.collect_list(F.struct(F.col(col).alias("column"), F.col("__cell").alias("value")))).alias("cells"))
    if row_order is not None:
        m = row_order.select(row).join(m, row, "left").withColumn("cells", F.coalesce("cells", F.array().cast(m.schema["cells"].dataType)))
    return m


def matrix_columns(df: DataFrame, col: str) -> Column:
    """The sorted distinct columns of a matrix, as one array (a scalar subquery)."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().agg(F.array_sort(F.collect_list(col))).scalar()


def sparse_cells(matrix: DataFrame, row: str, col: str, val: str, columns: Column | None = None) -> DataFrame:
    """(row, col, val) of a sparse matrix; with `columns`, its empty cells too (val null)."""
    cells = F.col("cells")
    if columns is not None:
        matrix = matrix.withColumn("__columns", columns)
        element = matrix.schema["cells"].dataType.elementType
        present = F.transform("cells", lambda x: x["column"])
        empty = F.transform(F.array_except("__columns", present), lambda c: F.struct(
            c.alias("column"), F.lit(None).cast(element["value"].dataType).alias("value")))
        cells = F.concat(cells, empty)
    return matrix.select(row, F.inline(cells)).toDF(row, col, val)


def union_sources(dfs: Sequence[DataFrame]) -> DataFrame:
    """Union into canonical columns by name."""
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
