"""Least squares from one distributed Gram aggregate.

``gram`` sums, per group and pair of columns, the products of all rows in one pass: one exploded row
per pair, combined map-side, so that any number of groups and columns keeps six fixed-width sums per
(group, pair).  Integers and decimals are summed exactly (``scale``), so the result does not depend on partitions.
Everything else works on these few numbers: correlations, regressions on any subset of the columns, and, by prefix sums
over periods, the regressions of all expanding windows.

Missing cells count as the mean of their column in the training rows (their deviation is zero); a column without
variation, or that earlier columns explain up to ``TOLERANCE``, gets the coefficient 0.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A column whose share of variance not explained by the earlier ones is below this is left out.
TOLERANCE = 1e-8
_SUMS = ("__n", "__sx", "__sy", "__sxx", "__sxy", "__syy")


def gram(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), scale: int | None = None) -> DataFrame:
    """One row per group and pair (__i <= __j) of `columns`: count and sums over the rows that have both.

    With `scale`, values are summed exactly as decimals of that many places; without, as doubles.
    """
    kind = "double" if scale is None else f"decimal(18,{scale})"
    values = [F.col(c).cast(kind) if scale is not None else F.nanvl(F.col(c).cast(kind), F.lit(None)) for c in columns]
    flat = df.select(*by, *[v.alias(f"__v{i}") for i, v in enumerate(values)])
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]

    def cell(i, j):
        x, y = F.col(f"__v{i}"), F.col(f"__v{j}")
        return F.struct(F.lit(i).alias("__i"), F.lit(j).alias("__j"), F.when(y.isNotNull(), x).alias("__x"),
                        F.when(x.isNotNull(), y).alias("__y"))

    x, y = F.col("__x"), F.col("__y")
    total = [F.coalesce(F.sum(v), F.lit(0).cast(kind)) for v in (x, y, x * x, x * y, y * y)]
    return (flat.select(*by, F.inline(F.array(*[cell(i, j) for i, j in pairs])))
            .groupBy(*by, "__i", "__j").agg(F.count("__x").alias("__n"), *[t.alias(n) for t, n in zip(total, _SUMS[1:])]))


def expanding(sums: DataFrame, time_col: str, by: Sequence[str] = (), least: int = 2) -> DataFrame:
    """The sums of all earlier periods, for each period with at least `least` of them (one running sum per pair)."""
    earlier = Window.partitionBy(*by, "__i", "__j").orderBy(time_col).rowsBetween(Window.unboundedPreceding, -1)
    return (sums.select(*by, time_col, "__i", "__j", F.count(F.lit(1)).over(earlier).alias("__before"),
                        *[F.sum(c).over(earlier).alias(c) for c in _SUMS])
            .where(F.col("__before") >= least).drop("__before"))


def correlations(sums: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(x, y, n, corr) of every pair of columns, over the rows that have both (null without variation)."""
    n, sx, sy, sxx, sxy, syy = (F.col(c).cast("double") for c in _SUMS)
    vx, vy = sxx - sx * sx / n, syy - sy * sy / n
    names = F.array(*[F.lit(c) for c in columns])
    # what rounding leaves of a variance of zero is no variation
    enough = (F.col("__n") > 0) & (vx > 1e-12 * sxx) & (vy > 1e-12 * syy)
    return sums.where(F.col("__i") < F.col("__j")).select(
        *by, names[F.col("__i")].alias("x"), names[F.col("__j")].alias("y"), F.col("__n").alias("n"),
        F.when(enough, (sxy - sx * sy / n) / F.sqrt(vx * vy)).alias("corr"))


def _sweep(matrix: Column, size: int) -> Column:
    """Gauss-Jordan on (size) x (size + 1); a pivot within TOLERANCE of zero drops its variable."""
    def step(m: Column, k: Column) -> Column:
        pivot = m[k][k]

        def cell(row, i):
            return lambda v, j: (
                F.when(pivot < TOLERANCE, F.when((i == k) | (j == k), F.lit(0.0)).otherwise(v))
                .when(i == k, v / pivot).otherwise(v - row[k] * m[k][j] / pivot))

        return F.transform(m, lambda row, i: F.transform(row, cell(row, i)))

    return F.aggregate(F.sequence(F.lit(0), F.lit(size - 1)), matrix, step)


def fit(sums: DataFrame, columns: Sequence[str], by: Sequence[str] = (),
        models: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """M3: least squares of the last of `columns` on the others, for each group of `sums`.

    `models` names subsets of the columns; all are solved from the same sums.  Returns by, model, n,
    coef and mean (one entry per column, 0 where unused), intercept, rss, sst, n_coef.
    """
    features, k = list(columns[:-1]), len(columns) - 1
    models = models or {"linear": features}
    place = {}
    for i in range(k + 1):
        for j in range(i, k + 1):
            place[i, j] = len(place)
    cells = sums.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("__i", "__j", *_SUMS))).alias("__c"))  # (k+1)(k+2)/2 cells

    def cell(i, j, c):
        return F.col("__c")[place[i, j]][c].cast("double")

    cells = cells.where(F.get("__c", F.lit(place[k, k]))["__n"] > 0)
    means = cells.select("*", *[F.coalesce(F.try_divide(cell(i, i, "__sx"), cell(i, i, "__n")), F.lit(0.0)).alias(f"__m{i}")
                                for i in range(k + 1)])

    def centred(i, j):
        mi, mj = F.col(f"__m{i}"), F.col(f"__m{j}")
        return cell(i, j, "__sxy") - mj * cell(i, j, "__sx") - mi * cell(i, j, "__sy") + cell(i, j, "__n") * mi * mj

    # a variance within rounding of zero is no variance
    def own(i):
        return F.when(centred(i, i) > 1e-12 * cell(i, i, "__sxx"), centred(i, i)).otherwise(F.lit(0.0))

    products = means.select(*by, "__c", *[F.col(f"__m{i}") for i in range(k + 1)],
                            *[(own(i) if i == j else centred(i, j)).alias(f"__p{i}_{j}") for i, j in place])

    def scaled(i, j):
        a, b = min(i, j), max(i, j)
        scale = F.sqrt(F.col(f"__p{i}_{i}")) * (F.lit(1.0) if j == k else F.sqrt(F.col(f"__p{j}_{j}")))
        return F.coalesce(F.try_divide(F.col(f"__p{a}_{b}"), scale), F.lit(0.0))

    def system(used):
        keep = [f in used for f in features]
        return F.array(*[F.array(*[scaled(i, j) if keep[i] and (j == k or keep[j]) else F.lit(0.0) for j in range(k + 1)])
                         for i in range(k)])

    spec = F.array(*[F.struct(F.lit(name).alias("model"), system(set(used)).alias("__a")) for name, used in models.items()])
    solved = products.select("*", F.inline(spec)).withColumn("__s", _sweep(F.col("__a"), k))
    solved = solved.withColumn("coef", F.array(*[
        F.coalesce(F.try_divide(F.col("__s")[i][k], F.sqrt(F.col(f"__p{i}_{i}"))), F.lit(0.0)) for i in range(k)]))
    explained = sum((F.col("coef")[i] * F.col(f"__p{i}_{k}") for i in range(k)), F.lit(0.0))
    shift = sum((F.col("coef")[i] * F.col(f"__m{i}") for i in range(k)), F.lit(0.0))
    return solved.select(
        *by, "model", F.col("__c")[place[k, k]]["__n"].alias("n"), "coef", F.array(*[F.col(f"__m{i}") for i in range(k)]).alias("mean"),
        (F.col(f"__m{k}") - shift).alias("intercept"), F.greatest(F.col(f"__p{k}_{k}") - explained, F.lit(0.0)).alias("rss"),
        F.col(f"__p{k}_{k}").alias("sst"), F.size(F.filter(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.col("__s")[i][i] > 0.5)).alias("n_coef"))


def fixed(fitted: DataFrame, columns: Sequence[str], name: str, coef: Mapping[str, float], by: Sequence[str] = ()) -> DataFrame:
    """A model of given coefficients beside the fitted ones, e.g. {last period's value: 1.0} (persistence)."""
    first = fitted.groupBy(*by).agg(F.max("n").alias("n"), F.max("mean").alias("mean"), F.max("sst").alias("sst"))
    given = F.array(*[F.lit(float(coef.get(c, 0.0))) for c in columns[:-1]])
    return first.select(*by, F.lit(name).alias("model"), "n", given.alias("coef"), "mean", F.lit(0.0).alias("intercept"),
                        F.lit(None).cast("double").alias("rss"), "sst", F.lit(0).alias("n_coef"))


def predict(df: DataFrame, fitted: DataFrame, columns: Sequence[str], on: Sequence[str] = (), out: str = "prediction") -> DataFrame:
    """Rows of `df` for each model of their group (`on`), with the prediction; null features count as the training mean."""
    head = ["model", "coef", "mean", "intercept"]
    if on:
        rows = df.join(fitted.select(*on, *head), list(on))
    else:
        rows = df.select("*", F.inline(fitted.agg(F.collect_list(F.struct(*head))).scalar()))
    terms = [F.col("coef")[i] * F.coalesce(F.col(c).cast("double"), F.col("mean")[i]) for i, c in enumerate(columns[:-1])]
    return rows.withColumn(out, sum(terms, F.col("intercept"))).drop("coef", "mean", "intercept")
