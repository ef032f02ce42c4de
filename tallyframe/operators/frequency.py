"""Frequency tables, histograms, distribution functions and densities."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import number
from .describe import stacked
from .ordering import attach, exact_quantiles, long_form, ordered_counts, sturges_classes
from .prepare import quantile_trim

# Grid of the two-dimensional hexagonal density and of the evaluated kernel density.
HEX_GRID = 45
KDE_GRID = 200


def frequency_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Equal-width classes, right-closed, lowest value included; empty classes stay."""
    rows = long_form(df, columns).where(F.col("value").isNotNull())
    limits = rows.groupBy("variable").agg(F.count("value").alias("total"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    limits = limits.select(
        "variable", "total",
        F.when(flat, 1).otherwise(sturges_classes(F.col("total"))).alias("classes"),
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    ).withColumn("width", (F.col("hi") - F.col("lo")) / F.col("classes"))
    position = F.ceil((F.col("value") - F.col("lo")) / F.col("width"))
    # Edges decide: the arithmetic position may be one off where a value meets an edge.
    placed = attach(rows, limits, ["variable"]).withColumn("guess", F.greatest(F.lit(1), F.least(position, F.col("classes"))))
    below = F.col("value") <= F.col("lo") + (F.col("guess") - 1) * F.col("width")
    above = F.col("value") > F.col("lo") + F.col("guess") * F.col("width")
    cls = F.when(below & (F.col("guess") > 1), F.col("guess") - 1).when(above & (F.col("guess") < F.col("classes")), F.col("guess") + 1)
    counts = placed.groupBy("variable", F.coalesce(cls, F.col("guess")).cast("int").alias("class_number")).agg(F.count(F.lit(1)).alias("frequency"))
    grid = limits.withColumn("class_number", F.explode(F.sequence(F.lit(1), F.col("classes"))))
    running = Window.partitionBy("variable").orderBy("class_number").rowsBetween(Window.unboundedPreceding, 0)
    lower = F.col("lo") + (F.col("class_number") - 1) * F.col("width")
    upper = F.when(F.col("class_number") == F.col("classes"), F.col("hi")).otherwise(F.col("lo") + F.col("class_number") * F.col("width"))
    return (
        grid.join(counts, ["variable", "class_number"], "left")
        .withColumn("frequency", F.coalesce("frequency", F.lit(0)))
        .withColumn("cumulative_frequency", F.sum("frequency").over(running))
        .select(
            "variable", "class_number", lower.alias("lower_bound"), upper.alias("upper_bound"),
            ((lower + upper) / 2).alias("midpoint"), "frequency",
            (100.0 * F.col("frequency") / F.col("total")).alias("relative_frequency_percent"),
            "cumulative_frequency", (100.0 * F.col("cumulative_frequency") / F.col("total")).alias("cumulative_percent"),
        )
    )


def histogram(df: DataFrame, columns: Sequence[str], bins: int, trim: tuple[float, float] | None = None) -> DataFrame:
    """Left-closed equal-width bins with the last bin closed; optional quantile trim per variable."""
    rows = long_form(df, columns).where(F.col("value").isNotNull())
    if trim:
        bounds = exact_quantiles(df, columns, list(trim)).select("variable", F.col("q")[0].alias("a"), F.col("q")[1].alias("b"))
        rows = attach(rows, bounds, ["variable"]).where(F.col("value").between(F.col("a"), F.col("b"))).select("variable", "value")
    limits = rows.groupBy("variable").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    limits = limits.select(
        "variable", F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"), F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    ).withColumn("width", (F.col("hi") - F.col("lo")) / bins)
    guess = F.greatest(F.lit(0), F.least(F.floor((F.col("value") - F.col("lo")) / F.col("width")), F.lit(bins - 1)))
    placed = attach(rows, limits, ["variable"]).withColumn("guess", guess)
    below = (F.col("value") < F.col("lo") + F.col("guess") * F.col("width")) & (F.col("guess") > 0)
    above = (F.col("value") >= F.col("lo") + (F.col("guess") + 1) * F.col("width")) & (F.col("guess") < bins - 1)
    chosen = F.when(below, F.col("guess") - 1).when(above, F.col("guess") + 1).otherwise(F.col("guess")).cast("int")
    counts = placed.groupBy("variable", chosen.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = limits.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return grid.join(counts, ["variable", "bin"], "left").select(
        "variable", "bin", (F.col("lo") + F.col("bin") * F.col("width")).alias("left_edge"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("right_edge"), F.coalesce("count", F.lit(0)).alias("count"),
    )


def ecdf(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Share of values at or below each distinct value, per group."""
    counts = ordered_counts(df, columns, by)
    return counts.select(*by, "variable", "value", ((F.col("before") + F.col("n")) / F.col("total")).alias("cumulative_share"))


def trimmed_ecdf(df: DataFrame, column: str, by: Sequence[str] = (), low: float = 0.01, high: float = 0.99) -> DataFrame:
    return ecdf(quantile_trim(df, [column], low, high), [column], by)


def order_statistics(states: Mapping[str, DataFrame], columns: Sequence[str], points: int = 100) -> DataFrame:
    """The sorted-value curve of each state at ``points`` + 1 evenly spaced probabilities."""
    probs = [i / points for i in range(points + 1)]
    curve = exact_quantiles(stacked(states, columns), columns, probs, ["state"])
    return curve.select("state", "variable", F.posexplode("q").alias("step", "value"))


# A value lies within a quarter bandwidth of its bin's centre, so term k is below 0.25**k / sqrt(k!): 1e-14 at 14.
KDE_TERMS = 14
KDE_REACH = 9.0  # bandwidths; the kernel is below 3e-18 beyond


def hermite_coefficients(terms: int = KDE_TERMS) -> list[list[float]]:
    """Row k: the coefficients of the Hermite polynomial He_k over k!, lowest power first."""
    rows = [[1.0], [0.0, 1.0]]
    for k in range(1, terms - 1):
        shifted, held = [0.0, *rows[k]], [*rows[k - 1], 0.0, 0.0]
        rows.append([x - k * y for x, y in zip(shifted, held)])
    return [[c / math.factorial(k) for c in row] for k, row in enumerate(rows[:terms])]


def kernel_density(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), grid: int = KDE_GRID) -> DataFrame:
    """Gaussian kernel density with Scott's bandwidth on an even grid between the extremes.

    With t and u the distances of a grid point and a value from the value's bin, in bandwidths, the kernel
    exp(-(t - u)**2 / 2) is exp(-t**2 / 2) times the sum of He_k(t) u**k / k!. Values therefore only
    enter by 14 sums of powers per half bandwidth, added up on the map side; the bins, not the rows,
    meet the grid points around them. A group without spread has one row at its value, density null.
    A null in ``by`` makes a group like any other value.
    """
    keys = ["group", "variable"]
    # A struct is never null itself, so joins by group also find groups with nulls.
    grouped = df.select(F.struct(*by).alias("group") if by else F.lit(0).alias("group"), *columns)
    rows = long_form(grouped, columns, ["group"]).where(F.col("value").isNotNull())
    shape = rows.groupBy(*keys).agg(
        F.count("value").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"), F.stddev_samp("value").alias("std")
    ).withColumn("bandwidth", F.pow(F.col("n").cast("double"), F.lit(-0.2)) * F.col("std"))
    flat = shape.where(~F.coalesce(F.col("bandwidth") > 0, F.lit(False))).select(
        *keys, F.lit(0).alias("step"), F.col("lo").alias("x"), F.lit(None).cast("double").alias("density"))
    shape = shape.where(F.col("bandwidth") > 0)
    away = (F.col("value") - F.col("lo")) / F.col("bandwidth")
    placed = attach(rows, shape, keys).select(*keys, F.floor(away * 2).alias("bin"), away.alias("away")).withColumn("u", F.col("away") - (F.col("bin") + 0.5) / 2)
    bins = placed.groupBy(*keys, "bin").agg(*[F.sum(F.pow("u", F.lit(float(k)))).alias(f"m{k}") for k in range(KDE_TERMS)])
    table = hermite_coefficients()
    powers = {f"c{j}": sum((F.col(f"m{k}") * table[k][j] for k in range(j + 1, KDE_TERMS) if j < len(table[k]) and table[k][j]), F.col(f"m{j}") * table[j][j]) for j in range(KDE_TERMS)}
    step_size = (F.col("hi") - F.col("lo")) / (grid - 1) / F.col("bandwidth")
    middle = (F.col("bin") + 0.5) / 2
    first = F.greatest(F.ceil((middle - KDE_REACH) / step_size), F.lit(0).cast("long"))
    last = F.least(F.floor((middle + KDE_REACH) / step_size), F.lit(grid - 1).cast("long"))
    near = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<long>"))
    spread = attach(bins.withColumns(powers), shape, keys).withColumn("step", F.explode(near)).withColumn("t", F.col("step") * step_size - middle)
    series = F.col(f"c{KDE_TERMS - 1}")
    for j in reversed(range(KDE_TERMS - 1)):
        series = series * F.col("t") + F.col(f"c{j}")
    figures = ["n", "lo", "hi", "bandwidth"]
    near = spread.select(*keys, "step", *figures, (F.exp(-0.5 * F.col("t") * F.col("t")) * series).alias("part"))
    # Grid points far from every value have a density of zero, so all of them are listed.
    every = shape.select(*keys, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(grid - 1).cast("long"))).alias("step"), *figures, F.lit(0.0).alias("part"))
    sums = near.unionByName(every).groupBy(*keys, "step").agg(F.sum("part").alias("total"), *[F.max(c).alias(c) for c in figures])
    density = F.col("total") / (math.sqrt(2 * math.pi) * F.col("bandwidth")) / F.col("n")
    point = F.col("lo") + F.col("step") * (F.col("hi") - F.col("lo")) / (grid - 1)
    out = sums.select(*keys, F.col("step").cast("int").alias("step"), point.alias("x"), density.alias("density")).unionByName(flat)
    return out.select(*[F.col("group")[c].alias(c) for c in by], "variable", "step", "x", "density")


def hexagon_cell(x: Column, y: Column, x_lo: float, x_hi: float, y_lo: float, y_hi: float, grid: int = HEX_GRID) -> tuple[Column, Column, Column]:
    """Hexagonal cell of a point: one of two offset lattices (0 corners, 1 centres) and its indices."""
    nx, ny = grid, int(grid / math.sqrt(3))
    sx = (x - x_lo) / ((x_hi - x_lo) / nx or 1.0)
    sy = (y - y_lo) / ((y_hi - y_lo) / ny or 1.0)
    corner_x, corner_y = F.floor(sx + 0.5), F.floor(sy + 0.5)
    centre_x, centre_y = F.floor(sx), F.floor(sy)
    to_corner = F.pow(sx - corner_x, F.lit(2)) + 3.0 * F.pow(sy - corner_y, F.lit(2))
    to_centre = F.pow(sx - centre_x - 0.5, F.lit(2)) + 3.0 * F.pow(sy - centre_y - 0.5, F.lit(2))
    corner = to_corner < to_centre
    return F.when(corner, 0).otherwise(1), F.when(corner, corner_x).otherwise(centre_x), F.when(corner, corner_y).otherwise(centre_y)


def hexbin(df: DataFrame, x: str, y: str, grid: int = HEX_GRID, trim: tuple[float, float] | None = (0.01, 0.99)) -> DataFrame:
    """Rows per hexagonal cell; cells without rows do not appear. A constant axis has one column of cells."""
    points = df.select(number(x).alias(x), number(y).alias(y)).na.drop()
    if trim:
        points = quantile_trim(points, [x, y], *trim)
    box = [v or 0.0 for v in points.agg(F.min(x), F.max(x), F.min(y), F.max(y)).first()]
    lattice, i, j = hexagon_cell(F.col(x), F.col(y), *box, grid=grid)
    return points.groupBy(lattice.alias("lattice"), i.cast("long").alias("i"), j.cast("long").alias("j")).agg(F.count(F.lit(1)).alias("count"))
