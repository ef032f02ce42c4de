"""Exact order statistics without sending a variable's values to one task.

Both primitives work on the long form ``(by..., variable, value)``:

* ``exact_quantiles`` first counts each group and sketches its quantiles. Where every group is small
  the built-in exact percentile finishes. Otherwise the sketch brackets each requested rank,
  everything outside the brackets collapses to counts on the map side, and only the bracketed values
  are ordered. The data is scanned twice and never shuffled whole.
* ``ordered_counts`` needs every distinct value (ranks, empirical distribution functions). It
  collapses copies to counts, cuts the value range into buckets and adds bucket offsets, so a
  window never spans more than one bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import number

SUBCELLS = 256
# Groups up to this size keep every value; beyond it a bracket is wider than the sketch error plus two ranks.
KEEP_ALL_ROWS = 20_000
# Groups counted at no more than this go to the built-in exact percentile, which holds a group's distinct values.
SMALL_ROWS = 200_000
# Value buckets of a ranking: RANK_CELLS cells of RANK_CELLS buckets, all cut at quantiles, so a tail is cut like the middle.
RANK_CELLS = 32
BROADCAST_ROWS = 10_000
BROADCAST_BYTES = 32 << 20


def long_form(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(by..., variable, value)`` with doubles; NaN is NULL and NULL rows stay."""
    picked = df.select(*by, *[number(c).alias(c) for c in columns])
    return picked.unpivot(list(by), list(columns), "variable", "value")


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Run a parameter frame once; broadcast it when it has at most ``limit`` rows, else leave it to a shuffle join."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def rows_that_fit(numbers_per_row: int) -> int:
    """How many rows of that many numbers may be broadcast."""
    return max(1, min(BROADCAST_ROWS, BROADCAST_BYTES // (8 * max(1, numbers_per_row))))


def attach(rows: DataFrame, parameters: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join a parameter frame to rows without moving the rows where that is possible.

    A frame keyed by ``variable`` alone has one row per column of the schema, so it is broadcast.
    With group keys the number of groups is checked first; many groups fall back to a shuffle join,
    where adaptive execution splits a hot group.
    """
    parameters = F.broadcast(parameters) if list(keys) == ["variable"] else broadcast_if_small(parameters)
    return rows.join(parameters, list(keys), how)


def _below(edges: Column, value: Column) -> Column:
    """How many of the sorted edges lie strictly below the value."""
    return F.size(F.filter(edges, lambda edge: edge < value))


def _subcell(edges: Column, cell: Column, value: Column, parts: int) -> Column:
    """Equal-width position of a value inside its cell (0 in the open outer cells); monotone in the value."""
    left, right = F.get(edges, cell - 1), F.get(edges, cell)
    share = F.when(right > left, (value - left) / (right - left))
    return F.coalesce(F.floor(F.nanvl(share, F.lit(0.0)) * parts).cast("int"), F.lit(0))


def _prefix_counts(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows before each (cell, sub) and the total per key; a few thousand rows per key at most."""
    per_cell = cells.groupBy(*keys, "cell", "sub").agg(F.sum("n").alias("cell_n"))
    ordered = Window.partitionBy(*keys).orderBy("cell", "sub")
    return per_cell.select(
        *keys, "cell", "sub",
        (F.sum("cell_n").over(ordered.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cell_n")).alias("cell_before"),
        F.sum("cell_n").over(Window.partitionBy(*keys)).alias("total"),
    )


def _with_ranks(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Turn collapsed cells into ``before`` (rows below the value) and ``total``."""
    within = Window.partitionBy(*keys, "cell", "sub").orderBy(F.col("value").asc_nulls_first())
    running = F.sum("n").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    local = cells.withColumn("local_before", running)
    return (
        local.join(_prefix_counts(cells, keys), [*keys, "cell", "sub"])
        .withColumn("before", F.col("cell_before") + F.col("local_before"))
        .select(*keys, "value", "n", "before", "total")
    )


def _placed_by_join(rows: DataFrame, brackets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cell, subcell and kept value of each row, with the brackets of its group joined to it."""
    value, edges = F.col("value"), F.col("edges")
    return (
        rows.join(brackets, list(keys))
        .withColumn("cell", _below(edges, value))
        .withColumn("kept", F.coalesce(F.get("between", F.col("cell")) | (F.get(edges, F.col("cell")) == value), F.lit(False)))
        .withColumn("sub", F.when(F.col("kept"), _subcell(edges, F.col("cell"), value, SUBCELLS)).otherwise(-1))
        .withColumn("value", F.when(F.col("kept"), value))
    )


def _placed_by_search(df: DataFrame, columns: Sequence[str], brackets: DataFrame) -> DataFrame:
    """The same for ungrouped variables: one short row per column is read and searched by ``Bucketizer``.

    A cell here holds its left edge instead of its right one, so rows that are not kept sort last in it.
    """
    found = {r["variable"]: r for r in brackets.collect()}
    names = [c for c in columns if c in found]
    if not names:
        return df.sparkSession.createDataFrame([], "variable string, cell int, sub int, value double")
    infinity = float("inf")
    if any(abs(e) == infinity for c in names for e in found[c]["edges"]):
        rows = long_form(df, columns).where(F.col("value").isNotNull())
        return _placed_by_join(rows, F.broadcast(brackets), ["variable"])
    splits = [[-infinity, *found[c]["edges"], infinity] for c in names]
    values = df.select(*[F.coalesce(number(c), F.lit(float("nan"))).alias(f"v{i}") for i, c in enumerate(names)])
    searched = Bucketizer(splitsArray=splits, inputCols=[f"v{i}" for i in range(len(names))],
                          outputCols=[f"c{i}" for i in range(len(names))], handleInvalid="keep").transform(values)

    def place(i: int, c: str) -> Column:
        edges, between, value, cell = list(found[c]["edges"]), list(found[c]["between"]), F.col(f"v{i}"), F.col(f"c{i}").cast("int")
        inside = F.get(F.array(*[F.lit(bool(b)) for b in [*between, False]]), cell)
        starts = F.array(*[F.lit(float(e)) for e in [edges[0], *edges]])
        widths = [b - a for a, b in zip(edges, edges[1:])]
        scales = F.array(*[F.lit(s) for s in [0.0, *(SUBCELLS / w for w in widths), 0.0]])
        kept = inside | (value == F.get(starts, cell))
        sub = F.floor((value - F.get(starts, cell)) * F.get(scales, cell)).cast("int")
        return F.struct(
            F.lit(c).alias("variable"), F.when(~F.isnan(value), cell).alias("cell"),
            F.when(kept, sub).otherwise(SUBCELLS + 1).alias("sub"), F.when(kept, value).alias("value"),
        )

    placed = searched.select(F.inline(F.array(*[place(i, c) for i, c in enumerate(names)])))
    return placed.where(F.col("cell").isNotNull())


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    accuracy: int = 10_000,
    small_rows: int = SMALL_ROWS,
) -> DataFrame:
    """Linear-interpolated quantiles per (by, variable) as the array column ``q`` in ``probs`` order.

    Groups without a non-null value have no row. A bracket that misses its rank raises, so a wrong
    value is never returned.
    """
    keys = [*by, "variable"]
    rows = long_form(df, columns, by).where(F.col("value").isNotNull())
    margin = 4.0 / accuracy
    inner = [p for p in probs if 0 < p < 1] or [0.5]  # the ends are the smallest and the largest value
    interior = sorted({p + s for p in inner for s in (-margin, margin) if 0 < p + s < 1})
    sketch = [F.count("value").alias("rows"), F.min("value").alias("smallest"), F.max("value").alias("largest")]
    if interior:
        sketch.append(F.percentile_approx("value", interior, accuracy).alias("approx"))
    brackets = rows.groupBy(*keys).agg(*sketch)

    def bound(p: float) -> Column:
        if p <= 0:
            return F.col("smallest")
        if p >= 1:
            return F.col("largest")
        return F.col("approx")[interior.index(p)]

    sizes = brackets.select(*keys, "rows", "smallest", "largest", *(["approx"] if interior else []))
    found = sizes.limit(BROADCAST_ROWS + 1).collect()
    if len(found) <= BROADCAST_ROWS:
        if all(r["rows"] <= small_rows for r in found):
            return rows.groupBy(*keys).agg(F.percentile("value", [float(p) for p in probs]).alias("q"))
        brackets = df.sparkSession.createDataFrame(found, sizes.schema)

    few = F.col("rows") <= KEEP_ALL_ROWS
    lows, highs = [p - margin for p in inner], [p + margin for p in inner]
    ends = brackets.select(*keys, "smallest", "largest")
    brackets = brackets.select(
        *keys,
        F.when(few, F.array("smallest")).otherwise(F.array(*[bound(p) for p in lows])).alias("lows"),
        F.when(few, F.array("largest")).otherwise(F.array(*[bound(p) for p in highs])).alias("highs"),
    ).withColumn("edges", F.array_sort(F.array_distinct(F.concat("lows", "highs"))))
    # The open stretch between two neighbouring edges lies in a bracket as a whole or not at all.
    between = F.transform(
        "edges",
        lambda edge, i: F.exists(
            F.arrays_zip("lows", "highs"),
            lambda b: (b["lows"] < edge) & (edge <= b["highs"]) & (i > 0),
        ),
    )
    brackets = brackets.select(*keys, "edges", between.alias("between"))

    if by:
        known = F.broadcast(brackets) if len(found) <= BROADCAST_ROWS else brackets
        placed = _placed_by_join(rows, known, keys)
    else:
        placed = _placed_by_search(df, columns, brackets)
    cells = placed.groupBy(*keys, "cell", "sub", "value").agg(F.count(F.lit(1)).alias("n"))
    ranked = _with_ranks(cells, keys).where(F.col("value").isNotNull())

    points = F.array(*[F.lit(float(p)) for p in probs])

    def place(total: Column, p: Column) -> Column:
        return (total - 1) * p

    asked = F.array(*[F.lit(float(p)) for p in inner])
    wanted = F.array_distinct(F.flatten(F.transform(asked, lambda p: F.array(F.floor(place(F.col("total"), p)), F.ceil(place(F.col("total"), p))))))
    here = F.filter(wanted, lambda r: (F.col("before") <= r) & (r < F.col("before") + F.col("n")))
    hits = ranked.select(*keys, "total", "value", F.explode(here).alias("rank"))
    chosen = hits.groupBy(*keys).agg(
        F.max("total").alias("total"), F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at"),
    )

    def blend(p: Column) -> Column:
        position = place(F.col("total"), p)
        low, high = F.try_element_at("at", F.floor(position)), F.try_element_at("at", F.ceil(position))
        missed = F.raise_error(F.lit("quantile bracket missed its rank; raise accuracy")).cast("double")
        return F.coalesce(low + (high - low) * (position - F.floor(position)), missed)

    ended = attach(chosen, ends, keys)
    value = F.transform(points, lambda p: F.when(p <= 0, F.col("smallest")).when(p >= 1, F.col("largest")).otherwise(blend(p)))
    return ended.select(*keys, value.alias("q"))


def fitted_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[str, list[float]]:
    """Quantiles as plain numbers for fit/transform steps: one short row per column reaches the driver."""
    return {r["variable"]: list(r["q"]) for r in exact_quantiles(df, columns, probs).collect()}


def ordered_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Distinct values with ``n`` copies, ``before`` rows below and ``total`` rows per (by, variable)."""
    keys = [*by, "variable"]
    rows = long_form(df, columns, by).where(F.col("value").isNotNull())
    pieces = RANK_CELLS * RANK_CELLS
    probs = [(i + 1) / pieces for i in range(pieces - 1)]
    cuts = rows.groupBy(*keys).agg(F.sort_array(F.percentile_approx("value", probs, 10_000)).alias("fine"))
    coarse = F.transform(F.sequence(F.lit(1), F.lit(RANK_CELLS - 1)), lambda i: F.col("fine")[i * RANK_CELLS - 1])
    cuts = cuts.withColumn("coarse", coarse)
    distinct = rows.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"))
    cells = (
        attach(distinct, cuts, keys)
        .withColumn("cell", _below(F.col("coarse"), F.col("value")))
        .withColumn("sub", _below(F.slice("fine", F.col("cell") * RANK_CELLS + 1, F.lit(RANK_CELLS - 1)), F.col("value")))
        .select(*keys, "cell", "sub", "value", "n")
    )
    return _with_ranks(cells, keys)


def average_ranks(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """1-based ranks with ties averaged, one row per distinct value."""
    keys = [*by, "variable"]
    counts = ordered_counts(df, columns, by)
    return counts.select(*keys, "value", (F.col("before") + (F.col("n") + 1) / F.lit(2.0)).alias("rank"))


def sturges_classes(n: Column) -> Column:
    """Number of classes for ``n`` values by the decimal form of Sturges' rule."""
    return F.greatest(F.lit(1), F.ceil(1 + F.lit(3.322) * F.log10(n.cast("double"))).cast("int"))


