"""Profiling: counts, exact quantiles, descriptions, fences, density estimates."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folia.operators.spread import place_by_range

# Relative rank error of the sketch that narrows a quantile down.
SKETCH_ERROR = 0.001
# Distance of the upper fence in quartile ranges, and the
# defaults of the density grid.
FENCE_RANGES = 1.5
GRID_POINTS = 200
GRID_CUT = 3.0
# Largest error of a density at any point, as a share of what one value adds at its own place.
DENSITY_ERROR = 1e-9


def _numbers(df: DataFrame, column: str | Column) -> DataFrame:
    """The values of a column in its own type, without NULL and NaN."""
    cell = F.col(column) if isinstance(column, str) else column
    values = df.select(cell.alias("v")).filter(F.col("v").isNotNull())
    floating = isinstance(values.schema["v"].dataType, (T.FloatType, T.DoubleType))
    return values.filter(~F.isnan("v")) if floating else values


def _cell(df: DataFrame, column: str | Column) -> Column:
    """A column with NULL for NaN."""
    cell = F.col(column) if isinstance(column, str) else column
    floating = isinstance(df.select(cell.alias("v")).schema["v"].dataType, (T.FloatType, T.DoubleType))
    return F.when(~F.isnan(cell), cell) if floating else cell


def _merged(bands: Sequence[tuple[float, float]]) -> list[tuple[float, float]]:
    """The bands as disjoint ones, ascending."""
    out: list[tuple[float, float]] = []
    for low, high in sorted(bands):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def _segment(value: Column, bands: Sequence[tuple[float, float]]) -> Column:
    """Odd inside a band, even before, between and after them, rising with the value."""
    out = F.lit(2 * len(bands))
    for i, (low, high) in reversed(list(enumerate(bands))):
        out = F.when(value < low, 2 * i).when(value <= high, 2 * i + 1).otherwise(out)
    return out


def _values_at(
    cells: DataFrame, ns: dict[str, int], bands: dict[str, list[tuple[float, float]]], ranks: dict[str, set[int]]
) -> dict[str, dict[int, object]]:
    """The values at 0-based ranks of several columns of one type, from one scan.

    Values inside a column's bands are counted one by one, all others by the gap they are in.
    What is counted is placed by ranges of (column, segment, value) with the totals of
    all before it, so neither a band nor a range has to fit one task, and ties are one row. A rank
    that turns out to be in a gap is looked for once more with the whole column as the band.
    """
    names = list(ns)
    tagged = [
        F.struct(F.lit(i).alias("c"), _segment(F.col(c).cast("double"), bands[c]).alias("s"), F.col(c).alias("v"))
        for i, c in enumerate(names)
    ]
    rows = cells.select(F.inline(F.array(*tagged))).filter("v IS NOT NULL")
    counts = rows.groupBy("c", "s", F.when(F.col("s") % 2 == 1, F.col("v")).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    placed = place_by_range(counts.withColumn("order", F.struct("c", "s", "v")), "order", "start", "n")
    before, wanted = 0, F.lit(False)
    offsets = {}
    for c in names:
        offsets[c] = before
        for r in ranks[c]:
            wanted = wanted | ((F.col("start") <= before + r) & (F.col("start") + F.col("n") > before + r))
        before += ns[c]
    hits = placed.filter(wanted).select("start", "n", "v").collect()  # a row per rank at most
    found: dict[str, dict[int, object]] = {}
    for c in names:
        found[c] = {r: h["v"] for r in ranks[c] for h in hits if h["start"] <= offsets[c] + r < h["start"] + h["n"]}
    missed = [c for c in names if any(v is None for v in found[c].values())]
    if missed:
        whole = {c: [(-math.inf, math.inf)] for c in missed}
        found |= _values_at(cells, {c: ns[c] for c in missed}, whole, {c: ranks[c] for c in missed})
    return found


def _exact(df: DataFrame, columns: dict[str, str | Column], shares: dict[str, Sequence[float]], ranks_of, extra: Sequence[Column] = ()):
    """Exact order statistics of several columns: their values by rank, and the row of the first scan.

    The first scan counts all columns, draws a sketch of each and takes the `extra` aggregates;
    `ranks_of` then names the ranks of a column of n values. The sketch proposes a band per
    share, in doubles, which keep the order of the values; the values keep their type. The second
    scan (one per type of column) counts the values inside the bands exactly.
    """
    cells = df.select(*[_cell(df, c).alias(name) for name, c in columns.items()])
    spread = 3 * SKETCH_ERROR
    sides = {c: [min(max(p + side, 0.0), 1.0) for p in ps for side in (-spread, spread)] for c, ps in shares.items()}
    sketch = lambda c: F.percentile_approx(F.col(c).cast("double"), sides[c], round(1 / SKETCH_ERROR))
    first = cells.agg(
        *[F.count(c).alias(f"n_{c}") for c in columns], *[sketch(c).alias(f"cuts_{c}") for c in columns], *extra
    ).first()
    ns = {c: first[f"n_{c}"] for c in columns if first[f"n_{c}"]}
    # Of few values all are counted: neighbours of a rank may be outside a narrow band.
    whole = [(-math.inf, math.inf)]
    bands = {c: whole if n * SKETCH_ERROR < 1 else _merged(list(zip(first[f"cuts_{c}"][0::2], first[f"cuts_{c}"][1::2]))) for c, n in ns.items()}
    found: dict[str, dict[int, object]] = {}
    for kind in {f.dataType.simpleString() for f in cells.schema if f.name in ns}:
        own = [f.name for f in cells.schema if f.name in ns and f.dataType.simpleString() == kind]
        found |= _values_at(cells.select(*own), {c: ns[c] for c in own}, bands, {c: set(ranks_of(c, ns[c])) for c in own})
    return found, first


def order_statistics(df: DataFrame, column: str | Column, ranks: Sequence[int], n: int | None = None) -> list:
    """Exact values at 0-based ranks of the sorted column, in its type; an action.

    NULL and NaN are no values. The table is scanned twice for all ranks together, and once more
    if the number `n` of values is not given.
    """
    if n is None:
        n = _numbers(df, column).count()
    found, _ = _exact(df, {"v": column}, {"v": [r / max(n, 1) for r in ranks]}, lambda c, m: ranks)
    return [found["v"][r] for r in ranks]


def _places(probabilities: Sequence[float], n: int, interpolate: bool) -> list[float]:
    return [p * (n - 1) if interpolate else max(math.ceil(p * n) - 1, 0) for p in probabilities]


def _between(values: dict[int, object], places: Sequence[float], interpolate: bool) -> list:
    pairs = [(values[math.floor(p)], values[math.ceil(p)]) for p in places]
    if not interpolate:
        return [low for low, _ in pairs]
    return [float(low) + (p - math.floor(p)) * float(high - low) for p, (low, high) in zip(places, pairs)]


def _quantiles(df: DataFrame, columns: dict[str, str | Column], probabilities: dict[str, Sequence[float]], interpolate: bool, extra: Sequence[Column] = ()):
    around = lambda c, n: {r for p in _places(probabilities[c], n, interpolate) for r in (math.floor(p), math.ceil(p))}
    found, first = _exact(df, columns, probabilities, around, extra)
    out = {}
    for c, ps in probabilities.items():
        places = _places(ps, first[f"n_{c}"], interpolate)
        out[c] = _between(found[c], places, interpolate) if c in found else [None] * len(ps)
    return out, first


def exact_quantiles_of(df: DataFrame, probabilities: dict[str, Sequence[float]], *, interpolate: bool = True) -> dict[str, list]:
    """`exact_quantiles` of several columns: one scan for all, and one more per type of column; an action."""
    return _quantiles(df, {c: c for c in probabilities}, probabilities, interpolate)[0]


def exact_quantiles(df: DataFrame, column: str | Column, probabilities: Sequence[float], *, interpolate: bool = True) -> list:
    """Exact quantiles of a numeric column; NULL and NaN are no values; an action of two scans.

    With `interpolate` the value between two neighbours is taken linearly, as a double;
    else the lower neighbour, which is always a value of the column, in its type.
    """
    return _quantiles(df, {"v": column}, {"v": probabilities}, interpolate)[0]["v"]


def describe(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample deviation, extremes and interpolated quartiles, as one row; two scans."""
    double = lambda x: x.cast("double")
    extra = [double(F.mean("v")).alias("mean"), double(F.stddev_samp("v")).alias("std"), double(F.min("v")).alias("min"), double(F.max("v")).alias("max")]
    quartiles, r = _quantiles(df, {"v": column}, {"v": [0.25, 0.5, 0.75]}, True, extra)
    schema = "count long, mean double, std double, min double, q25 double, q50 double, q75 double, max double"
    return df.sparkSession.createDataFrame([(r["n_v"], r["mean"], r["std"], r["min"], *quartiles["v"], r["max"])], schema)


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column, all columns in one scan."""
    return _per_column(df, lambda c: F.count_if(c.isNull()), "nulls")


def column_profile(df: DataFrame) -> DataFrame:
    """Type and number of present values per column, all columns in one scan."""
    types = F.create_map(*[F.lit(x) for f in df.schema for x in (f.name, f.dataType.simpleString())])
    counts = _per_column(df, F.count, "non_null")
    return counts.select("column", types[F.col("column")].alias("type"), "non_null")


def _per_column(df: DataFrame, aggregate, name: str) -> DataFrame:
    one_row = df.agg(*[aggregate(F.col(f"`{c}`")).alias(c) for c in df.columns])
    return one_row.unpivot([], [F.col(f"`{c}`") for c in df.columns], "column", name)


def conditional_counts(df: DataFrame, **conditions: Column) -> DataFrame:
    """How many rows meet each condition, as one row."""
    return df.agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])


def upper_fence(df: DataFrame, column: str, ranges: float = FENCE_RANGES) -> float | None:
    """Third quartile plus `ranges` times the distance between the quartiles; an action."""
    q25, q75 = exact_quantiles(df, column, [0.25, 0.75])
    return None if q25 is None else q75 + ranges * (q75 - q25)


def outlier_count(df: DataFrame, column: str, ranges: float = FENCE_RANGES) -> DataFrame:
    """The upper fence and how many rows are on or above it. No row is removed."""
    fence = F.lit(upper_fence(df, column, ranges)).cast("double")
    return df.agg(F.count_if(F.col(column) >= fence).alias("outliers")).select(
        fence.alias("fence"), "outliers"
    )


def sorted_distinct(df: DataFrame, column: str) -> DataFrame:
    """Distinct values ascending; a missing value is kept, once and last."""
    return df.select(column).distinct().orderBy(F.col(column).asc_nulls_last())


def density(
    df: DataFrame, column: str, points: int = GRID_POINTS, cut: float = GRID_CUT, error: float = DENSITY_ERROR
) -> DataFrame:
    """Gaussian kernel density estimate on an even grid, as rows (x, density).

    The bandwidth h is `stddev_samp * n^(-1/5)`; the grid reaches `cut` bandwidths beyond the
    extremes. Values are first binned linearly: each gives its weight to the two bin edges
    around it, the more to the nearer, combined before the shuffle. Kernels are then summed
    over the edges that have weight, so a value costs the same however many points the grid has.

    Binning replaces a value's kernel by its linear interpolation between edges d apart, which
    is off by (d / h)^2 / 8 of the kernel's height at most. d is chosen so that this is `error`;
    a density is thus off by error / (h * sqrt(2 pi)) at most.
    """
    values = _numbers(df, column).select(F.col("v").cast("double").alias("v"))
    stats = values.agg(
        F.count("v").alias("n"), F.stddev_samp("v").alias("s"), F.min("v").alias("lo"), F.max("v").alias("hi")
    ).first()
    n, lo, hi = stats["n"], stats["lo"], stats["hi"]
    h = (stats["s"] or 0.0) * n ** (-1 / 5) if n > 1 else 0.0
    if not h:
        return values.select(F.col("v").alias("x"), F.lit(0.0).alias("density")).limit(0)
    d = h * math.sqrt(8 * error)
    placed = values.select(((F.col("v") - lo) / d).alias("b")).withColumn("k", F.floor("b"))
    share = F.col("b") - F.col("k")
    halves = placed.select(F.inline(F.array(F.struct(F.col("k").alias("k"), (1 - share).alias("w")), F.struct((F.col("k") + 1).alias("k"), share.alias("w")))))
    edges = halves.groupBy("k").agg(F.sum("w").alias("w")).select((F.lit(lo) + F.col("k") * d).alias("v"), "w")
    start, step = lo - cut * h, (hi - lo + 2 * cut * h) / (points - 1)
    scale = n * h * math.sqrt(2 * math.pi)
    grid = [start + i * step for i in range(points)]

    def kernel_sum(x: float) -> Column:
        z = (F.lit(x) - F.col("v")) / F.lit(h)
        return F.sum(F.col("w") * F.exp(z * z * F.lit(-0.5))) / F.lit(scale)

    return edges.agg(F.array(*[F.struct(F.lit(x).alias("x"), kernel_sum(x).alias("density")) for x in grid]).alias("g")).select(F.inline("g"))
