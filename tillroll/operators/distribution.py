"""Histograms, densities, box plots, trend lines and distribution checks."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.columns import ratio
from tillroll.functions.probability import (
    negative_binomial_log_pmf,
    normal_quantile,
    poisson_log_pmf,
)
from tillroll.functions.ranking import running_count, value_counts
from tillroll.functions.selection import FEW_CELLS, first_grid, inside, known_values, quantiles, quantiles_of_grid, wide
from tillroll.session import pinned


def _bin_of(x: Column, low: Column, width: Column, bins: Column) -> Column:
    """0-based equal-width bin; the maximum belongs to the last one."""
    place = F.coalesce(F.floor(F.try_divide(x - low, width)), F.lit(0))
    return F.least(place, bins - 1).cast("bigint")


def histogram(
    df: DataFrame, column: str, bins: int | Column, weight: str | None = None
) -> DataFrame:
    """``(bin, low, high, n, density)`` over equal widths from minimum to maximum."""
    x = F.col(column).cast("double")
    bins = F.lit(bins) if isinstance(bins, int) else bins
    span = df.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"))).scalar()
    n = F.sum(weight) if weight else F.count(F.lit(1))
    placed = (
        df.filter(x.isNotNull())
        .withColumn("_span", span)
        .withColumn("_bins", bins)
        .withColumn("_lo", F.col("_span.lo"))
        .withColumn("_w", (F.col("_span.hi") - F.col("_span.lo")) / F.col("_bins"))
        .withColumn("bin", _bin_of(x, F.col("_lo"), F.col("_w"), F.col("_bins")))
    )
    counted = placed.groupBy("bin", "_lo", "_w").agg(n.cast("bigint").alias("n"))
    # At most ``bins`` rows are left.
    everything = F.sum("n").over(Window.partitionBy())
    return counted.select(
        "bin",
        (F.col("_lo") + F.col("bin") * F.col("_w")).alias("low"),
        (F.col("_lo") + (F.col("bin") + 1) * F.col("_w")).alias("high"),
        "n",
        ratio(F.col("n"), everything * F.col("_w")).alias("density"),
    )


def histogram_2d(
    df: DataFrame, x: str, y: str, bins: int = 20, measure: Column | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Counts, and a measure such as a mean, over a grid of equal-width cells."""
    known = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    span = known.agg(
        F.struct(
            F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1")
        )
    ).scalar()
    placed = known.withColumn("_s", span)
    for name, c in (("x", x), ("y", y)):
        low = F.col(f"_s.{name}0").cast("double")
        width = (F.col(f"_s.{name}1").cast("double") - low) / bins
        placed = placed.withColumn(f"{name}_bin", _bin_of(F.col(c).cast("double"), low, width, F.lit(bins)))
    aggregates = [F.count(F.lit(1)).alias("n")] + ([measure] if measure is not None else [])
    return placed.groupBy(*by, "x_bin", "y_bin").agg(*aggregates)


def density(df: DataFrame, column: str, points: int = 512, weight: str | None = None) -> DataFrame:
    """``(x, density)``: Gaussian kernel density on a grid from minimum to maximum.

    Every value is shared between its two neighbouring grid points, so the
    kernel sum runs over at most ``points`` bins whatever the table's size.
    The moments come from the cells of the grid on which the quartiles are
    counted; ``df`` is read once more for them and once for the bins.
    """
    rows = known_values(df, column, weight=weight)
    v, n = F.col("value"), F.col("n")
    cells = first_grid(rows, 0, F.sum(v * n).alias("s"))
    step = (F.max("hi") - F.min("lo")) / (points - 1)
    shape = cells.agg(
        F.struct(F.min("lo").alias("lo"), step.alias("step"), (F.sum("s") / F.sum("n")).alias("mean"))
    )
    placed = rows.withColumn("_p", shape.scalar()).withColumn(
        "_at", F.coalesce(F.try_divide(v - F.col("_p.lo"), F.col("_p.step")), F.lit(0.0))
    )
    placed = placed.withColumn("_k", F.least(F.floor("_at"), F.lit(points - 2)).cast("int"))
    right = (F.col("_at") - F.col("_k")) * n
    # The variance is taken around the mean; raw squares would cancel.
    apart = v - F.col("_p.mean")
    halves = pinned(
        placed.groupBy("_k", F.col("_p.lo").alias("_lo"), F.col("_p.step").alias("_step")).agg(
            F.sum(n - right).alias("_left"), F.sum(right).alias("_right"), F.sum(n).alias("_n"),
            F.sum(apart * apart * n).alias("_squares"),
        )
    )
    iqr = quantiles_of_grid(rows, cells, (0.25, 0.75)).agg(F.max("q") - F.min("q")).scalar()
    sd = F.sqrt(ratio(F.sum("_squares"), F.sum("_n") - 1))
    widths = halves.agg(F.sum("_n").alias("n"), sd.alias("sd")).withColumn("iqr", iqr)
    spread = F.least(F.col("sd"), F.nullif(F.col("iqr") / 1.34, F.lit(0.0)))
    width = 0.9 * spread * F.pow(F.col("n").cast("double"), F.lit(-0.2))
    shape = widths.select(F.struct("n", width.alias("bw"))).scalar()
    halves = halves.withColumn("_w", shape).withColumn(
        "_p", F.struct(F.col("_lo").alias("lo"), F.col("_step").alias("step"), "_w.n", "_w.bw")
    )
    grid = halves.select(
        "_p",
        F.explode(
            F.array(
                F.struct(F.col("_k").alias("k"), F.col("_left").alias("w")),
                F.struct((F.col("_k") + 1).alias("k"), F.col("_right").alias("w")),
            )
        ).alias("_b"),
    )
    spread_out = grid.withColumn("_j", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    gap = (F.col("_j") - F.col("_b.k")) * F.col("_p.step") / F.col("_p.bw")
    kernel = F.col("_b.w") * F.exp(-0.5 * gap * gap)
    return spread_out.groupBy("_j", "_p").agg(F.sum(kernel).alias("_s")).select(
        (F.col("_p.lo") + F.col("_j") * F.col("_p.step")).alias("x"),
        (F.col("_s") / (F.col("_p.n") * F.col("_p.bw") * math.sqrt(2 * math.pi))).alias("density"),
    )


def box_stats(df: DataFrame, column: str, by: Sequence[str], weight: str | None = None) -> DataFrame:
    """Quartiles, whiskers within 1.5 IQR of the box and outlier count per group.

    Counts, smallest and largest values come from the grid on which the
    quartiles are counted; ``df`` is read once more, for the cells in which
    the whiskers may end.
    """
    by = list(by)
    keys = [f"_g{i}" for i in range(len(by))]
    rows = known_values(df, column, by, weight)
    cells = first_grid(rows, len(by))
    quartiles = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    box = pinned(wide(quantiles_of_grid(rows, cells, list(quartiles.values()), by), quartiles, by))
    fences = box.select(
        *[F.col(c).alias(f"_b{i}") for i, c in enumerate(by)], *quartiles,
        (F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).alias("_low"),
        (F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))).alias("_high"),
    )
    same = F.lit(True)
    for i in range(len(by)):
        same = same & F.col(f"_g{i}").eqNullSafe(F.col(f"_b{i}"))
    fenced = pinned(cells.join(fences, same).select(*keys, "cell", "n", "lo", "hi", "ahead", "total", *quartiles, "_low", "_high"))
    # A cell that a fence runs through is looked at row by row, any other counts as a whole.
    cut = F.lit(False)
    for fence in ("_low", "_high"):
        cut = cut | ((F.col("lo") < F.col(fence)) & (F.col("hi") >= F.col(fence)) & (F.col("lo") < F.col("hi")))
        cut = cut | ((F.col("lo") <= F.col(fence)) & (F.col("hi") > F.col(fence)))
    split = fenced.filter(cut)
    few = split.agg(F.count(F.lit(1)) <= FEW_CELLS).first()[0]
    within = inside(rows, split, len(by), few).select(*keys, "cell", "value", "n")
    single = within.groupBy(*keys, "cell", F.col("value").alias("lo"), F.col("value").alias("hi")).agg(F.sum("n").alias("n"))
    ends = split.select(*[F.col(k).alias(f"_b{i}") for i, k in enumerate(keys)], F.col("cell").alias("_cell"), *quartiles, "_low", "_high")
    single = single.join(ends, same & (F.col("cell") == F.col("_cell")))
    columns = [*keys, "n", "lo", "hi", *quartiles, "_low", "_high"]
    parts = fenced.filter(~cut).select(*columns).unionByName(single.select(*columns))
    kept = (F.col("lo") >= F.col("_low")) & (F.col("hi") <= F.col("_high"))
    out = parts.groupBy(*keys, *quartiles).agg(
        F.sum("n").cast("bigint").alias("n"),
        F.min("lo").alias("min"),
        F.max("hi").alias("max"),
        F.min(F.when(kept, F.col("lo"))).alias("whisker_low"),
        F.max(F.when(kept, F.col("hi"))).alias("whisker_high"),
        F.sum(F.when(~kept, F.col("n")).otherwise(0)).cast("bigint").alias("outliers"),
    )
    return out.withColumnsRenamed(dict(zip(keys, by)))


def linear_trend(df: DataFrame, x: str, y: str) -> DataFrame:
    """Slope, intercept, R2 and standard errors of y ~ x; ``mean_x`` and ``sxx`` give the band."""
    fitted = df.agg(
        F.regr_count(y, x).alias("n"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.regr_avgx(y, x).alias("mean_x"),
        F.regr_sxx(y, x).alias("sxx"),
        (F.regr_syy(y, x) - F.regr_slope(y, x) * F.regr_sxy(y, x)).alias("_sse"),
    )
    variance = F.when(F.col("n") > 2, F.col("_sse") / F.nullif(F.col("n") - 2, F.lit(0)))
    return fitted.withColumn("residual_se", F.sqrt(F.greatest(variance, F.lit(0.0)))).withColumn(
        "slope_se", ratio(F.col("residual_se"), F.sqrt("sxx"))
    ).drop("_sse")


def qq_normal(df: DataFrame, column: str, points: int = 99) -> DataFrame:
    """``(scale, p, z, sample, line)`` for the raw and the log values.

    ``line`` runs through the quartiles, as a reference for normality.
    """
    both = df.filter(F.col(column) > 0).select(
        F.explode(
            F.array(
                F.struct(F.lit("raw").alias("scale"), F.col(column).cast("double").alias("v")),
                F.struct(F.lit("log").alias("scale"), F.log(column).alias("v")),
            )
        ).alias("_e")
    ).select("_e.*")
    grid = sorted({(i - 0.5) / points for i in range(1, points + 1)} | {0.25, 0.75})
    found = quantiles(both, "v", grid, ["scale"]).withColumn("z", normal_quantile(F.col("p")))

    def at(p: float, c: str) -> Column:
        return F.max(F.when(F.col("p") == p, F.col(c))).over(Window.partitionBy("scale"))

    slope = (at(0.75, "q") - at(0.25, "q")) / (at(0.75, "z") - at(0.25, "z"))
    return (
        found.withColumn("_slope", slope)
        .withColumn("line", at(0.25, "q") + F.col("_slope") * (F.col("z") - at(0.25, "z")))
        .select("scale", "p", "z", F.col("q").alias("sample"), "line")
    )


def qq_values(df: DataFrame, column: str) -> DataFrame:
    """``(scale, value, n, last_rank, z_first, z_last)``: the whole quantile plot.

    One row per distinct value of the raw and the log scale; its ``n`` equal
    points lie between the normal quantiles of its first and last rank.
    """
    counts = value_counts(df.filter(F.col(column) > 0), column)
    ranked = running_count(counts, [F.col("value")], "n")
    place = lambda rank: normal_quantile((rank - 0.5) / F.col("_total"))
    points = ranked.select(
        "value", "n", F.col("_upto").alias("last_rank"),
        place(F.col("_upto") - F.col("n") + 1).alias("z_first"), place(F.col("_upto")).alias("z_last"),
    )
    logs = points.withColumn("value", F.log("value")).withColumn("scale", F.lit("log"))
    return points.withColumn("scale", F.lit("raw")).unionByName(logs)


def pair_counts(df: DataFrame, x: str, y: str, measure: Column) -> DataFrame:
    """Each pair of values with its count and a measure such as a mean."""
    known = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    return known.groupBy(x, y).agg(F.count(F.lit(1)).alias("n"), measure)


def negative_binomial_fit(freq: DataFrame) -> DataFrame:
    """``(mu, var, size)`` of a ``(freq, customers)`` table.

    The likelihood is searched on a geometric grid around the moment estimate,
    each time finer around the best cell. Without overdispersion ``size`` is NULL.
    """
    x, n = F.col("freq").cast("double"), F.col("customers")
    mean = freq.agg(F.sum(x * n) / F.sum(n)).scalar()
    moments = freq.withColumn("_m", mean).agg(
        F.max("_m").alias("mu"),
        ratio(F.sum((x - F.col("_m")) * (x - F.col("_m")) * n), F.sum(n) - 1).alias("var"),
    )
    start = moments.withColumn(
        "size", F.when(F.col("var") > F.col("mu"), F.col("mu") * F.col("mu") / (F.col("var") - F.col("mu")))
    )

    def search(centre: DataFrame, per_octave: int, reach: int) -> DataFrame:
        one = centre.select(F.struct("mu", "var", "size")).scalar()
        tried = freq.withColumn("_c", one).withColumn(
            "_j", F.explode(F.sequence(F.lit(-reach), F.lit(reach)))
        )
        size = F.col("_c.size") * F.pow(F.lit(2.0), F.col("_j") / F.lit(float(per_octave)))
        tried = tried.withColumn("_size", size)
        fit = F.sum(n * negative_binomial_log_pmf(x, F.col("_size"), F.col("_c.mu")))
        scored = tried.groupBy("_c", "_j", "_size").agg(fit.alias("_ll"))
        return scored.groupBy("_c").agg(
            F.max_by("_size", F.struct("_ll", -F.col("_j"))).alias("_best")
        ).select("_c.mu", "_c.var", F.when(F.col("_c.size").isNotNull(), F.col("_best")).alias("size"))

    return search(search(search(start, 4, 16), 64, 16), 1024, 16)


def frequency_fit(freq: DataFrame) -> DataFrame:
    """Observed customers per order count next to Poisson and negative binomial counts.

    One row per count that occurs, so a single customer with very many orders
    costs one row.
    """
    freq = pinned(freq)
    params = negative_binomial_fit(freq).select(F.struct("mu", "size"))
    total = freq.agg(F.sum("customers")).scalar()
    x = F.col("freq").cast("double")
    return freq.withColumn("_p", params.scalar()).withColumn("_n", total).select(
        F.col("freq").alias("x"),
        F.col("customers").alias("observed"),
        (F.col("_n") * F.exp(poisson_log_pmf(x, F.col("_p.mu")))).alias("poisson"),
        (F.col("_n") * F.exp(negative_binomial_log_pmf(x, F.col("_p.size"), F.col("_p.mu")))).alias(
            "negative_binomial"
        ),
    )
