"""Expressions over a per-key array of monthly sums (null = month absent).

A month list bounds the array, so these stay small whatever the row count.
Arguments are column names or SQL expressions; each function folds the array in
one pass.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def present(series: str) -> Column:
    return F.expr(f"filter({series}, x -> x IS NOT NULL)")


def lower_median(values: str) -> Column:
    """The smallest value that at least half of the values do not exceed; null for no values."""
    return F.expr(f"get(sort_array({values}), CAST(ceil(size({values}) / 2) AS INT) - 1)")


def mean(values: str) -> Column:
    return F.expr(f"aggregate({values}, 0D, (acc, x) -> acc + x) / nullif(size({values}), 0)")


def _squares(values: str, centre: str) -> str:
    return f"aggregate({values}, 0D, (acc, x) -> acc + (x - {centre}) * (x - {centre}))"


def sample_std(values: str, centre: str) -> Column:
    """Sample standard deviation; null for a single value."""
    return F.expr(f"CASE WHEN size({values}) > 1 THEN sqrt({_squares(values, centre)} / (size({values}) - 1)) END")


def population_std(values: str, centre: str) -> Column:
    return F.expr(f"sqrt({_squares(values, centre)} / nullif(size({values}), 0))")


def mean_abs_dev(values: str, centre: str) -> Column:
    return F.expr(
        f"aggregate({values}, 0D, (acc, x) -> acc + abs(x - {centre})) / nullif(size({values}), 0)"
    )


def median_abs_dev(values: str, centre: str) -> Column:
    return lower_median(f"transform({values}, x -> CAST(abs(x - {centre}) AS DOUBLE))")


def last(values: str, k: int) -> Column:
    """The last k values (all of them if there are fewer)."""
    return F.expr(f"slice({values}, greatest(size({values}) - {k - 1}, 1), {k})")


def text_array(values: list[str]) -> Column:
    """A constant array of month names (which hold no comma)."""
    return F.split(F.lit(",".join(values)), ",")


def number_array(values: list[float]) -> Column:
    """A constant array of doubles."""
    return F.expr(f"array({', '.join(f'{float(v)!r}D' for v in values)})")


def named_points(months: list[str]) -> Column:
    """``series`` as an ordered list of (month, n), absent months left out.

    The lambda walks over ``series`` itself: an array indexed from outside of it would be
    built anew for every month where its expression is part of the same plan.
    """
    names = ", ".join(f"'{m}'" for m in months)
    return F.expr(
        f"filter(transform(series, (n, i) -> named_struct('month', get(array({names}), i), 'n', n)), p -> p.n IS NOT NULL)"
    )


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _ordered_stats(ordered: Column, moments: Column, mad: str) -> Column:
    """(months, median, mean, std, mad) of ascending values; ``moments`` is their (mean, squares around it)."""
    size = F.size(ordered)
    rank = F.ceil(size / 2).cast("int")
    fold = lambda values: F.aggregate(values, F.lit(0.0), lambda total, x: total + x)

    def with_median(median):
        if mad == "median_abs":
            off = F.sort_array(F.transform(ordered, lambda x: F.abs(x - median)))
            deviation = F.get(off, rank - 1)
        else:
            # values up to the median lie below it, the others above
            below, whole = fold(F.slice(ordered, 1, rank)), moments["mean"] * size
            deviation = (median * (2 * rank - size) + whole - 2 * below) / F.nullif(size, F.lit(0))
        return F.struct(
            size.alias("months"),
            median.alias("median"),
            moments["mean"].alias("mean"),
            F.when(size > 1, F.sqrt(moments["squares"] / (size - 1))).alias("std"),
            deviation.alias("mad"),
        )

    return _let(F.get(ordered, rank - 1), with_median)


def _add(moments: Column, x: Column, k: Column) -> Column:
    """The moments with one more value, the k-th."""
    off = x - moments["mean"]
    mean = moments["mean"] + off / k
    return F.struct(mean.alias("mean"), (moments["squares"] + off * (x - mean)).alias("squares"))


def rolling_stats(series: Column, history: str | int, mad: str = "mean_abs", kind: str = "bigint") -> Column:
    """For each present month of ``series``: (pos, n, stats), stats over the present months before it.

    One fold over the months: it keeps the values before a month in ascending order with their
    mean and squares, takes the statistics from them, then puts the month's own value in
    its place.  ``history`` is ``"prior"`` (all months before) or the number of months that are
    looked back.  ``stats`` holds months (0 without a history), median, mean, std and mad;
    ``kind`` is the type of the counts.
    """
    if mad not in ("mean_abs", "median_abs"):
        raise ValueError(f"unknown mad: {mad}")
    points = F.filter(
        F.transform(series, lambda x, i: F.struct(i.alias("pos"), x.alias("n"), x.cast("double").alias("value"))),
        lambda p: p["n"].isNotNull(),
    )
    none = F.struct(F.lit(0.0).alias("mean"), F.lit(0.0).alias("squares"))
    point = lambda p, stats: F.array(F.struct(p["pos"].alias("pos"), p["n"].alias("n"), stats.alias("stats")))
    moment_of = lambda values: F.aggregate(
        values,
        F.struct(none.alias("m"), F.lit(0).alias("k")),
        lambda acc, x: F.struct(_add(acc["m"], x, acc["k"] + 1).alias("m"), (acc["k"] + 1).alias("k")),
    )["m"]
    empty = F.array().cast("array<double>")
    stats = "struct<months: int, median: double, mean: double, std: double, mad: double>"
    out = F.array().cast(f"array<struct<pos: int, n: {kind}, stats: {stats}>>").alias("out")

    if history == "prior":

        def step(acc, p):
            return F.struct(
                F.sort_array(F.array_append(acc["ordered"], p["value"])).alias("ordered"),
                _add(acc["moments"], p["value"], F.size(acc["ordered"]) + 1).alias("moments"),
                F.concat(acc["out"], point(p, _ordered_stats(acc["ordered"], acc["moments"], mad))).alias("out"),
            )

        start = [empty.alias("ordered"), none.alias("moments")]
    else:
        k = int(history)

        def step(acc, p):
            def with_window(window):
                ordered = F.sort_array(F.transform(window, lambda w: w["value"]))
                stats = _let(ordered, lambda o: _let(moment_of(o), lambda m: _ordered_stats(o, m, mad)))
                kept = F.array_append(window, F.struct(p["pos"].alias("pos"), p["value"].alias("value")))
                return F.struct(kept.alias("window"), F.concat(acc["out"], point(p, stats)).alias("out"))

            return _let(F.filter(acc["window"], lambda w: w["pos"] >= p["pos"] - k), with_window)

        start = [F.array().cast("array<struct<pos: int, value: double>>").alias("window")]

    return F.aggregate(points, F.struct(*start, out), step, lambda acc: acc["out"])


def month_at(position: str, months: list[str]) -> Column:
    """Name of the month at a position counted from 0."""
    return F.element_at(text_array(months), F.expr(f"{position} + 1"))
