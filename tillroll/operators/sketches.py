"""Mergeable sketches of distinct counts and quantiles, for whoever can do without exact numbers.

A sketch per group, a day for instance, is a few kilobytes whatever the number of rows. Sketches are kept in tables and
united for months, years or all time without the rows; new days add sketches and touch no old ones. The exact
aggregates stay the default everywhere in this library; these are for tables where a shuffle of all values costs too much.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tillroll.operators.ordering import global_running_total
from tillroll.operators.quantiles import exact_quantiles, quantile_scale

LG_BUCKETS = 12  # 4,096 buckets: a standard error of 1.6 %
KLL_SIZE = 200  # ranks within 1.7 % of the rows, at 99 % confidence
_COUNTED = (T.IntegerType, T.LongType, T.StringType, T.BinaryType)


def _countable(df: DataFrame, column: str) -> Column:
    return F.col(column) if isinstance(df.schema[column].dataType, _COUNTED) else F.col(column).cast("string")


def distinct_sketches(df: DataFrame, groups: list[str], columns: list[str], lg_buckets: int = LG_BUCKETS) -> DataFrame:
    """Per group, a sketch of the different values of each column; NULLs do not count."""
    return df.groupBy(*groups).agg(*[F.hll_sketch_agg(_countable(df, c), F.lit(lg_buckets)).alias(c) for c in columns])


def distinct_estimates(sketches: DataFrame, groups: list[str], columns: list[str]) -> DataFrame:
    """The number of different values of each column, from the sketches of all rows of a group."""
    return sketches.groupBy(*groups).agg(*[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in columns])


def quantile_sketches(df: DataFrame, groups: list[str], columns: list[str], size: int = KLL_SIZE) -> DataFrame:
    """Per group, a sketch of the order of each column's values; NULLs do not count."""
    return df.groupBy(*groups).agg(*[F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(size)).alias(c) for c in columns])


def quantile_estimates(sketches: DataFrame, groups: list[str], columns: list[str], quantiles: list[float]) -> DataFrame:
    """Per column an array: the values at ``quantiles``, from the sketches of all rows of a group."""
    at = F.array(*[F.lit(float(q)) for q in quantiles])
    return sketches.groupBy(*groups).agg(*[F.kll_sketch_get_quantile_double(F.kll_merge_agg_double(c), at).alias(c) for c in columns])


def bracketed_quantiles(df: DataFrame, columns: list[str], quantiles: list[float], size: int = 2048, margin: float = 0.01) -> DataFrame:
    """Exact quantiles, as ``exact_quantiles`` gives them, of which most values are never shuffled.

    A sketch says between which values a quantile must lie, ``margin`` of the rows to either side. One more pass counts the
    rows below each bracket and puts only the values inside in order. Should a bracket miss its rows, which the counts
    tell, all values are counted instead. Runs jobs when called: the brackets are a few numbers.
    """
    shares = sorted({min(1.0, max(0.0, q + d)) for q in quantiles for d in (-margin, margin)})
    sketch = F.kll_sketch_agg_double
    held = df.agg(*[sketch(F.col(c).cast("double"), F.lit(size)).alias(c) for c in columns])
    at = F.array(*[F.lit(s) for s in shares])
    row = held.select(*[F.when(F.kll_sketch_get_n_double(c) > 0, F.kll_sketch_get_quantile_double(c, at)).alias(c) for c in columns]).first()
    brackets = {}
    for c in columns:
        cut = dict(zip(shares, row[c])) if row[c] else {}
        # the ends of all values are open, as a sketch may not hold them
        edge = lambda s, end: float(end) if s in (0.0, 1.0) else cut[s]  # noqa: E731, B023
        brackets[c] = [(q, edge(max(0.0, q - margin), "-inf"), edge(min(1.0, q + margin), "inf")) for q in quantiles] if cut else []
    counted = {
        (c, n): (F.count_if(F.col(c).cast("double") < low), F.count_if((F.col(c).cast("double") >= low) & (F.col(c).cast("double") <= high)))
        for c in columns for n, (_, low, high) in enumerate(brackets[c])
    }
    totals = df.agg(
        *[F.count(c).alias(f"n_{c}") for c in columns],
        *[each.alias(f"{kind}_{c}_{n}") for (c, n), pair in counted.items() for kind, each in zip(("below", "inside"), pair)],
    ).first()
    value = f"decimal({16 + quantile_scale(df, columns, quantiles)},{quantile_scale(df, columns, quantiles)})"
    wanted, points = [], []
    unit = Decimal(1).scaleb(-18)
    for c in columns:
        for n, (q, low, high) in enumerate(brackets[c]):
            rank = (totals[f"n_{c}"] - 1) * Decimal(repr(float(q)))
            first = int(rank)
            last = first + (rank > first)
            below, inside = totals[f"below_{c}_{n}"], totals[f"inside_{c}_{n}"]
            if first < below or last >= below + inside:
                return exact_quantiles(df, columns, quantiles)
            wanted.append((c, float(q), n, first - below, last - below, (rank - first).quantize(unit)))
            x = F.col(c).cast("double")
            points.append(F.when((x >= low) & (x <= high), F.struct(F.lit(c).alias("name"), F.lit(n).alias("n"), F.col(c).cast(value).alias("v"))))
    if not wanted:
        return exact_quantiles(df, columns, quantiles)
    return _inside(df, points, wanted, value)


def _inside(df: DataFrame, points: list[Column], wanted: list[tuple], value: str) -> DataFrame:
    """The quantiles, from the values inside their brackets: a share of two margins of the rows, counted by value."""
    spark, scale = df.sparkSession, int(value.rstrip(")").rsplit(",", 1)[1])
    counts = df.select(F.explode(F.filter(F.array(*points), lambda p: p.isNotNull())).alias("p")).select("p.*")
    counts = counts.groupBy("name", "n", "v").agg(F.count(F.lit(1)).alias("rows"))
    running = global_running_total(counts, [F.col("name"), F.col("n"), F.col("v")], "rows", "upto")
    goal = spark.createDataFrame(wanted, f"name string, q double, n int, first long, last long, part decimal(38,18)")
    # a row per bracket
    goal = running.groupBy("name", "n").agg(F.min(F.col("upto") - F.col("rows")).alias("start")).join(F.broadcast(goal), ["name", "n"])
    holds = lambda place: (F.col("upto") - F.col("rows") <= F.col("start") + F.col(place)) & (F.col("start") + F.col(place) < F.col("upto"))
    found = running.join(F.broadcast(goal), ["name", "n"]).where(holds("first") | holds("last"))
    ends = [F.max(F.when(holds(place), F.col("v"))).alias(end) for place, end in (("first", "lower"), ("last", "upper"))]
    found = found.groupBy("name", "q", "part").agg(*ends)
    gap = ((F.col("upper") - F.col("lower")) * F.col("part").cast(f"decimal({scale + 1},{scale})")).cast(value)
    return found.select("name", "q", (F.col("lower") + gap).cast(value).alias("value"))
