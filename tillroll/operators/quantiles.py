"""Exact linear-interpolated quantiles, without holding all distinct values in one task."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, functions as F, types as T

from tillroll.operators.ordering import global_running_total


def quantile_scale(df: DataFrame, columns: list[str], quantiles: list[float]) -> int:
    """The decimals that hold every quantile exactly: those of the column and those of the quantile's number."""
    scale = 0
    for column in columns:
        kind = df.schema[column].dataType
        if isinstance(kind, T.DecimalType):
            scale = max(scale, kind.scale)
        elif not isinstance(kind, T.IntegralType):
            raise ValueError(f"{column} is {kind.simpleString()}; exact quantiles need whole numbers or decimals")
    return scale + max(-Decimal(repr(float(q))).as_tuple().exponent for q in quantiles)


def exact_quantiles(df: DataFrame, columns: list[str], quantiles: list[float]) -> DataFrame:
    """One row per column and quantile: ``name, q, value``.

    The rows are first counted per distinct value (combined map-side, so a hot
    value costs one row per task). The two order statistics around
    ``(n - 1) * q`` are then found on the running count over the values.
    """
    scale = quantile_scale(df, columns, quantiles)
    value = f"decimal({16 + scale},{scale})"
    names = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast(value).alias("v")) for c in columns])
    counts = (
        df.select(F.explode(names).alias("x"))
        .select("x.name", "x.v")
        .where(F.col("v").isNotNull())
        .groupBy("name", "v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    running = global_running_total(counts, [F.col("name"), F.col("v")], "n", "upto")
    # one row per column name
    spans = running.groupBy("name").agg(
        F.min(F.col("upto") - F.col("n")).alias("start"), F.max("upto").alias("stop")
    )
    wanted = F.explode(F.array(*[F.struct(F.lit(float(q)).alias("q"), F.lit(Decimal(repr(float(q)))).cast(f"decimal(20,{scale})").alias("d")) for q in quantiles])).alias("w")
    targets = (
        spans.select("name", "start", (F.col("stop") - F.col("start") - 1).alias("last"), wanted)
        .select("name", "start", "last", "w.q", (F.col("last") * F.col("w.d")).alias("at"))
        .withColumn("low", F.col("start") + F.floor("at"))
        .withColumn("high", F.col("start") + F.ceil("at"))
    )

    def holds(place: str):
        return (F.col("upto") - F.col("n") <= F.col(place)) & (F.col(place) < F.col("upto"))

    found = (
        running.join(F.broadcast(targets), "name")
        .where(holds("low") | holds("high"))
        .groupBy("name", "q")
        .agg(
            F.max("at").alias("at"),
            F.max(F.when(holds("low"), F.col("v"))).alias("lower"),
            F.max(F.when(holds("high"), F.col("v"))).alias("upper"),
        )
    )
    # a difference of two values has the column's decimals, so that the product fits the scale
    step = (F.col("upper") - F.col("lower")) * (F.col("at") - F.floor("at")).cast(f"decimal({scale + 1},{scale})")
    return found.select("name", "q", (F.col("lower") + step).cast(value).alias("value"))


def quantile_row(df: DataFrame, wanted: dict[str, tuple[str, float]]) -> DataFrame:
    """The same as one row: ``wanted`` maps an output name to (column, quantile)."""
    columns = sorted({c for c, _ in wanted.values()})
    quantiles = sorted({float(q) for _, q in wanted.values()})
    long = exact_quantiles(df, columns, quantiles)
    picks = [
        F.max(F.when((F.col("name") == c) & (F.col("q") == float(q)), F.col("value"))).alias(out)
        for out, (c, q) in wanted.items()
    ]
    return long.agg(*picks)
