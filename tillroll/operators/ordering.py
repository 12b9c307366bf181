"""Global order without a single-partition window.

``row_number() over (order by ...)`` without a partition pulls every row into one
task. Here the rows are range-partitioned on the full sort key (so that a value
shared by a third of all rows still splits on the tie-breaker), numbered inside
their partition, and shifted by the sizes of the partitions before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillroll.staging import written


def _in_order(df: DataFrame, order: list[Column], label: str) -> DataFrame:
    """``df`` written in range partitions, with ``_part`` and ``_row`` giving each row's place.

    ``monotonically_increasing_id`` counts the rows of a partition in its lower
    33 bits, which a test pins. The places are only valid together with the
    partitioning that made them, hence the written table.
    """
    place = F.monotonically_increasing_id()
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_row", place.bitwiseAND((1 << 33) - 1))
    )
    return written(placed, label)


def _offsets(ordered: DataFrame, amount: Column) -> DataFrame:
    """Per range partition: what lies before it, and the grand total. One row per partition."""
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    return (
        ordered.groupBy("_part")
        .agg(amount.alias("_amount"))
        .select(
            "_part",
            F.coalesce(F.sum("_amount").over(before), F.lit(0)).alias("_before"),
            F.sum("_amount").over(everything).alias("_total"),
        )
    )


def global_row_number(
    df: DataFrame, order: list[Column], rank: str = "rn", rows: str | None = None
) -> DataFrame:
    """Add the 1-based position in ``order`` (which must end in a unique key) and, if named, the row count."""
    ordered = _in_order(df, order, "ordered")
    # one offset row per range partition: bounded by the partition count, so the broadcast is safe
    placed = ordered.join(F.broadcast(_offsets(ordered, F.count(F.lit(1)))), "_part")
    out = placed.withColumn(rank, F.col("_before") + F.col("_row") + 1)
    if rows:
        out = out.withColumn(rows, F.col("_total"))
    return out.drop("_part", "_row", "_before", "_total")


def global_running_total(df: DataFrame, order: list[Column], weight: str, out: str) -> DataFrame:
    """Add the running sum of ``weight`` along ``order``, the row itself included."""
    ordered = _in_order(df, order, "running")
    so_far = Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    return (
        ordered.withColumn("_local", F.sum(weight).over(so_far))
        .join(F.broadcast(_offsets(ordered, F.sum(weight))), "_part")
        .withColumn(out, F.col("_before") + F.col("_local"))
        .drop("_part", "_row", "_before", "_total", "_local")
    )


def top_rows(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """First ``k`` rows of a global order; each task keeps only its own best ``k``."""
    return df.orderBy(*order).limit(k)


def with_totals(df: DataFrame, source: DataFrame, **totals: Column) -> DataFrame:
    """Add aggregates over all rows of ``source`` to each row of ``df``: a second scan of the columns they need, one row broadcast."""
    return df.crossJoin(F.broadcast(source.agg(*[c.alias(n) for n, c in totals.items()])))


def global_rank(df: DataFrame, value: str, key: str, rank: str, descending: bool = True) -> DataFrame:
    """RANK over ``value``: rows with equal values share the position of the first of them.

    Equal values lie side by side but may span range partitions, so each
    partition takes over the start of a run that began before it.
    """
    order = F.desc(value) if descending else F.asc(value)
    ordered = _in_order(df, [order, F.asc(key)], "ranked")
    inside = Window.partitionBy("_part").orderBy("_row")
    steps = (F.col("_row") > 0) & ~F.col(value).eqNullSafe(F.lag(value).over(inside))
    marked = ordered.withColumn("_step", F.when(steps, F.col("_row")))
    # one row per range partition
    parts = marked.groupBy("_part").agg(
        F.count(F.lit(1)).alias("_n"),
        F.min_by(value, "_row").alias("_first"),
        F.max_by(value, "_row").alias("_last"),
        F.max("_step").alias("_last_step"),
    )
    along = Window.orderBy("_part")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    opens = (F.row_number().over(along) == 1) | ~F.col("_first").eqNullSafe(F.lag("_last").over(along))
    parts = parts.withColumn("_before", before).withColumn("_opens", opens)
    run = F.coalesce(F.col("_last_step") + F.col("_before"), F.when(F.col("_opens"), F.col("_before")))
    parts = parts.withColumn("_run", run)
    inherited = F.when(F.col("_opens"), F.col("_before")).otherwise(F.max("_run").over(earlier))
    parts = parts.select("_part", "_before", inherited.alias("_inherited"))
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    start = F.coalesce(F.max("_step").over(so_far) + F.col("_before"), F.col("_inherited"))
    return marked.join(F.broadcast(parts), "_part").withColumn(rank, start + 1).drop(
        "_part", "_row", "_step", "_before", "_inherited"
    )


def global_lag(df: DataFrame, group: str, order: list[str], value: str, out: str) -> DataFrame:
    """LAG of ``value`` within ``group``, for groups of any size.

    The rows are range-partitioned on group and order together, so one large
    group spans partitions; the first row of a partition looks at the last row
    of the one before.
    """
    ordered = _in_order(df, [F.asc(group), *[F.asc(c) for c in order]], "lagged")
    inside = Window.partitionBy("_part").orderBy("_row")
    last = F.struct(F.col(group).alias("g"), F.col(value).alias("v"))
    # one row per range partition: its last one, shown to the next partition
    sizes = ordered.groupBy("_part").agg(F.max("_row").alias("_row"))
    ends = ordered.join(F.broadcast(sizes), ["_part", "_row"]).select(
        "_part", F.lag(last).over(Window.orderBy("_part")).alias("_end")
    )
    previous = F.coalesce(F.lag(last).over(inside), F.when(F.col("_row") == 0, F.col("_end")))
    return (
        ordered.join(F.broadcast(ends), "_part")
        .withColumn("_previous", previous)
        .withColumn(out, F.when(F.col("_previous.g").eqNullSafe(F.col(group)), F.col("_previous.v")))
        .drop("_part", "_row", "_end", "_previous")
    )
