"""Exact statistics that stay distributed when one group holds most of the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.session import settle

# Values up to 86,400 bins from zero fall into bins of equal width, by default a second of
# a duration in minutes; larger ones into 4,096 bins per doubling. So a group has a bounded
# number of bins, and a bin of a second has at most a million distinct microseconds.
ONE_SECOND = 1 / 60
EVEN_BINS = 86_400
BINS_PER_DOUBLING = 4_096


def _bin(value: Column, width: float) -> Column:
    """A whole number that never decreases as the value grows."""
    size = F.abs(value)
    even = F.floor(size / F.lit(width))
    wide = EVEN_BINS + F.floor(F.log2(size / F.lit(EVEN_BINS * width)) * BINS_PER_DOUBLING)
    number = F.when(even < EVEN_BINS, even).otherwise(wide)
    return F.when(value < 0, -1 - number).otherwise(number)


def _measurements(df: DataFrame, keys: Sequence[str], columns: Sequence[str], bin_width: float) -> DataFrame:
    """One row per known value of each column, with its bin number."""
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("metric"), F.nanvl(F.col(name).cast("double"), F.lit(None)).alias("value"))
            for name in columns
        ]
    )
    return (
        df.select(*keys, F.explode(pairs).alias("m"))
        .select(*keys, "m.metric", "m.value")
        .filter(F.col("value").isNotNull())
        .withColumn("bin", _bin(F.col("value"), bin_width))
    )


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    fractions: Mapping[str, float],
    bin_width: float = ONE_SECOND,
) -> DataFrame:
    """Exact interpolated percentiles: one row per group, columns ``<column>_<name>``.

    The built-in exact percentile keeps every distinct value of a group in one task.
    Here a first scan only counts values per narrow bin, which tells the bins that
    hold the wanted ranks, and a second scan looks at the values of those bins alone.
    Both scans combine on the map side, so no group is ever gathered. Group keys must
    not be null. ``df`` is read twice: settle it first when it is costly to derive.
    """
    keys = list(keys)
    cell = [*keys, "metric", "bin"]
    values = _measurements(df, keys, columns, bin_width)

    bins = values.groupBy(*cell).agg(F.count(F.lit(1)).alias("n"))
    targets = settle(_wanted_bins(bins, keys, fractions), "percentile-bins")

    # With few bins wanted, their list is broadcast and Spark filters during the scan; with
    # many, equal values are counted before the shuffle that meets the list.
    counted = (
        values.groupBy(*cell, "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(targets.select(*cell).distinct(), cell, "left_semi")
    )
    found = _at_ranks(counted, targets, keys)
    return found.groupBy(*keys).agg(
        *[
            F.max(F.when((F.col("metric") == column) & (F.col("name") == name), F.col("percentile"))).alias(
                f"{column}_{name}"
            )
            for column in columns
            for name in fractions
        ]
    )


def _wanted_bins(bins: DataFrame, keys: Sequence[str], fractions: Mapping[str, float]) -> DataFrame:
    """The bins that hold the wanted ranks, with the number of values below each, from the counts ``n`` of all bins."""
    cell = [*keys, "metric", "bin"]
    group = Window.partitionBy(*keys, "metric")
    up_to_bin = group.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = bins.withColumn("below", F.sum("n").over(up_to_bin) - F.col("n")).withColumn("group_size", F.sum("n").over(group))
    wanted = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("name"),
                    (F.lit(float(fraction)) * (F.col("group_size") - 1)).alias("position"),
                )
                for name, fraction in fractions.items()
            ]
        )
    )
    return (
        placed.select(*cell, "n", "below", wanted.alias("w"))
        .select(*cell, "n", "below", "w.name", "w.position")
        .filter(
            (F.ceil("position") >= F.col("below")) & (F.floor("position") < F.col("below") + F.col("n"))
        )
    )


def _between(low: Column, high: Column) -> Column:
    return low + (high - low) * (F.col("position") - F.floor("position"))


def _at_ranks(counted: DataFrame, targets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, metric, name and percentile, from the counts ``n`` of each value in the wanted bins."""
    cell = [*keys, "metric", "bin"]
    in_cell = Window.partitionBy(*cell).orderBy("value")
    ranked = counted.withColumn("through", F.sum("n").over(in_cell.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    first = F.col("below") + F.col("through") - F.col("n")
    last = F.col("below") + F.col("through") - 1

    def value_at(rank: Column) -> Column:
        return F.max(F.when(rank.between(first, last), F.col("value")))

    return (
        ranked.join(targets.drop("n"), cell)
        .groupBy(*keys, "metric", "name", "position")
        .agg(value_at(F.floor("position")).alias("low"), value_at(F.ceil("position")).alias("high"))
        .select(*keys, "metric", "name", _between(F.col("low"), F.col("high")).alias("percentile"))
    )


class Level(NamedTuple):
    """A set of group keys, and the fractions wanted of each column in its groups."""

    keys: tuple[str, ...]
    percentiles: Mapping[str, Mapping[str, float]]


def bin_counts(df: DataFrame, keys: Sequence[str], columns: Sequence[str], bin_width: float = ONE_SECOND) -> DataFrame:
    """n, mean and variance of the values of each bin, per keys and column. Bins of several groups add up: see ``rolled_up``."""
    value = F.col("value")
    return (
        _measurements(df, keys, columns, bin_width)
        .groupBy(*keys, "metric", "bin")
        .agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), F.var_pop(value).alias("variance"))
    )


def rolled_up(bins: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The bins' counts by fewer keys; groups with an unknown key are left out."""
    known = bins.na.drop(subset=list(keys)) if keys else bins
    return known.groupBy(*keys, "metric", "bin").agg(F.sum("n").alias("n"))


def moments(bins: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, metric, n, mean and std of the groups that the bins add up to."""
    known = bins.na.drop(subset=list(keys)) if keys else bins
    group = Window.partitionBy(*keys, "metric")
    overall = F.sum(F.col("n") * F.col("mean")).over(group) / F.sum("n").over(group)
    spread = F.sum(F.col("n") * (F.col("variance") + F.pow(F.col("mean") - F.col("overall"), 2)))
    return (
        known.withColumn("overall", overall)
        .groupBy(*keys, "metric")
        .agg(F.sum("n").alias("n"), F.max("overall").alias("mean"), spread.alias("spread"))
        .withColumn("std", F.when(F.col("n") > 1, F.sqrt(F.col("spread") / (F.col("n") - 1))))
        .drop("spread")
    )


def percentiles_at(
    df: DataFrame, bins: DataFrame, keys: Sequence[str], levels: Sequence[Level], bin_width: float = ONE_SECOND
) -> list[DataFrame]:
    """Exact percentiles at several levels by one more scan of ``df``: per level keys, metric, name and percentile.

    ``bins`` are the settled ``bin_counts`` of the finest ``keys``. Each level's wanted bins come from them; the values in
    all these bins are counted together, and the counts are added up to each level.
    """
    cell = ["metric", "bin"]
    targets = []
    for level in levels:
        own = rolled_up(bins.filter(F.col("metric").isin(*level.percentiles)), level.keys)
        by_fractions = [
            _wanted_bins(own.filter(F.col("metric") == column), level.keys, fractions)
            for column, fractions in level.percentiles.items()
        ]
        targets.append(settle(reduce(DataFrame.unionByName, by_fractions), "percentile-bins"))
    wanted = [
        bins.join(own.select(*level.keys, *cell).distinct(), [*level.keys, *cell], "left_semi").select(*keys, *cell)
        for level, own in zip(levels, targets)
    ]
    # keys may be unknown here: a group that has none at one level has one at another
    cells = settle(reduce(DataFrame.unionByName, wanted).distinct(), "wanted-cells")
    columns = sorted({column for level in levels for column in level.percentiles})
    values = _measurements(df, keys, columns, bin_width).groupBy(*keys, *cell, "value").agg(F.count(F.lit(1)).alias("n"))
    listed = cells.toDF(*[f"wanted_{name}" for name in cells.columns])
    same = reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"wanted_{name}")) for name in cells.columns])
    counted = settle(values.join(listed, same, "left_semi"), "wanted-values")
    found = []
    for level, own in zip(levels, targets):
        known = counted.na.drop(subset=list(level.keys)) if level.keys else counted
        added = known.groupBy(*level.keys, *cell, "value").agg(F.sum("n").alias("n"))
        found.append(_at_ranks(added, own, level.keys))
    return found


def _edges(bin_width: float) -> tuple[Column, Column]:
    """The least and the largest value that a bin may hold."""
    number = F.col("bin")
    place = F.when(number < 0, -1 - number).otherwise(number).cast("double")

    def edge(at: Column) -> Column:
        wide = F.lit(EVEN_BINS * bin_width) * F.pow(F.lit(2.0), (at - EVEN_BINS) / BINS_PER_DOUBLING)
        return F.when(at < EVEN_BINS, at * F.lit(bin_width)).otherwise(wide)

    low, high = edge(place), edge(place + 1)
    return F.when(number < 0, -high).otherwise(low), F.when(number < 0, -low).otherwise(high)


def estimated_percentiles(bins: DataFrame, keys: Sequence[str], fractions: Mapping[str, float], bin_width: float) -> DataFrame:
    """keys, metric, name, estimate and bound: percentiles from the counts of bins alone, without another scan.

    The values of a bin are taken as evenly spread over it, so a rank's value is wrong by less than the bin's width;
    ``bound`` is the largest width of the bins that the percentile lies in or between.
    """
    low, high = _edges(bin_width)
    targets = _wanted_bins(bins, keys, fractions).withColumn("low", low).withColumn("high", high)

    def value_at(rank: Column) -> Column:
        inside = (rank - F.col("below") + 0.5) / F.col("n")
        holds = (rank >= F.col("below")) & (rank < F.col("below") + F.col("n"))
        return F.max(F.when(holds, F.col("low") + (F.col("high") - F.col("low")) * inside))

    return (
        targets.groupBy(*keys, "metric", "name", "position")
        .agg(
            value_at(F.floor("position")).alias("first"),
            value_at(F.ceil("position")).alias("second"),
            F.max(F.col("high") - F.col("low")).alias("bound"),
        )
        .select(*keys, "metric", "name", _between(F.col("first"), F.col("second")).alias("estimate"), "bound")
    )


def numbered(df: DataFrame, order: Sequence[Column], into: str = "position", partitions: int | None = None) -> DataFrame:
    """``df`` with the place of each row in the whole order, from 1; rows that are equal in it come in any order.

    Rows are dealt out by ranges of the order; a range's rows are numbered on their own, and the sizes of the ranges before
    it are added, so no task sees all rows.
    """
    ranges = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = settle(df.repartitionByRange(ranges, *order).withColumn("range_no", F.spark_partition_id()), "ranges")
    before = Window.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range
    offsets = ranged.groupBy("range_no").agg(F.count(F.lit(1)).alias("size"))
    offsets = offsets.select("range_no", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("range_no").orderBy(*order)
    joined = ranged.join(F.broadcast(offsets), "range_no")
    return joined.withColumn(into, F.row_number().over(within) + F.col("offset")).drop("range_no", "offset")


def running_total(df: DataFrame, order: str, amount: str, into: str, partitions: int | None = None) -> DataFrame:
    """Sum of ``amount`` over all rows with a smaller ``order``; ``order`` must be unique.

    The rows are split into ordered ranges of like size, each range is summed on its
    own, and the totals of the ranges before it are added: no task sees all rows.
    """
    spark = df.sparkSession
    ranges = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = settle(
        df.repartitionByRange(ranges, F.col(order)).withColumn("range_no", F.spark_partition_id()),
        "ranges",
    )
    before = Window.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range
    offsets = (
        ranged.groupBy("range_no")
        .agg(F.sum(amount).alias("range_total"))
        .select("range_no", F.coalesce(F.sum("range_total").over(before), F.lit(0)).alias("offset"))
    )
    within = Window.partitionBy("range_no").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.join(F.broadcast(offsets), "range_no")
        .withColumn(into, F.coalesce(F.sum(amount).over(within), F.lit(0)) + F.col("offset"))
        .drop("range_no", "offset")
    )


def area_under_roc(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row ``auc, positives, negatives``; ``auc`` is 0.0 when only one class occurs.

    A positive beats each negative with a lower score and half of those with an equal
    one, so it is enough to count both classes per score and run a total over them.
    """
    known = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
    per_score = known.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("positives"),
        F.count_if(F.col(label) != 1).alias("negatives"),
    )
    ranked = running_total(per_score, "score", "negatives", "beaten")
    beaten = F.col("positives").cast("double") * (F.col("beaten") + F.col("negatives") / F.lit(2.0))
    sums = ranked.agg(
        F.sum(beaten).alias("won"),
        F.coalesce(F.sum("positives"), F.lit(0)).alias("positives"),
        F.coalesce(F.sum("negatives"), F.lit(0)).alias("negatives"),
    )
    pairs = F.col("positives").cast("double") * F.col("negatives")
    return sums.select(
        F.when(pairs > 0, F.col("won") / pairs).otherwise(F.lit(0.0)).alias("auc"), "positives", "negatives"
    )


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row ``mae, r2, n``; ``r2`` is null when the label never varies."""
    error = F.col(label) - F.col(prediction)
    sums = df.filter(error.isNotNull()).agg(
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mean_squared_error"),
        F.var_pop(label).alias("variance"),
        F.count(F.lit(1)).alias("n"),
    )
    r2 = F.when(F.col("variance") > 0, 1 - F.col("mean_squared_error") / F.col("variance"))
    return sums.select("mae", r2.alias("r2"), "n")


def with_share(counts: DataFrame, count: str = "n", into: str = "share", by: Sequence[str] = ()) -> DataFrame:
    """Add each row's share of the total, or of its ``by`` group. ``counts`` is already aggregated."""
    total = F.sum(count).over(Window.partitionBy(*by))
    return counts.withColumn(into, F.when(total > 0, F.col(count) / total.cast("double")))
