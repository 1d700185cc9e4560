"""Scans over groups of any size. Where the largest group is too large for a task, which a count tells first, rows are
dealt out by ranges of (group, order), so one group may lie in many tasks; else they are plain windows.

What crosses a border between two ranges is found from one small row for each group and range: the last value of a range
for the row behind it, the count of a range for all ranges behind it, the last few rows for a look-back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wildtally.storage import cut

RANGE = "_range"
#: A group of so many rows is one task of a window; where one is larger, all are dealt out by ranges. Results are the same.
GROUP_ROWS = 1_000_000
#: Rows of a group whose median is taken by sorting them; of a larger group values are counted in buckets first.
SORTED_ROWS = 100_000
#: Edges of buckets are approximate quantiles, so each holds about as many rows however values are spread.
BUCKETS, ACCURACY = 128, 10_000


def dealt(rows: DataFrame, by: str, order: Sequence[str]) -> DataFrame:
    """`rows` with the number of their range, written, so that every reader sees the same ranges; as they are, without one, if no group is too large for a task."""
    largest = rows.groupBy(by).count().agg(F.max("count")).first()[0]
    if (largest or 0) <= GROUP_ROWS:
        return rows
    return cut(rows.repartitionByRange(by, *order).withColumn(RANGE, F.spark_partition_id()))


def _inside(by: str, order: Sequence[str | Column]) -> W:
    return W.partitionBy(by, RANGE).orderBy(*order)


def _over(by: str) -> W:
    return W.partitionBy(by).orderBy(RANGE)


def _joined(rows: DataFrame, borders: DataFrame, by: str) -> DataFrame:
    """`rows` with the other columns of their group's and range's row; a null group is one as well."""
    mine = borders.withColumnsRenamed({by: "_by", RANGE: "_of"})
    return rows.join(mine, rows[by].eqNullSafe(mine["_by"]) & (rows[RANGE] == mine["_of"])).drop("_by", "_of")


def with_previous(rows: DataFrame, by: str, order: Sequence[str], value: str, name: str) -> DataFrame:
    """Dealt `rows` with the value of the row before in their group, null for the first; values are never null."""
    if RANGE not in rows.columns:
        return rows.withColumn(name, F.lag(value).over(W.partitionBy(by).orderBy(*order)))
    last = rows.groupBy(by, RANGE).agg(F.max_by(value, F.struct(*order)).alias("_last"))
    before = last.select(by, RANGE, F.lag("_last").over(_over(by)).alias("_border"))
    return _joined(rows, before, by).withColumn(name, F.coalesce(F.lag(value).over(_inside(by, order)), "_border")).drop("_border")


def with_running_sum(rows: DataFrame, by: str, order: Sequence[str], value: str, name: str) -> DataFrame:
    """Dealt `rows` with the sum of `value` over the rows of their group up to them."""
    if RANGE not in rows.columns:
        return rows.withColumn(name, F.sum(value).over(W.partitionBy(by).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)))
    sums = rows.groupBy(by, RANGE).agg(F.sum(value).alias("_sum"))
    before = sums.select(by, RANGE, F.coalesce(F.sum("_sum").over(_over(by).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_offset"))
    own = F.sum(value).over(_inside(by, order).rowsBetween(W.unboundedPreceding, 0))
    return _joined(rows, before, by).withColumn(name, own + F.col("_offset")).drop("_offset")


def with_look_back(rows: DataFrame, by: str, order: Sequence[str], value: Column, size: int, prefix: str) -> DataFrame:
    """Dealt `rows` with `value` of each of the `size` rows before in their group, the nearest in `<prefix>1`; null where there is none."""
    if RANGE not in rows.columns:
        return rows.withColumns({f"{prefix}{k}": F.lag(value, k).over(W.partitionBy(by).orderBy(*order)) for k in range(1, size + 1)})
    place = F.row_number().over(_inside(by, [F.desc(c) for c in order]))
    late = rows.withColumns({"_place": place, "_value": value}).filter(F.col("_place") <= size)
    nearest = F.transform(F.sort_array(F.collect_list(F.struct("_place", "_value"))), lambda x: x["_value"])
    tails = late.groupBy(by, RANGE).agg(nearest.alias("_tail"))  # `size` rows at most
    gathered = F.collect_list("_tail").over(_over(by).rowsBetween(-size, -1))  # a range has a row of the group at least
    halo = tails.select(by, RANGE, F.slice(F.flatten(F.reverse(gathered)), 1, size).alias("_halo"))
    at = F.row_number().over(_inside(by, order))
    seen = _joined(rows, halo, by).withColumns({"_at": at} | {f"{prefix}{k}": F.lag(value, k).over(_inside(by, order)) for k in range(1, size + 1)})
    within = {f"{prefix}{k}": F.when(F.col("_at") > k, F.col(f"{prefix}{k}")).otherwise(F.get("_halo", F.lit(k) - F.col("_at"))) for k in range(1, size + 1)}
    return seen.withColumns(within).drop("_halo", "_at")


def medians(rows: DataFrame, by: Sequence[str], value: str, name: str, sorted_rows: int = SORTED_ROWS) -> DataFrame:
    """The exact median of `value` in each group of `by`, nulls left out.

    A group of more than `sorted_rows` rows is narrowed first, for each of its two middle ranks: of the buckets between
    approximate quantiles two edges around the rank are taken, the values below, at and between them are counted, and
    only what lies between is looked at again, until few rows are left or the value is an edge. State is a number of
    buckets, whatever a group holds; counts are exact, so is the result.
    """
    rows = rows.filter(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    sizes = rows.groupBy(*by).agg(F.count("*").alias("_n"))
    if (sizes.agg(F.max("_n")).first()[0] or 0) <= sorted_rows:
        return rows.groupBy(*by).agg(F.median("_v").alias(name))
    large = cut(sizes.filter(F.col("_n") > sorted_rows))
    small = rows.join(large, [rows[c].eqNullSafe(large[c]) for c in by], "left_anti").groupBy(*by).agg(F.median("_v").alias(name))
    middle = F.posexplode(F.array(F.floor((F.col("_n") + 1) / 2), F.floor((F.col("_n") + 2) / 2))).alias("_which", "_rank")
    nothing = F.lit(None).cast("double")
    open_ = large.select(*by, "_n", nothing.alias("_low"), nothing.alias("_high"), middle)
    values = []
    while True:
        few = _inside_of(rows, open_.filter(F.col("_n") <= sorted_rows), by)
        place = F.row_number().over(W.partitionBy(*by, "_which").orderBy("_v"))
        values.append(few.withColumn("_place", place).filter(F.col("_place") == F.col("_rank")).select(*by, "_v"))
        open_ = open_.filter(F.col("_n") > sorted_rows)
        if open_.isEmpty():
            break
        counted = cut(_counted(rows, open_, by))
        values.append(counted.filter(F.col("_found").isNotNull()).select(*by, F.col("_found").alias("_v")))
        open_ = counted.filter(F.col("_found").isNull()).drop("_found")
    both = values[0]
    for more in values[1:]:
        both = both.unionByName(more)
    return small.unionByName(both.groupBy(*by).agg(F.sum(F.col("_v") * 0.5).alias(name)))


def _inside_of(rows: DataFrame, open_: DataFrame, by: Sequence[str]) -> DataFrame:
    """The rows between the two values of each open rank of their group, with its columns."""
    own = open_.withColumnsRenamed({c: f"_by_{c}" for c in by})
    between = (own["_low"].isNull() | (rows["_v"] > own["_low"])) & (own["_high"].isNull() | (rows["_v"] < own["_high"]))
    return rows.join(own, [rows[c].eqNullSafe(own[f"_by_{c}"]) for c in by] + [between]).drop(*[f"_by_{c}" for c in by])


def _counted(rows: DataFrame, open_: DataFrame, by: Sequence[str]) -> DataFrame:
    """Each open rank with its value (_found), or the narrower bounds that it lies between, the rows there and its rank among them."""
    key = [*by, "_which"]
    fractions = F.array(*[F.lit(k / BUCKETS) for k in range(BUCKETS + 1)])
    quantiles = _inside_of(rows, open_, by).groupBy(*key, "_rank", "_n", "_low", "_high").agg(F.percentile_approx("_v", fractions, ACCURACY).alias("_edges"))
    share = F.col("_rank") * BUCKETS / F.col("_n")
    edge = lambda at: F.get("_edges", F.least(F.greatest(at.cast("int"), F.lit(0)), F.lit(BUCKETS)))
    bounds = quantiles.select(*key, "_rank", "_n", "_low", "_high", edge(F.floor(share - 0.25)).alias("_a"), edge(F.ceil(share + 0.25)).alias("_b"))
    v, a, b, rank = (F.col(c) for c in ("_v", "_a", "_b", "_rank"))
    told = _inside_of(rows, bounds, by).groupBy(*key, "_rank", "_n", "_low", "_high", "_a", "_b").agg(
        F.count_if(v < a).alias("_below"), F.count_if(v == a).alias("_at_a"), F.count_if((v > a) & (v < b)).alias("_mid"), F.count_if((v == b) & (a != b)).alias("_at_b")
    )
    to_a = F.col("_below") + F.col("_at_a")
    to_mid, to_b = to_a + F.col("_mid"), to_a + F.col("_mid") + F.col("_at_b")
    found = F.when((rank > F.col("_below")) & (rank <= to_a), a).when((rank > to_mid) & (rank <= to_b), b)
    part = lambda below, mid, above: F.when(rank <= F.col("_below"), below).when(rank <= to_mid, mid).otherwise(above)
    return told.select(
        *key, found.alias("_found"), part(F.col("_below"), F.col("_mid"), F.col("_n") - to_b).alias("_n"), part(F.col("_low"), a, b).alias("_low"),
        part(a, b, F.col("_high")).alias("_high"), part(rank, rank - to_a, rank - to_b).alias("_rank"),
    )
