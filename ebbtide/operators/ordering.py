"""Exact ranks, quantiles and running totals over a whole table.

A window without PARTITION BY, or one per class, would put the table into one task. Here
the order is cut into ranges first: each range is handled by itself and the ranges are
tied together by their totals, of which there are only as many as ranges.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Distinct values that one window task may sort in the last step of a quantile.
EXACT_VALUES = 10_000
ROUGHLY = 0.1  # relative error of a distinct count that only tells sizes apart
RANGES = 256  # at least; a cluster with more shuffle partitions has as many


@dataclass
class _Search:
    """Looks for the values at two neighbouring ranks of a series."""

    series: str
    value: Column
    low_rank: int
    high_rank: int
    n: int  # values inside the bracket
    distinct: int  # about
    low: float | None = None  # inclusive bounds of the bracket, none at first
    high: float | None = None
    below: int = 0  # values under it

    def inside(self) -> Column:
        return self.value if self.low is None else F.when(self.value.between(F.lit(self.low), F.lit(self.high)), self.value)


def _narrow(df: DataFrame, searches: list[_Search]) -> list[_Search]:
    """Bracket the ranks by approximate percentiles; returns the searches that got on."""
    cuts = []
    for i, s in enumerate(searches):
        p = (s.low_rank - s.below) / max(s.n - 1, 1)
        around = [min(max(p + d, 0.0), 1.0) for d in (-0.001, 0.001)]
        cuts.append(F.percentile_approx(s.inside(), around, 2_000).alias(f"c{i}"))  # off by 1/2000 at most
    cut = df.agg(*cuts).first()
    counts = []
    for i, s in enumerate(searches):
        low, high = cut[f"c{i}"]
        between = F.when(s.value.between(F.lit(low), F.lit(high)), s.value)
        counts += [
            F.count_if(s.value < low).alias(f"b{i}"),
            F.count(between).alias(f"n{i}"),
            F.approx_count_distinct(between, ROUGHLY).alias(f"d{i}"),
        ]
    found = df.agg(*counts).first()
    moved = []
    for i, s in enumerate(searches):
        below, n = found[f"b{i}"], found[f"n{i}"]
        # an approximation that missed a rank, or gained nothing, leaves the old bracket
        if below <= s.low_rank and s.high_rank < below + n < below + s.n:
            s.low, s.high = cut[f"c{i}"]
            s.below, s.n, s.distinct = below, n, found[f"d{i}"]
            moved.append(s)
    return moved


def _look_up(df: DataFrame, searches: list[_Search]) -> dict[tuple[str, int], float]:
    """Values at the ranks, from a histogram per bracket that a window sums up."""
    brackets: dict[tuple, list[_Search]] = {}
    for s in searches:
        brackets.setdefault((s.series, s.low, s.high), []).append(s)
    values = F.array(
        *[F.struct(F.lit(g).alias("g"), ss[0].inside().cast("double").alias("v")) for g, ss in enumerate(brackets.values())]
    )
    histogram = (
        df.select(F.explode(values).alias("x")).select("x.g", "x.v").where("v IS NOT NULL").groupBy("g", "v").count()
    )
    counted = histogram.withColumn("up_to", F.sum("count").over(Window.partitionBy("g").orderBy("v")))
    wanted = [(g, s, rank) for g, ss in enumerate(brackets.values()) for s in ss for rank in {s.low_rank, s.high_rank}]
    at = counted.agg(
        *[
            F.min(F.when((F.col("g") == g) & (F.col("up_to") > rank - s.below), F.col("v"))).alias(f"r{j}")
            for j, (g, s, rank) in enumerate(wanted)
        ]
    ).first()
    return {(s.series, rank): at[f"r{j}"] for j, (_, s, rank) in enumerate(wanted)}


def exact_quantiles(
    df: DataFrame, series: dict[str, Column], probs: list[float], max_values: int = EXACT_VALUES
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of each series; None for one without values.

    Every pass is two aggregates over the columns concerned. Ranks are bracketed by
    approximate percentiles at least once, and again, some hundredfold closer per pass, while
    a bracket holds more than `max_values` distinct values; what is sorted in the end has that
    bound per quantile.
    """
    sizes = df.agg(
        *[F.count(c).alias(f"n_{s}") for s, c in series.items()],
        *[F.approx_count_distinct(c, ROUGHLY).alias(f"d_{s}") for s, c in series.items()],
    ).first()
    searches = []
    for s, value in series.items():
        n = sizes[f"n_{s}"]
        for low in {int((n - 1) * p) for p in probs} if n else ():
            searches.append(_Search(s, value, low, min(low + 1, n - 1), n, sizes[f"d_{s}"]))
    wide = searches
    while wide:
        wide = [s for s in _narrow(df, wide) if s.distinct > max_values]
    at = _look_up(df, searches) if searches else {}

    def quantile(s: str, p: float) -> float | None:
        n = sizes[f"n_{s}"]
        if not n:
            return None
        place = (n - 1) * p
        low, high = at[s, int(place)], at[s, min(int(place) + 1, n - 1)]
        return low + (high - low) * (place - int(place))

    return {s: [quantile(s, p) for p in probs] for s in series}


def exact_medians(df: DataFrame, columns: list[str], max_values: int = EXACT_VALUES) -> dict[str, float | None]:
    found = exact_quantiles(df, {c: F.col(c) for c in columns}, [0.5], max_values)
    return {c: found[c][0] for c in columns}


def grouped_medians(values: DataFrame, group: list[str], value: str, max_values: int = EXACT_VALUES) -> DataFrame:
    """group columns, median: the exact median of every group that has a value.

    For groups that are few and rows that are many: what is known of each group's bracket is a broadcast
    row. A pass cuts all brackets to those around approximate percentiles and counts what lies below and
    inside; passes go on while a bracket that still shrinks holds more than max_values different values.
    """
    rows = values.select(*group, F.col(value).cast("double").alias("v")).where("v IS NOT NULL")
    spark, keys = values.sparkSession, T.StructType([values.schema[c] for c in group])
    bracket_type = T.StructType([*keys, *[T.StructField(c, T.DoubleType()) for c in ("low", "high")], *[T.StructField(c, T.LongType()) for c in ("n", "below", "inner")]])
    sizes = rows.groupBy(*group).agg(F.count("*").alias("n"), F.approx_count_distinct("v", ROUGHLY).alias("distinct")).collect()
    brackets = {tuple(r[c] for c in group): (float("-inf"), float("inf"), r["n"], 0, r["n"]) for r in sizes}

    def known() -> DataFrame:
        return F.broadcast(spark.createDataFrame([(*k, *b) for k, b in brackets.items()], bracket_type))

    wide = {tuple(r[c] for c in group) for r in sizes if r["distinct"] > max_values}
    while wide:
        place = ((F.col("n") - 1) / 2 - F.col("below")) / F.greatest(F.col("inner") - 1, F.lit(1))
        inside = rows.join(known(), group).where(F.col("v").between(F.col("low"), F.col("high")))
        cut = inside.groupBy(*group).agg(F.first(place).alias("p"), F.percentile_approx("v", [i / 1000 for i in range(1001)], 2_000).alias("c"))
        at = lambda d: F.get("c", F.least(F.greatest(F.round(F.col("p") * 1000).cast("int") + d, F.lit(0)), F.lit(1000)))
        cuts = spark.createDataFrame(cut.select(*group, at(-1).alias("l"), at(1).alias("h")).collect(), T.StructType([*keys, T.StructField("l", T.DoubleType()), T.StructField("h", T.DoubleType())]))
        between = F.when(F.col("v").between(F.col("l"), F.col("h")), F.col("v"))
        found = rows.join(F.broadcast(cuts), group).groupBy(*group, "l", "h").agg(
            F.count_if(F.col("v") < F.col("l")).alias("below"), F.count(between).alias("inner"), F.approx_count_distinct(between, ROUGHLY).alias("distinct")
        )
        moved = set()
        for r in found.collect():
            key = tuple(r[c] for c in group)
            n, had = brackets[key][2], brackets[key][4]
            first = (n - 1) // 2
            if key in wide and r["below"] <= first and min(first + 1, n - 1) < r["below"] + r["inner"] < r["below"] + had:
                brackets[key] = (r["l"], r["h"], n, r["below"], r["inner"])
                if r["distinct"] > max_values:
                    moved.add(key)
        wide = moved
    inside = rows.join(known(), group).where(F.col("v").between(F.col("low"), F.col("high")))
    up_to = F.sum("count").over(Window.partitionBy(*group).orderBy("v")) + F.col("below")
    counted = inside.groupBy(*group, "n", "below", "v").count().withColumn("up_to", up_to)
    first = F.floor((F.col("n") - 1) / 2)
    ends = [F.min(F.when(F.col("up_to") > place, F.col("v"))) for place in (first, F.least(first + 1, F.col("n") - 1))]
    halfway = F.when(F.first("n") % 2 == 0, (ends[0] + ends[1]) / 2).otherwise(ends[0])
    return counted.groupBy(*group).agg(halfway.alias("median"))


def default_ranges(df: DataFrame) -> int:
    return max(RANGES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def cut_into_ranges(df: DataFrame, key: str, ranges: int | None = None) -> DataFrame:
    """Add `range_no`, ascending with the double column `key`, at about even row counts.

    The bounds are plain numbers found once, so every task and every retry agrees on them.
    """
    ranges = ranges or default_ranges(df)
    probs = ", ".join(str(i / ranges) for i in range(1, ranges))
    bounds = df.agg(F.expr(f"percentile_approx(`{key}`, array({probs}), {20 * ranges})").alias("b")).first()["b"] or [0.0]
    splits = [float("-inf"), *sorted({float(b) for b in bounds}), float("inf")]
    cut = Bucketizer(splits=splits, inputCol=key, outputCol="range_no", handleInvalid="keep").transform(df)
    return cut.withColumn("range_no", F.col("range_no").cast("int"))


def running_totals(
    df: DataFrame,
    key: str,
    sums: dict[str, Column],
    descending: bool = False,
    ranges: int | None = None,
    totals: bool = False,
) -> DataFrame:
    """Per distinct `key`: the sums of that key, and as `cum_<name>` of all keys up to it; with
    `totals` also, as `all_<name>`, of all keys.

    Rows are summed by key before anything is moved. The table of range totals has at most
    `ranges` + 1 rows, which bounds both its window and its broadcast.
    """
    per_key = cut_into_ranges(df.where(F.col(key).isNotNull()), key, ranges).groupBy("range_no", key)
    grouped = per_key.agg(*[c.alias(s) for s, c in sums.items()])
    direction = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    before = Window.orderBy(direction("range_no")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = grouped.groupBy("range_no").agg(*[F.sum(s).alias(s) for s in sums])
    whole = [F.sum(s).over(Window.partitionBy(F.lit(1))).alias(f"all_{s}") for s in sums] if totals else []
    offsets = offsets.select(
        "range_no", *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"off_{s}") for s in sums], *whole
    )
    within = Window.partitionBy("range_no").orderBy(direction(key)).rowsBetween(Window.unboundedPreceding, 0)
    local = grouped.select("*", *[F.sum(s).over(within).alias(f"in_{s}") for s in sums])
    return local.join(F.broadcast(offsets), "range_no").select(
        key,
        *sums,
        *[(F.col(f"off_{s}") + F.col(f"in_{s}")).alias(f"cum_{s}") for s in sums],
        *[f"all_{s}" for s in sums if totals],
    )


HASH_DIGITS = 4  # leading hex digits of the md5 that name a bucket


def hash_order(id_column: str, *seed: object) -> Column:
    """md5 of seed and key: the same pseudo-random order on any engine."""
    return F.md5(F.concat_ws("-", *[s if isinstance(s, Column) else F.lit(str(s)) for s in seed], F.col(id_column)))

