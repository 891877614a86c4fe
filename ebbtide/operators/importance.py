"""Permutation importance."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.operators.ordering import hash_order

REPEATS = 10


def permutation_importance(
    df: DataFrame,
    columns: list[str],
    predict: Callable[[DataFrame], DataFrame],
    label: str = "exited",
    key: str = "customer_id",
    repeats: int = REPEATS,
    seed: int = 42,
    cells: int | None = None,
    few: int | None = None,
) -> DataFrame:
    """Mean drop of accuracy when one column is shuffled, over several shuffles.

    For each repeat the rows are put into md5 order and every row takes the values of the
    next one, the last those of the first. The order is cut into cells (as many as shuffle
    partitions, if not given), and the last row of a cell takes the first row of the next one
    from a table of a row per cell: the result is the same for any number of cells. One
    shuffle of the rows serves all columns of a repeat; `predict` adds a `prediction` column
    to rows that carry the given columns.

    Of a column with at most `few` values (half the repeats, if not given) each row is scored once
    per value, and the shuffles look their predictions up; other columns are scored per repeat. The
    numbers are the same for any `few`, as long as `predict` goes by the columns alone.
    """
    cells = cells or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    few = repeats // 2 if few is None else few
    rows = df.select(key, label, *columns)
    values = F.struct(*columns)
    # a sketch decides how a column is scored, not what comes of it
    counts = rows.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first()
    valued = [c for c in columns if counts[c] <= few]
    drawn = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("repeat"))
    drawn = drawn.withColumn("_hash", hash_order(key, seed, F.col("repeat").cast("string")))
    # the leading digits of the hash ascend with it, and so do the cells
    cell = F.floor(F.conv(F.substring("_hash", 1, 8), 16, 10).cast("long") * cells / F.lit(1 << 32)).cast("int")
    drawn = drawn.withColumn("_cell", cell)
    firsts = drawn.groupBy("repeat", "_cell").agg(F.min_by(values, F.struct("_hash", key)).alias("_first"))
    along = Window.partitionBy("repeat").orderBy("_cell")  # of cells, not of rows
    ends = firsts.select(
        "repeat", "_cell", F.coalesce(F.lead("_first").over(along), F.first("_first").over(along)).alias("_next")
    )
    line = Window.partitionBy("repeat", "_cell").orderBy("_hash", key)
    paired = drawn.withColumn("_lead", F.lead(values).over(line)).join(F.broadcast(ends), ["repeat", "_cell"])
    paired = paired.withColumn("_partner", F.coalesce("_lead", "_next"))
    # position 0 changes nothing and gives the score to compare with, the same for all repeats
    positions = F.array(*[F.lit(i) for i, c in enumerate(columns, 1) if c not in valued]).cast("array<int>")
    positions = F.when(F.col("repeat") == 0, F.concat(F.array(F.lit(0)), positions)).otherwise(positions)
    spread = paired.withColumn("_changed", F.explode(positions))
    spread = spread.withColumns({
        c: F.when(F.col("_changed") == i, F.col(f"_partner.{c}")).otherwise(F.col(c)) for i, c in enumerate(columns, 1) if c not in valued
    }).select("repeat", "_changed", label, *columns)
    hits = (
        predict(spread)
        .groupBy("_changed", "repeat")
        .agg(F.avg((F.col("prediction") == F.col(label)).cast("int")).alias("accuracy"))
    )
    if valued:
        hits = hits.unionByName(_hits_by_value(rows, paired, columns, valued, predict, label, key))
    # one row per (column, repeat) from here on
    base = F.max(F.when(F.col("_changed") == 0, F.col("accuracy"))).over(Window.partitionBy(F.lit(1)))
    drops = hits.withColumn("base", base).where("_changed > 0")
    name = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("_changed"))
    return drops.groupBy(name.alias("feature")).agg(
        F.avg(F.col("base") - F.col("accuracy")).alias("importance_mean"),
        F.stddev_pop(F.col("base") - F.col("accuracy")).alias("importance_std"),
    )


def _hits_by_value(
    rows: DataFrame,
    paired: DataFrame,
    columns: list[str],
    valued: list[str],
    predict: Callable[[DataFrame], DataFrame],
    label: str,
    key: str,
) -> DataFrame:
    """_changed, repeat, accuracy of the columns with few values, from a table of predictions by row and value."""
    found = rows.agg(*[F.collect_set(F.struct(c)).alias(c) for c in valued]).first()
    options = [(c, value[0]) for c in valued for value in found[c]]  # few per column
    is_value = lambda column, value: column.eqNullSafe(F.lit(value))
    # option 0 is the row as it is, which is also what its own values give
    own = F.array(F.lit(0), *[F.when(~is_value(F.col(c), v), F.lit(n)) for n, (c, v) in enumerate(options, 1)])
    spread = rows.withColumn("_row", F.struct(*columns)).withColumn("_option", F.explode(F.array_compact(own)))
    for c in valued:
        changed = F.col(c)
        for n, (other, value) in enumerate(options, 1):
            if other == c:
                changed = F.when(F.col("_option") == n, F.lit(value).cast(rows.schema[c].dataType)).otherwise(changed)
        spread = spread.withColumn(c, changed)
    scored = predict(spread.select(key, "_row", "_option", label, *columns))
    scored = scored.groupBy(F.col(key).alias("_key"), "_row").agg(F.map_from_entries(F.collect_set(F.struct("_option", "prediction"))).alias("_scores"))
    looked = paired.join(scored, paired[key].eqNullSafe(scored["_key"]) & F.struct(*columns).eqNullSafe(F.col("_row")))

    def accuracy(c: str) -> Column:
        option = F.coalesce(*[F.when(is_value(F.col(f"_partner.{c}"), v), F.lit(n)) for n, (other, v) in enumerate(options, 1) if other == c])
        prediction = F.coalesce(F.try_element_at("_scores", option), F.try_element_at("_scores", F.lit(0)))
        return F.avg((prediction == F.col(label)).cast("int"))

    by_repeat = looked.groupBy("repeat").agg(*[accuracy(c).alias(f"accuracy {n}") for n, c in enumerate(valued)])
    each = [F.struct(F.lit(columns.index(c) + 1).alias("_changed"), F.col(f"accuracy {n}").alias("accuracy")) for n, c in enumerate(valued)]
    return by_repeat.select("repeat", F.inline(F.array(*each))).select("_changed", "repeat", "accuracy")


def top_features(importances: DataFrame, n: int = 10) -> DataFrame:
    return importances.orderBy(F.desc("importance_mean"), F.asc("feature")).limit(n)
