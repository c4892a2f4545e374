"""Ranks, running totals and top lists that do not gather a group in one task.

A window without a partition column, or with one that a third of the rows
share, sorts those rows in a single task. Two ways round that are used here:

* a report that keeps the first k rows only needs those k rows, and they hold
  everything that ranks before them;
* a full numbering cuts the ordered rows into ranges, sums inside each range,
  and adds the total of the ranges before it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from acadmetric.functions.exact import whole_div
from acadmetric.session import written

# Rows drawn to place the borders of ranges.
SAMPLE = 4096

# (column, descending?); missing values come last when ascending and first when descending.
Key = tuple[str, bool]


def _sorting(keys: Sequence[Key]) -> list[Column]:
    return [F.desc_nulls_first(c) if down else F.asc_nulls_last(c) for c, down in keys]


def _beyond(border: Column, keys: Sequence[Key]) -> Column:
    """Whether the row sorts after ``border`` (a struct of the keys) or at it."""
    after = F.lit(True)
    for c, down in reversed(keys):
        own, edge = F.col(c), border[c]
        first, second = (edge, own) if down else (own, edge)  # ``first`` is the larger one when the row comes later
        later = F.coalesce(first > second, first.isNull() & second.isNotNull())
        after = later | (own.eqNullSafe(edge) & after)
    return after


def ranged(df: DataFrame, keys: Sequence[Key], parts: int, name: str = "_range") -> DataFrame:
    """Add the number of the row's range in the order of ``keys``: a plain expression of the row.

    Borders come from the SAMPLE rows with the smallest hash of their keys, a scalar subquery of bounded size, so a
    task that runs again gives the same numbers.
    """
    names = [c for c, _ in keys]
    drawn = df.select(*names).orderBy(F.xxhash64(*names), *names).limit(SAMPLE)
    place = F.row_number().over(Window.orderBy(*_sorting(keys)))
    whole = F.count("*").over(Window.partitionBy())
    cut = whole_div((F.col("_place") - 1) * parts, F.col("_whole"))
    placed = drawn.withColumn("_place", place).withColumn("_whole", whole).withColumn("_cut", cut)
    borders = placed.groupBy("_cut").agg(F.min_by(F.struct(*names), "_place").alias("_border")).filter(F.col("_cut") > 0)
    listed = borders.agg(F.collect_list("_border").alias("b")).scalar()
    beyond = F.size(F.filter("_borders", lambda border: _beyond(border, keys)))
    return df.withColumn("_borders", listed).withColumn(name, beyond).drop("_borders")


def sum_before(df: DataFrame, weight: str, order: Sequence[Key], by: Sequence[str] = (), parts: int | None = None) -> DataFrame:
    """Add ``before``: the sum of ``weight`` over the rows that sort earlier within ``by``.

    ``order`` must be unique within ``by``. Rows are numbered by ranges of (by, order), ``parts`` of them (the session's
    shuffle partitions if not given), so a large group spans many ranges. One shuffle deals the rows to their ranges;
    totals of ranges are counted before they move.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = ranged(df, [*((c, False) for c in by), *order], parts)
    first = Window.unboundedPreceding
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(first, -1)
    offsets = (
        ranges.groupBy(*by, "_range").agg(F.sum(weight).alias("_total"))
        .withColumn("_offset", F.coalesce(F.sum("_total").over(earlier), F.lit(0)))
        .drop("_total")
    )
    inside = Window.partitionBy(*by, "_range").orderBy(*_sorting(order)).rowsBetween(first, -1)
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"o.{c}")) for c in (*by, "_range")]
    matched = ranges.withColumn("_inside", F.coalesce(F.sum(weight).over(inside), F.lit(0))).alias("r").join(
        offsets.alias("o"), same)
    return matched.select(
        *[F.col(f"r.{c}") for c in df.columns], (F.col("_inside") + F.col("_offset")).alias("before"))


def row_numbers(df: DataFrame, order: Sequence[Key], name: str = "rn", by: Sequence[str] = (),
                parts: int | None = None) -> DataFrame:
    """Consecutive numbers from 1 within ``by``; ``order`` must be unique there."""
    numbered = sum_before(df.withColumn("_one", F.lit(1).cast("bigint")), "_one", order, by, parts)
    return numbered.withColumn(name, F.col("before") + 1).drop("_one", "before")


def with_rows_before(df: DataFrame, back: int, order: Sequence[Key], by: Sequence[str], columns: Callable[[WindowSpec], dict[str, Column]],
                     parts: int | None = None) -> DataFrame:
    """Every row of ``df`` with ``columns`` of a window that looks at most ``back`` rows back within ``by``.

    ``columns`` gets the window and returns the new columns, such as ``F.lag(c, back).over(w)`` or a sum over
    ``w.rowsBetween(-back, 0)``. Rows are dealt by ranges of (by, order), so a group may hold any share of them; each range gets the
    last ``back`` rows before it as well, which are counted in its windows and left out of the result. These are at most
    ``back`` rows of each range, limited inside each task before they move. ``order`` must be unique within ``by``.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    whole = [*((c, False) for c in by), *order]
    ranges = ranged(df, whole, parts)
    backwards = [F.asc_nulls_last(c) if down else F.desc_nulls_first(c) for c, down in whole]
    last = ranges.withColumn("_from_end", F.row_number().over(Window.partitionBy("_range").orderBy(*backwards))).filter(
        F.col("_from_end") <= back).drop("_from_end")
    # At most ``back`` rows of each range meet here: the last rows before a range are the last ones of those of all ranges before it.
    numbered = last.withColumn("_number", F.row_number().over(Window.orderBy("_range", *_sorting(whole))))
    held = last.groupBy("_range").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    listed = held.select("_range", before.alias("_before")).agg(F.collect_list(F.struct("_range", "_before")).alias("l")).scalar()
    number = F.col("_number")
    into = F.filter("_ranges", lambda r: (number <= r["_before"]) & (number > r["_before"] - back))
    halo = numbered.withColumn("_ranges", listed).withColumn("_into", F.explode(into)).withColumn("_range", F.col("_into._range")).select(
        *df.columns, "_range", F.lit(False).alias("_own"))
    together = ranges.withColumn("_own", F.lit(True)).unionByName(halo).repartition("_range")
    window = Window.partitionBy("_range", *by).orderBy(*_sorting(order))
    made = columns(window)
    return together.withColumns(made).filter("_own").select(*df.columns, *made)


def peer_positions(df: DataFrame, value: str, by: Sequence[str] = (), descending: bool = False) -> DataFrame:
    """One row per (by, value): ``before``, ``peers`` and ``total`` row counts.

    rank = before + 1, cume_dist = (before + peers) / total and percent_rank =
    before / (total - 1). Equal values are counted before anything is ordered,
    so a value that a third of the rows share is one row here.
    """
    peers = df.groupBy(*by, value).agg(F.count("*").alias("peers"))
    placed = sum_before(peers, "peers", [(value, descending)], by)
    totals = placed.groupBy(*by).agg(F.sum("peers").alias("total"))
    if not by:
        return placed.withColumn("total", totals.scalar())
    return placed.join(totals, list(by))


def with_peer_positions(df: DataFrame, value: str, by: Sequence[str] = (), descending: bool = False) -> DataFrame:
    """Every row of ``df`` with the counts of :func:`peer_positions`.

    ``df`` is used twice: where it is an aggregate, its exchange is reused.
    """
    positions = peer_positions(df, value, by, descending)
    keys = [F.col(f"d.{c}").eqNullSafe(F.col(f"p.{c}")) for c in (*by, value)]
    return df.alias("d").join(positions.alias("p"), keys).select("d.*", "p.before", "p.peers", "p.total")


def tile(row: Column, rows: Column, tiles: int) -> Column:
    """The tile (1..tiles) of row number ``row`` among ``rows``; earlier tiles take the remainder."""
    size, extra = whole_div(rows, F.lit(tiles)), rows % tiles
    wide = extra * (size + 1)
    in_wide = whole_div(row - 1, size + 1) + 1
    in_narrow = extra + whole_div(row - 1 - wide, F.greatest(size, F.lit(1))) + 1
    return F.when(row <= wide, in_wide).otherwise(in_narrow).cast("bigint")


def top_ranked(df: DataFrame, value: str, ties: Sequence[Column], limit: int | None, name: str = "ranking") -> DataFrame:
    """The first ``limit`` rows by ``value`` descending, with their rank among all rows; all rows without a limit.

    Everything that ranks above a kept row is kept too, so the rank is
    computed on the kept rows; nulls come first when descending.
    """
    order = F.col(value).desc_nulls_first()
    if limit is None:
        placed = with_peer_positions(df, value, descending=True)
        return placed.withColumn(name, F.col("before") + 1).drop("before", "peers", "total").orderBy(order, *ties)
    top = df.orderBy(order, *ties).limit(limit)
    return top.withColumn(name, F.rank().over(Window.orderBy(order)).cast("bigint"))


def top_numbered(df: DataFrame, order: Sequence[Key], limit: int | None, name: str, by: Sequence[str] = ()) -> DataFrame:
    """The first ``limit`` rows by (by, order), numbered from 1 within ``by``; all rows without a limit.

    The kept rows are a prefix of each group, so they hold every row that a number depends on.
    """
    if limit is None:
        return row_numbers(df, order, name, by)
    top = df.orderBy(*by, *_sorting(order)).limit(limit)
    return top.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*_sorting(order))).cast("bigint"))


def first_rows(df: DataFrame, group: str, order: Sequence[Column], least: int, limit: int | None) -> DataFrame:
    """The first ``limit`` rows by (group, order) among groups of ``least`` rows or more; all of them without a limit.

    At most ``limit`` groups can contribute, and nothing is sorted but the
    kept rows. They are a prefix of each group's history: a window that looks
    back finds everything it needs in them.
    """
    names = df.groupBy(group).agg(F.count("*").alias("_n")).filter(F.col("_n") >= least).select(group)
    if limit is None:
        return df.join(names, group)
    return df.join(names.orderBy(group).limit(limit), group).orderBy(group, *order).limit(limit)


def top_values(df: DataFrame, value: str, by: Sequence[str], limit: int | None) -> DataFrame:
    """The ``limit`` largest distinct values per group with ``above``, ``peers`` and ``total`` row counts; all without a limit.

    Only ``limit`` values per group leave each task (WindowGroupLimit), after
    equal values have been counted.
    """
    if limit is None:
        return peer_positions(df, value, by, descending=True).withColumnRenamed("before", "above")
    peers = df.groupBy(*by, value).agg(F.count("*").alias("peers"))
    order = F.col(value).desc_nulls_first()
    ranked = peers.withColumn("_rn", F.row_number().over(Window.partitionBy(*by).orderBy(order)))
    top = ranked.filter(F.col("_rn") <= limit).drop("_rn")
    earlier = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    top = top.withColumn("above", F.coalesce(F.sum("peers").over(earlier), F.lit(0)))
    totals = df.groupBy(*by).agg(F.count("*").alias("total"))
    return top.join(totals, list(by))


def exact_percentile(df: DataFrame, value: str, share: float, parts: int = 256, enough: int = 100_000, name: str = "percentile") -> DataFrame:
    """One row: the interpolated percentile of a numeric column, as double; null without values.

    The two rows around the wanted place are sought by refinement: equal values are counted first, then the values are cut into
    ``parts`` ranges and counted, and only the ranges that hold the two places are cut again, until a range is one value or
    ``enough`` values are left. Counts and ends of ranges reach the driver; what is kept is written between rounds.
    """
    spark = df.sparkSession
    values = df.select(F.col(value).cast("double").alias("v")).filter("v IS NOT NULL").groupBy("v").agg(F.count("*").alias("n"))
    rest, total, skipped, found = written(values, "percentile"), None, 0, {}
    while True:
        counted = sorted(ranged(rest, [("v", False)], parts).groupBy("_range").agg(
            F.sum("n").alias("n"), F.count("*").alias("values"), F.min("v").alias("low"), F.max("v").alias("high")).collect(),
            key=lambda r: r["_range"])
        if total is None:
            total = sum(r.n for r in counted)
            if not total:
                return spark.createDataFrame([(None,)], f"{name} double")
            at = (total - 1) * share
            wanted = sorted({math.floor(at), min(total - 1, math.ceil(at))})
        begin, kept = skipped, []
        for r in counted:
            inside = [place for place in wanted if begin <= place < begin + r.n]
            if inside and r.low == r.high:
                found |= dict.fromkeys(inside, r.low)
            elif inside:
                kept.append((begin, r))
            begin += r.n
        if not kept:
            break
        # The two places are neighbours: between the kept ranges there is nothing.
        skipped = kept[0][0]
        rest = written(rest.filter(F.col("v").between(kept[0][1].low, kept[-1][1].high)), "percentile")
        if sum(r["values"] for _, r in kept) <= enough:
            ends = F.sum("n").over(Window.orderBy("v"))  # at most ``enough`` rows
            for r in rest.withColumn("end", ends).filter(F.col("end") > wanted[0] - skipped).orderBy("v").limit(len(wanted)).collect():
                found |= {p: r.v for p in wanted if skipped + r.end - r.n <= p < skipped + r.end}
            break
    low, high = found[wanted[0]], found[wanted[-1]]
    return spark.createDataFrame([(low + (high - low) * (at - wanted[0]),)], f"{name} double")
