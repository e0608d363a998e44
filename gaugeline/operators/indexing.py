"""Row positions per series that do not depend on partitioning and survive hot series.

A plain ``row_number() OVER (PARTITION BY series ...)`` sorts a whole series in
one task. Here a series is first cut into ranges of its order key of about
``split_rows`` rows, and a row's position is the number of rows in earlier
ranges plus its position in its own range:

1. one narrow pass keeps a content-hashed sample of order keys, a fixed number
   of them per ``split_rows`` rows, and writes it; a series with no more sampled
   keys than one range has is not cut, and if that holds for all of them the
   rest is skipped;
2. every so-many-th sampled key of a series is a cut point;
3. one narrow pass counts the rows of every range; running sums give the rows
   before each of them;
4. every row of a cut series looks up its range and offset and is numbered
   inside (series, range).

The cut points of step 2 are broadcast, so there must not be more than about
``max_ranges`` of them. Where the data need more, the sample is thinned until
that holds, and these coarse ranges are cut again by the whole sample. The fine
cut points meet the rows in an equi-join on (series, coarse range, salt), so
neither the rows of one task nor the broadcast grow with the table.

Steps 1 and 3 run when the plan is built; their results are small, written below
the shared folder of the session, and functions of row content only, so a
recomputed task gives the same answer.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.functions.names import col, cols, name_list
from gaugeline.session import written

SPLIT_ROWS = 2_000_000
MAX_RANGES = 10_000
SAMPLES_PER_RANGE = 32

_RANGE = "__range"
_BEFORE = "__before"
_COARSE = "__coarse"
_FINE = "__fine"
_CUTS = "__cuts"
_OFFSETS = "__offsets"
_ALL = "__all"
_FINE_BITS = 32


def _same(names: list[str], keys: list[str]) -> Column:
    """Null-safe match of columns with a lookup table's key columns."""
    match = col(names[0]).eqNullSafe(F.col(keys[0]))
    for name, key in zip(names[1:], keys[1:]):
        match = match & col(name).eqNullSafe(F.col(key))
    return match


def _search(df: DataFrame, order: list[str], name: str, longest: int) -> DataFrame:
    """Add ``name``: how many points of the array ``__cuts`` are at or before the row's order key.

    A binary search, one halving per column, so that it compiles into the
    generated code of its stage. Rows without an array get 0.
    """
    quoted = ["`" + o.replace("`", "``") + "`" for o in order]
    key = "named_struct(" + ", ".join(f"'o{i}', {q}" for i, q in enumerate(quoted)) + ")"
    columns, found = [f"{key} AS __at"], "0"
    steps = [1 << i for i in reversed(range(longest.bit_length()))]
    for i, step in enumerate(steps):
        columns.append(
            f"{found} + if(get({_CUTS}, {found} + {step - 1}) <= __at, {step}, 0) AS __found{i}"
        )
        found = f"__found{i}"
    searched = df.selectExpr("*", *columns).withColumnRenamed(found, name)
    return searched.drop("__at", *[f"__found{i}" for i in range(len(steps) - 1)])


class _Ranges:
    """The cut points of a table: coarse ones to broadcast, fine ones to join where needed."""

    def __init__(self, df: DataFrame, order: list[str], series: list[str], split_rows: int, max_ranges: int):
        self.order, self.series = order, series
        self.keys = [f"__key{i}" for i in range(len(series))]
        self.fine = None
        step = max(1, min(SAMPLES_PER_RANGE, split_rows))
        top = 1 << 63
        chance = step * top // max(1, split_rows)
        draw = F.shiftrightunsigned(F.xxhash64(*cols(series), *cols(order)), 1)
        sample = written(
            df.select(
                *[col(s).alias(k) for s, k in zip(series, self.keys)],
                *[col(o).alias(f"o{i}") for i, o in enumerate(order)],
                draw.alias("__draw"),
            )
            .where(F.col("__draw") <= F.lit(min(chance, top - 1)))
            .hint("rebalance")
        )
        points, most = (
            sample.groupBy(*self.keys)
            .agg(F.count(F.lit(1)).alias("n"))
            .agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0)))
            .first()
        )
        self.cut = most > step
        if not self.cut:
            return
        self.thin = max(1, math.ceil(points / (step * max_ranges)))
        kept = sample.where(F.col("__draw") <= F.lit(min(chance, top - 1) // self.thin)) if self.thin > 1 else sample
        self.coarse = written(self._points(kept, self.keys, step))
        self.longest = self._longest(self.coarse)
        if self.thin > 1:
            names = [f"o{i}" for i in range(len(order))]
            placed = self._coarse_range(sample, names, self.keys)
            self.fine = written(self._points(placed, [*self.keys, _COARSE], step))
            self.longest_fine = self._longest(self.fine)

    def _points(self, sample: DataFrame, by: list[str], step: int) -> DataFrame:
        """Every ``step``-th sampled key of each group, in order."""
        at = F.struct(*[F.col(f"o{i}") for i in range(len(self.order))])
        sampled = sample.groupBy(*by).agg(F.sort_array(F.collect_list(at)).alias("__points"))
        chosen = F.transform(
            F.sequence(F.lit(step), F.size("__points") - 1, F.lit(step)), lambda i: F.get("__points", i)
        )
        return sampled.where(F.size("__points") > step).select(*by, chosen.alias(_CUTS))

    @staticmethod
    def _longest(cuts: DataFrame) -> int:
        return cuts.agg(F.coalesce(F.max(F.size(_CUTS)), F.lit(0))).first()[0]

    def _coarse_range(self, df: DataFrame, order: list[str], series: list[str]) -> DataFrame:
        """Add ``__coarse`` by the broadcast cut points."""
        aliased = [f"{k}_cut" for k in self.keys]
        table = self.coarse.select(*[F.col(k).alias(a) for k, a in zip(self.keys, aliased)], _CUTS)
        joined = df.join(F.broadcast(table), _same(series, aliased), "left")
        return _search(joined, order, _COARSE, self.longest).drop(_CUTS, *aliased)

    def fine_lookup(self, df: DataFrame, table: DataFrame, carried: list[str]) -> DataFrame:
        """Join ``table`` (keys, ``__coarse``, ...) to rows; salted, so that a range is no task's key."""
        aliased = [*[f"{k}_fine" for k in self.keys], f"{_COARSE}_fine", "__salt_fine"]
        salts = F.explode(F.sequence(F.lit(0), F.lit(self.thin - 1)))
        spread = table.select(
            *[F.col(k).alias(a) for k, a in zip([*self.keys, _COARSE], aliased)], *carried, salts.alias("__salt_fine")
        )
        salted = df.withColumn("__salt", F.pmod(F.xxhash64(*cols(self.order)), F.lit(self.thin)).cast("int"))
        joined = salted.join(spread, _same([*self.series, _COARSE, "__salt"], aliased), "left")
        return joined.drop("__salt", *aliased)

    def count(self, df: DataFrame) -> DataFrame:
        """Rows of every (series, coarse, fine) range."""
        narrow = df.select(*cols(dict.fromkeys([*self.series, *self.order])))
        ranged = self._coarse_range(narrow, self.order, self.series)
        if self.fine is None:
            ranged = ranged.withColumn(_FINE, F.lit(0))
        else:
            looked_up = self.fine_lookup(ranged, self.fine, [_CUTS])
            ranged = _search(looked_up, self.order, _FINE, self.longest_fine)
        keys = [col(s).alias(k) for s, k in zip(self.series, self.keys)]
        return written(ranged.groupBy(*keys, _COARSE, _FINE).agg(F.count(F.lit(1)).alias("__rows")))


def place_rows(
    df: DataFrame,
    order: str | Iterable[str],
    series: str | Iterable[str],
    split_rows: int = SPLIT_ROWS,
    max_ranges: int = MAX_RANGES,
    first: int | None = None,
) -> DataFrame:
    """``df`` with ``__range`` and ``__before`` (rows of the series in earlier ranges).

    With ``first``, coarse ranges that begin at or after that many rows are left
    out. They are recognised by the cut point they begin at, a plain comparison
    with the lookup row: a filter on ``__before`` would be pushed into the search.
    """
    order, series = name_list(order), name_list(series)
    ranges = _Ranges(df, order, series, split_rows, max_ranges)
    zero = F.lit(0).cast("bigint")
    if not ranges.cut:
        return df.withColumn(_RANGE, zero).withColumn(_BEFORE, zero)

    keys, counted = ranges.keys, ranges.count(df)
    earlier = (Window.unboundedPreceding, -1)
    running = Window.partitionBy(*keys).orderBy(_COARSE).rowsBetween(*earlier)
    # Every coarse range holds its own cut point, so the arrays have no gap but the first range's.
    offsets = (
        counted.groupBy(*keys, _COARSE)
        .agg(F.sum("__rows").alias("__rows"))
        .withColumn("__offset", F.coalesce(F.sum("__rows").over(running), F.lit(0)))
        .groupBy(*[F.col(k).alias(f"{k}_counted") for k in keys])
        .agg(
            F.sort_array(F.collect_list(F.struct(_COARSE, "__offset"))).getField("__offset").alias(_OFFSETS),
            F.min(F.when(F.col("__offset") >= F.lit(first), F.col(_COARSE))).alias("__beyond"),
        )
    )
    lookup = ranges.coarse.join(offsets, _same(keys, [f"{k}_counted" for k in keys])).select(
        *keys, _CUTS, _OFFSETS, F.get(_CUTS, F.col("__beyond") - 1).alias("__stop")
    )
    located = df.join(F.broadcast(lookup), _same(series, keys), "left")
    if first is not None:
        at = F.struct(*[col(o).alias(f"o{i}") for i, o in enumerate(order)])
        located = located.where(F.col("__stop").isNull() | (at < F.col("__stop")))
    ranged = _search(located.drop("__stop"), order, _COARSE, ranges.longest)
    # Counted from the end: every range but the first holds at least its own cut point.
    before = F.try_element_at(_OFFSETS, F.col(_COARSE) - F.size(_CUTS) - 1)
    ranged = ranged.withColumn(_BEFORE, F.coalesce(before, F.lit(0)).cast("bigint"))
    ranged = ranged.drop(_CUTS, _OFFSETS, *keys)
    if ranges.fine is None:
        return ranged.withColumn(_RANGE, F.col(_COARSE).cast("bigint")).drop(_COARSE)

    inside = Window.partitionBy(*keys, _COARSE).orderBy(_FINE).rowsBetween(*earlier)
    counted_keys = [f"{k}_counted" for k in [*keys, _COARSE]]
    fine_offsets = (
        counted.withColumn("__offset", F.coalesce(F.sum("__rows").over(inside), F.lit(0)))
        .groupBy(*[F.col(k).alias(a) for k, a in zip([*keys, _COARSE], counted_keys)])
        .agg(F.sort_array(F.collect_list(F.struct(_FINE, "__offset"))).getField("__offset").alias(_OFFSETS))
    )
    fine = ranges.fine.join(fine_offsets, _same([*keys, _COARSE], counted_keys)).drop(*counted_keys)
    deep = _search(ranges.fine_lookup(ranged, fine, [_CUTS, _OFFSETS]), order, _FINE, ranges.longest_fine)
    inner = F.try_element_at(_OFFSETS, F.col(_FINE) - F.size(_CUTS) - 1)
    number = F.shiftleft(F.col(_COARSE).cast("bigint"), _FINE_BITS) + F.col(_FINE)
    return (
        deep.withColumn(_BEFORE, F.col(_BEFORE) + F.coalesce(inner, F.lit(0)))
        .withColumn(_RANGE, number)
        .drop(_CUTS, _OFFSETS, _COARSE, _FINE)
    )


def index_rows(
    df: DataFrame,
    order: str | Iterable[str],
    series: str | Iterable[str] = (),
    name: str = "row_idx",
    first: int | None = None,
    split_rows: int = SPLIT_ROWS,
    max_ranges: int = MAX_RANGES,
    keep_range: bool = False,
) -> DataFrame:
    """Add the zero-based position of each row in its series.

    ``order`` must tell the rows of a series apart (event time plus an id).
    ``first`` keeps only the first so many rows of every series; ranges that
    start beyond it are dropped before the shuffle. ``keep_range`` leaves the
    ``__range`` column in place for operators that group inside it.
    """
    order, series = name_list(order), name_list(series)
    whole = not series
    if whole:
        # One series over everything: a constant key that stays an equi-join key.
        df = df.withColumn(_ALL, F.pmod(F.xxhash64(*cols(order)), F.lit(1)))
        series = [_ALL]
    placed = place_rows(df, order, series, split_rows, max_ranges, first)
    own_range = [_RANGE] if whole else [*cols(series), _RANGE]
    in_range = Window.partitionBy(*own_range).orderBy(*cols(order))
    numbered = placed.withColumn("__rn", F.row_number().over(in_range))
    if first is not None:
        numbered = numbered.where(F.col("__rn") <= first)
    numbered = numbered.withColumn(name, F.col(_BEFORE) + F.col("__rn") - 1)
    if first is not None:
        numbered = numbered.where(col(name) < first)
    drop = ["__rn", _BEFORE]
    if whole:
        drop.append(_ALL)
    if not keep_range:
        drop.append(_RANGE)
    return numbered.drop(*drop)
