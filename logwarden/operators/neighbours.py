"""Values of the next or previous rows of the same entity, also when one entity is huge.

A window per entity puts every row of an entity into one task. Entities above a row limit
are therefore cut into ranges of (time, row_id), so that rows of one time can be parted too; each
range borrows the few rows it needs from the ranges beside it, so the result is exactly that of
the plain window. Rows without an entity are an entity of their own, as they are to a window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logwarden.common import written
from logwarden.functions.features import micros

LARGE_ENTITY_ROWS = 1_000_000
SAMPLE_PER_PIECE = 200
_PIECE, _TIME, _BORROWED = "_piece", "_time", "_borrowed"


def _mark(time: str, row_id: str | None) -> Column:
    """A row's place in the order of its entity."""
    return F.struct(micros(time).alias("at"), (F.col(row_id) if row_id else F.lit(0)).alias("id"))


def large_entities(df: DataFrame, entity: str, time: str, limit: int | None = None, row_id: str | None = None) -> DataFrame | None:
    """``_entity, _marks, _cuts``: places (and their times) that cut every entity above the limit into pieces of about that size.

    The limit does not depend on the table. The cuts are every so-many-th of the places that a hash
    picks, about ``SAMPLE_PER_PIECE`` a piece, so finding them sorts a small part of the rows. None
    where no entity is large. Without ``row_id`` rows of one time stay together.
    """
    floor = limit or LARGE_ENTITY_ROWS
    sizes = df.groupBy(F.col(entity).alias("_entity")).agg(F.count(F.lit(1)).alias("_rows"))
    large = written(sizes.where(F.col("_rows") > floor), "large-entities")
    if large.isEmpty():
        return None
    step = max(1, floor // SAMPLE_PER_PIECE)
    every = max(1, floor // step)
    marked = df.select(F.col(entity).alias("_entity"), _mark(time, row_id).alias("_mark"))
    picked = marked.where(F.pmod(F.xxhash64("_entity", "_mark"), F.lit(step)) == 0)
    picked = picked.join(large.select(F.col("_entity").alias("_large")), F.col("_entity").eqNullSafe(F.col("_large")), "leftsemi")
    place = F.row_number().over(Window.partitionBy("_entity").orderBy("_mark"))
    cuts = picked.withColumn("_n", place).where(F.col("_n") % every == 0).groupBy("_entity").agg(
        F.array_sort(F.collect_set("_mark")).alias("_marks"))
    return written(cuts.withColumn("_cuts", F.transform("_marks", lambda m: m["at"])), "entity-cuts")


def _with_pieces(df: DataFrame, entity: str, time: str, row_id: str, limit: int | None) -> tuple[DataFrame, bool]:
    cuts = large_entities(df, entity, time, limit, row_id)
    timed = df.withColumn(_TIME, micros(time))
    if cuts is None:
        return timed.withColumn(_PIECE, F.lit(0)), False
    passed = F.size(F.filter("_marks", lambda m: m <= _mark(time, row_id)))
    # Spark broadcasts the cuts if their files are small enough.
    placed = timed.join(cuts.drop("_cuts"), F.col(entity).eqNullSafe(F.col("_entity")), "left")
    return (placed.withColumn(_PIECE, F.when(F.col("_marks").isNull(), -1).otherwise(passed))
            .drop("_entity", "_marks")), True


def with_neighbours(df: DataFrame, entity: str, time: str, row_id: str, take: Mapping[str, Sequence[tuple]],
                    reach: int, following: bool, limit: int | None = None) -> DataFrame:
    """Add columns taken from neighbouring rows of the same entity in (time, row_id) order.

    ``take`` maps an output column to ``(source column, distance)``; a distance beyond the
    entity's rows gives null. ``reach`` is the largest distance.
    """
    placed, split = _with_pieces(df, entity, time, row_id, limit)
    order = [F.col(_TIME), F.col(row_id)]
    rows = placed.withColumn(_BORROWED, F.lit(False))
    if split:
        rows = rows.unionByName(_borrowed_rows(placed, entity, row_id, reach, following))
    window = Window.partitionBy(entity, _PIECE).orderBy(*order)
    shift = F.lead if following else F.lag
    added = {out: shift(column, distance).over(window) for out, (column, distance) in take.items()}
    return rows.withColumns(added).where(~F.col(_BORROWED)).drop(_PIECE, _TIME, _BORROWED)


def _borrowed_rows(placed: DataFrame, entity: str, row_id: str, reach: int, following: bool) -> DataFrame:
    """Copies of the rows next to each piece of a large entity, at most ``reach`` per piece."""
    def towards(*columns: str) -> list[Column]:
        return [F.col(c).asc() if following else F.col(c).desc() for c in columns]

    nearest = towards(_TIME, row_id)
    pieces = placed.where(F.col(_PIECE) >= 0)
    near_edge = Window.partitionBy(entity, _PIECE).orderBy(*nearest)
    edge = pieces.withColumn("_n", F.row_number().over(near_edge)).where(F.col("_n") <= reach).drop("_n")
    step = F.lit(-1 if following else 1)
    # Every piece after the first cut has rows, so ``reach`` pieces away is far enough
    # (one more for the first piece, which may be empty).
    lent = edge.withColumn("_away", F.explode(F.sequence(F.lit(1), F.lit(reach + 1))))
    lent = lent.withColumn(_PIECE, F.col(_PIECE) + step * F.col("_away")).drop("_away").where(F.col(_PIECE) >= 0)
    by_target = Window.partitionBy(entity, _PIECE).orderBy(*nearest)
    return (lent.withColumn("_n", F.row_number().over(by_target)).where(F.col("_n") <= reach)
            .drop("_n").withColumn(_BORROWED, F.lit(True)))


def previous_gap_seconds(df: DataFrame, entity: str, time: str, row_id: str, out: str = "gap",
                         limit: int | None = None) -> DataFrame:
    """Seconds since the entity's previous event; 0.0 for its first one."""
    before = with_neighbours(df.withColumn("_at", micros(time)), entity, time, row_id,
                             {"_before": ("_at", 1)}, 1, following=False, limit=limit)
    gap = (F.col("_at") - F.col("_before")) / F.lit(1e6)
    return before.withColumn(out, F.coalesce(gap, F.lit(0.0))).drop("_at", "_before")


def sequence_table(df: DataFrame, columns: Sequence[str], entity: str, time: str, row_id: str,
                   length: int, assign: str = "first", limit: int | None = None) -> tuple[DataFrame, list[list[str]]]:
    """Each row with the columns of the ``length`` rows of its window, and their names by step.

    ``assign='first'`` puts a window on its first row (rows ahead), ``'last'`` on its last
    row (rows behind). ``_full`` tells whether the window is complete.
    """
    if assign not in ("first", "last"):
        raise ValueError("assign must be 'first' or 'last'")
    if length < 2:
        raise ValueError("a sequence needs at least two rows")
    following = assign == "first"
    # Steps in time order; distance 0 is the row itself.
    distances = range(length) if following else range(length - 1, -1, -1)
    take = {f"{c}__{d}": (c, d) for d in range(1, length) for c in columns}
    take["_end"] = (row_id, length - 1)
    wide = with_neighbours(df, entity, time, row_id, take, length - 1, following, limit)
    wide = wide.withColumn("_full", F.col("_end").isNotNull()).drop("_end")
    return wide, [[c if d == 0 else f"{c}__{d}" for c in columns] for d in distances]
