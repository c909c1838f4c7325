"""Reproducible shuffle into shards: a Feistel permutation of the global row numbers.

Rows are numbered 0 to n-1 in the order of their identifying columns. A keyed Feistel network over
``Z_a x Z_b`` (the smallest near-square rectangle that holds n) permutes the numbers; a value
outside 0..n-1 is sent through the network again until it falls inside (cycle walking), so the
result is a permutation of exactly the n numbers. ``shard = position mod shards`` and
``slot = position div shards``: shard sizes differ by one row at most, slots have no gaps, and both
can be computed for any row number without looking at the data, as can the inverse.

Defined cases: an empty table gives no rows; one row gets shard 0, slot 0; rows equal in every
ordering column are interchangeable and get distinct positions; null sorts before any value.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logwarden.common import written
from logwarden.llm.tables import join_parts, let, whole_text

ROUNDS = 6  # even, so that both halves end where they began
MAX_WALK = 64


def rectangle(n: int) -> tuple[int, int]:
    """Sides a, b with ``n <= a * b < n + a``."""
    a = max(1, math.isqrt(max(0, n - 1)) + 1)
    return a, max(1, -(-n // a))


def _network(value: Column, a: int, b: int, key: int, inverse: bool = False) -> Column:
    def mixed(half: Column, step: Column) -> Column:
        return F.xxhash64(half, step + F.lit(key * ROUNDS))

    def side(step: Column) -> Column:
        return F.when(step % 2 == 0, F.lit(a)).otherwise(F.lit(b)).cast("bigint")

    def forward(state: Column, step: Column) -> Column:
        return F.struct(state["y"].alias("x"),
                        F.pmod(state["x"] + F.pmod(mixed(state["y"], step), side(step)), side(step)).alias("y"))

    def backward(state: Column, step: Column) -> Column:
        return F.struct(F.pmod(state["y"] - F.pmod(mixed(state["x"], step), side(step)), side(step)).alias("x"),
                        state["x"].alias("y"))

    start = F.struct(F.call_function("div", value, F.lit(b).cast("bigint")).alias("x"),
                     F.pmod(value, F.lit(b).cast("bigint")).alias("y"))
    steps = [F.lit(i).cast("bigint") for i in range(ROUNDS)]
    return F.aggregate(F.array(*(reversed(steps) if inverse else steps)), start, backward if inverse else forward,
                       lambda s: s["x"] * F.lit(b).cast("bigint") + s["y"])


def permute(row: Column, n: int, key: int, inverse: bool = False) -> Column:
    """The position of row number ``row`` in the shuffle of ``n`` rows, or the way back."""
    a, b = rectangle(n)
    outside = a * b - n
    first = _network(row.cast("bigint"), a, b, key, inverse)
    if not outside:
        return first

    def walk(value: Column, _: Column) -> Column:
        return let(value, lambda v: F.when(v < n, v).otherwise(_network(v, a, b, key, inverse)))

    # A walk visits each outside value once at most; in a large table more than a few steps never happen.
    steps = F.sequence(F.lit(1), F.lit(min(outside, MAX_WALK)))
    walked = let(first, lambda v: F.when(v < n, v).otherwise(F.aggregate(steps, v, walk)))
    stuck = F.raise_error(F.lit("cycle walk did not end; use another key")).cast("bigint")
    return let(walked, lambda v: F.when(v < n, v).otherwise(stuck))


def numbered(rows: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """Rows with ``row_number`` 0.. in the given order, and their count; no single-task sort.

    Sorted ranges are written with their partition and place; the numbers of rows in earlier
    partitions, one per partition, are added. A random last key splits runs of equal rows.
    """
    spark = rows.sparkSession
    keys = [*order, "_salt"]
    ranges = rows.withColumn("_salt", F.rand(11)).repartitionByRange(join_parts(rows), *keys).sortWithinPartitions(*keys)
    placed = written(ranges.drop("_salt").withColumns({
        "_part": F.spark_partition_id(),
        "_place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}), "numbered")
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = [(r["_part"], r["_start"], r["_size"])
              for r in sizes.select("*", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")).collect()]
    n = max((start + size for _, start, size in starts), default=0)
    # One row per shuffle partition, whatever the size of the table.
    offsets = spark.createDataFrame([(p, s) for p, s, _ in starts], "_part int, _start bigint")
    out = placed.join(F.broadcast(offsets), "_part")
    return out.withColumn("row_number", F.col("_start") + F.col("_place")).drop("_part", "_place", "_start"), n


def shard(docs: DataFrame, shards: int = 8, key: int = 20261201) -> DataFrame:
    """``doc_id, size, text_crc32, row_number, position, shard, slot`` for every row of ``docs``.

    Rows are numbered by doc_id, then size and checksum of the text.
    """
    text = whole_text(docs)
    rows = docs.select(docs["doc_id"].alias("doc_id"),
                       (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    out, n = numbered(rows, ["doc_id", "size", "text_crc32"])
    placed = out.withColumn("position", permute(F.col("row_number"), max(n, 1), key))
    return placed.withColumns({"shard": F.pmod("position", F.lit(shards)).cast("int"),
                               "slot": F.call_function("div", F.col("position"), F.lit(shards).cast("bigint"))})
