"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A word is a run of characters other than these six white-space characters.
WORD_GAP = "\\x20\\x09-\\x0D"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Compute ``value`` once per row and hand it to ``use``, however often that refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def whole_text(df: DataFrame, name: str = "text") -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(df[name], F.lit(""))


def small_batches(df: DataFrame, rows: int = 1000) -> DataFrame:
    """Send fewer rows at once to Python workers, as texts can be long; a number the session has chosen stays."""
    name, conf = "spark.sql.execution.arrow.maxRecordsPerBatch", df.sparkSession.conf
    if conf.get(name, "10000") == "10000":
        conf.set(name, str(rows))
    return df


def free_name(df: DataFrame, wish: str) -> str:
    """A column name that the table does not have yet."""
    taken = {c.lower() for c in df.columns}
    while wish in taken:
        wish += "_"
    return wish


def join_parts(df: DataFrame) -> int:
    """How many partitions a shuffle of this session has."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Groups of a sorted partition, several at a time, never cut: yields tables that hold whole groups."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = [batch.column(k)[batch.num_rows - 1].as_py() for k in range(keys)]
        cut = batch.num_rows
        columns = [batch.column(k).to_pylist() for k in range(keys)]
        while cut and all(columns[k][cut - 1] == last[k] for k in range(keys)):
            cut -= 1
        if held and cut == 0 and [held[-1].column(k)[held[-1].num_rows - 1].as_py() for k in range(keys)] == last:
            held.append(batch)
            continue
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        else:
            if held:
                yield pa.Table.from_batches(held)
            held = [batch]
    if held:
        yield pa.Table.from_batches(held)
