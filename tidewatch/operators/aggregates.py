"""Aggregation with user-supplied code.

Prefer built-in aggregate expressions. This operator is for accumulators that those cannot
express, and folds before the shuffle as they do.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import StructType

_KEYS_PER_TASK = 100_000
_ROWS_AT_ONCE = 200_000
_BYTES_AT_ONCE = 32_000_000

# Whole numbers beside NULL would be doubles in plain pandas.
_WHOLE = {
    pa.int8(): pd.Int8Dtype(),
    pa.int16(): pd.Int16Dtype(),
    pa.int32(): pd.Int32Dtype(),
    pa.int64(): pd.Int64Dtype(),
}


# One object, so that a dict finds it again; NaN is a key like any other.
_NAN = float("nan")


def fold_partials(
    df: DataFrame,
    key: str,
    init: Callable[[], Any],
    add: Callable[[Any, pd.DataFrame], Any],
    acc_type: str,
) -> DataFrame:
    """Fold the rows of each input task per key: columns ``key`` and ``acc``; batch or stream.

    ``add`` gets the accumulator and the next rows of one key as pandas, whole numbers in its
    nullable types, so that 64 bits are exact beside NULL as well. A task collects
    ``_ROWS_AT_ONCE`` rows or ``_BYTES_AT_ONCE`` before it groups them, and a task that meets many
    keys hands on what it has and starts again, so its memory is bounded.
    """
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
    out = _arrow_schema(df, key, "acc", acc_type)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        accs: dict[Any, Any] = {}
        for rows in in_blocks(batches):
            for value, group in rows.groupby(key, sort=False, dropna=False):
                value = _NAN if value != value else value
                accs[value] = add(accs[value] if value in accs else init(), group)
            if len(accs) > _KEYS_PER_TASK:
                yield _batch(out, accs.items())
                accs = {}
        yield _batch(out, accs.items())

    def in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        block, rows, size = [], 0, 0
        for batch in batches:
            block.append(batch)
            rows += batch.num_rows
            size += batch.nbytes
            if rows >= _ROWS_AT_ONCE or size >= _BYTES_AT_ONCE:
                yield as_pandas(block)
                block, rows, size = [], 0, 0
        if block:
            yield as_pandas(block)

    def as_pandas(block: list[pa.RecordBatch]) -> pd.DataFrame:
        frame = pa.Table.from_batches(block).to_pandas(types_mapper=_WHOLE.get)
        # Times of the session's zone, as Spark hands them to pandas.
        for name in frame.select_dtypes("datetimetz").columns.difference([key]):
            frame[name] = frame[name].dt.tz_convert(zone).dt.tz_localize(None)
        return frame

    key_type = df.schema[key].dataType.simpleString()
    return df.mapInArrow(fold, f"`{key}` {key_type}, acc {acc_type}")


def _arrow_schema(df: DataFrame, key: str, result: str, acc_type: str) -> pa.Schema:
    acc = StructType.fromDDL(f"acc {acc_type}")["acc"].dataType
    types = {key: df.schema[key].dataType, result: acc}
    return pa.schema([(name, to_arrow_type(kind)) for name, kind in types.items()])


def _batch(schema: pa.Schema, rows: Iterable[tuple[Any, Any]]) -> pa.RecordBatch:
    keys, accs = zip(*rows) if rows else ((), ())
    columns = [pa.array(values, kind) for values, kind in zip((keys, accs), schema.types)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def custom_agg(
    df: DataFrame,
    key: str,
    init: Callable[[], Any],
    add: Callable[[Any, pd.DataFrame], Any],
    merge: Callable[[Any, Any], Any],
    acc_type: str,
    result: str = "acc",
) -> DataFrame:
    """One accumulator per key: fold in each input task, shuffle the partials, merge them.

    Rows without a key are left out. A key reaches the merge with a few partials per input
    task however many rows it has. The partials arrive sorted by key, so that a task holds one
    accumulator at a time.
    """
    partials = fold_partials(df.filter(F.col(key).isNotNull()), key, init, add, acc_type)

    out = _arrow_schema(df, key, result, acc_type)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        member, total = None, None
        for batch in batches:
            done: list[tuple[Any, Any]] = []
            for value, acc in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if value == member or (value != value and member != member):
                    total = merge(total, acc)
                    continue
                if member is not None:
                    done.append((member, total))
                member, total = value, acc
            yield _batch(out, done)
        if member is not None:
            yield _batch(out, [(member, total)])

    key_type = df.schema[key].dataType.simpleString()
    by_key = partials.repartition(key).sortWithinPartitions(key)
    return by_key.mapInArrow(merged, f"`{key}` {key_type}, `{result}` {acc_type}")


def custom_agg_stream(
    df: DataFrame,
    key: str,
    init: Callable[[], Any],
    add: Callable[[Any, pd.DataFrame], Any],
    merge: Callable[[Any, Any], Any],
    acc_type: str,
    result: str = "acc",
) -> DataFrame:
    """Running accumulator per key of a stream, for ``update`` mode.

    The same fold before the shuffle; the state store keeps one accumulator per key, and every
    micro-batch gives the new value of the keys it touched. Accumulators here should not be NULL: a
    64-bit one that reaches a task beside a NULL goes through a double.
    """
    partials = fold_partials(df.filter(F.col(key).isNotNull()), key, init, add, acc_type)
    # Column names that start with an underscore would be lost on the way to the processor.
    partials = partials.select(F.col(key).alias("member"), "acc")

    class Running(StatefulProcessor):
        def init(self, handle) -> None:
            self.acc = handle.getValueState("acc", f"acc {acc_type}")

        def handleInputRows(self, member, rows, timer_values) -> Iterator[pd.DataFrame]:
            total = self.acc.get()[0] if self.acc.exists() else None
            for frame in rows:
                for acc in frame["acc"].tolist():
                    total = acc if total is None else merge(total, acc)
            self.acc.update((total,))
            yield pd.DataFrame({"member": [member[0]], "acc": [total]})

        def close(self) -> None:
            pass

    member_type = df.schema[key].dataType.simpleString()
    schema = f"member {member_type}, acc {acc_type}"
    running = partials.groupBy("member").transformWithStateInPandas(
        Running(), schema, "Update", "None"
    )
    return running.select(F.col("member").alias(key), F.col("acc").alias(result))
