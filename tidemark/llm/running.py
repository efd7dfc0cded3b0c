"""Running totals over a whole table in a given order, with no task that sees it all."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def with_running_totals(df: DataFrame, order: Sequence[Column], values: Sequence[str]) -> DataFrame:
    """``df`` with ``<value>_before`` for each long column of ``values``: its total over earlier rows.

    The rows are sorted across tasks by ranges of ``order`` and summed up within each part
    as they pass; one row per part carries the totals on. They are written once, which fixes
    the parts. Rows that tie in ``order`` follow each other in any order, so it should tell rows apart
    wherever that matters. Null values count as nothing.
    """
    names = [f"{v}_before" for v in values]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema), *(f"{n} long" for n in names), "_part int"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        total = [0] * len(values)
        for batch in batches:
            columns = list(batch.columns)
            for k, value in enumerate(values):
                sizes = batch.column(value).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                sums = np.cumsum(sizes)
                columns.append(pa.array(sums - sizes + total[k]))
                total[k] += int(sums[-1]) if len(sums) else 0
            columns.append(pa.array(np.full(batch.num_rows, part, dtype=np.int32)))
            yield pa.record_batch(columns, [*batch.schema.names, *names, "_part"])

    placed = stored(df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("_part").agg(*[F.sum(v).alias(v) for v in values])
    carried = parts.select("_part", *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"_{v}_carried") for v in values])
    rows = placed.join(carried, "_part")
    return rows.select(*df.columns, *[(F.col(n) + F.col(f"_{v}_carried")).alias(n) for v, n in zip(values, names)])
