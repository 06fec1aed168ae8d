"""Values of the rows before each row, in a total order, spread over tasks whatever the keys are.

A window over a key puts all rows of the key into one task. Here the rows are range-partitioned by key and
order, so a key that holds a third of all rows lies in a third of the ranges. Each range is run through in
order once, as if nothing stood before it; then every range gets what the ranges before it pass on, which
takes one row per range, and rows whose value reaches back beyond their range add that.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quayside.session import is_storable, shared_folder, stored

_ROW, _BY, _RANGE, _HEAD, _END = "_row", "_by", "_range", "_head", "_end"


def before_each(
    rows: DataFrame,
    by: Column,
    order: Sequence[Column],
    since: Mapping[str, tuple[Column, Column]] | None = None,
    last: Mapping[str, Column] | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """``rows`` with more columns about the rows of the same ``by`` (null is one of its own) before each.

    ``since`` names sums: of a count (a whole number) over the rows before, back to the last one whose flag
    is true, that one left out. ``last`` names values: the last that is not null, of the rows before. The rows are
    cut into ``ranges``, or else into as many as the session's shuffle partitions, of which Spark
    merges small ones. Rows equal in ``by`` and ``order`` count in no particular order. What the ranges pass on
    is one row each, which is all that is broadcast.
    """
    since, last = dict(since or {}), dict(last or {})
    scanned = scan_ranges(rows, by, order, since, last, ranges)
    # Where the cuts lie is up to a sample: they are settled before anything refers to them.
    if is_storable(scanned.schema):
        scanned = stored(scanned, "scanned")
    else:
        shared_folder(rows.sparkSession)
        scanned = scanned.checkpoint()
    passed = F.broadcast(_passed_on(scanned, list(since), list(last)))
    joined = scanned.join(passed, _RANGE)
    sums = [
        (F.col(f"_before_{n}") + F.when(F.col(f"_open_{n}"), F.col(f"_in_{n}")).otherwise(F.lit(0))).alias(n) for n in since
    ]
    values = [F.when(F.col(f"_open_{n}"), F.col(f"_in_{n}")).otherwise(F.col(f"_before_{n}")).alias(n) for n in last]
    return joined.select(*[F.col(f"{_ROW}.`{c}`").alias(c) for c in rows.columns], *sums, *values)


def scan_ranges(
    rows: DataFrame,
    by: Column,
    order: Sequence[Column],
    since: Mapping[str, tuple[Column, Column]],
    last: Mapping[str, Column],
    ranges: int | None = None,
) -> DataFrame:
    """Rows in order by range (``_range``), with the values as far as the range itself tells them and whether
    (``_open_<name>``) what stands before the range would add to them."""
    keys = [f"_key{i}" for i in range(len(order))]
    given = rows.select(
        F.struct(*[F.col(c) for c in rows.columns]).alias(_ROW),
        by.alias(_BY),
        *[o.alias(k) for o, k in zip(order, keys)],
        *[F.coalesce(count.cast("long"), F.lit(0).cast("long")).alias(f"_count_{n}") for n, (count, _) in since.items()],
        *[F.coalesce(reset, F.lit(False)).alias(f"_reset_{n}") for n, (_, reset) in since.items()],
        *[value.alias(f"_value_{n}") for n, value in last.items()],
    )
    cut = [_BY, *keys]
    dealt = given.repartitionByRange(ranges, *cut) if ranges else given.repartitionByRange(*cut)
    dealt = dealt.sortWithinPartitions(*cut).drop(*keys).withColumn(_RANGE, F.spark_partition_id())
    sums, values = list(since), list(last)
    types = {f.name: f.dataType.simpleString() for f in dealt.schema.fields}
    added = [f"_before_{n} bigint, _open_{n} boolean" for n in sums]
    added += [f"_before_{n} {types[f'_value_{n}']}, _open_{n} boolean" for n in values]
    schema = ", ".join([f"{c} {t}" for c, t in types.items()] + added + [f"{_HEAD} boolean, {_END} boolean"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = _Scan(sums, values)
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                yield _flagged(held, False)
            held = scan.through(batch)
        if held is not None:
            yield _flagged(held, True)

    return dealt.mapInArrow(run, schema)


class _Scan:
    """What the batches of a range so far pass on to the next one."""

    def __init__(self, sums: list[str], values: list[str]):
        self.sums, self.values = sums, values
        self.at_head, self.in_first = True, True
        self.by: object = None
        self.total = dict.fromkeys(sums, 0)
        self.value: dict[str, object] = dict.fromkeys(values)
        self.open = dict.fromkeys([*sums, *values], True)

    def through(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        n = batch.num_rows
        at = np.arange(n)
        by = batch.column(_BY)
        code = by.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        new = np.ones(n, bool)
        new[1:] = code[1:] != code[:-1]
        new[0] = not self.at_head and by[0].as_py() != self.by
        # Where the key of a row begins in this batch; -1 if before it.
        begin = np.maximum.accumulate(np.where(new, at, -1))
        first = self.in_first & (begin < 0)
        columns, names = list(batch.columns), list(batch.schema.names)
        for name in self.sums:
            count = batch.column(f"_count_{name}").to_numpy(zero_copy_only=False)
            reset = batch.column(f"_reset_{name}").to_numpy(zero_copy_only=False)
            count = np.where(reset, 0, count)
            total = np.concatenate([[0], np.cumsum(count)])
            ended = self._before(np.where(reset, at, -1))
            start = np.maximum(begin, ended + 1)
            goes_on = (begin < 0) & (ended < 0)
            before = total[:-1] - total[np.maximum(start, 0)]
            before = np.where(goes_on, self.total[name] + total[:-1], before)
            open_ = first & (ended < 0) & self.open[name]
            columns += [pa.array(before), pa.array(open_)]
            names += [f"_before_{name}", f"_open_{name}"]
            self.total[name] = 0 if reset[-1] else int(before[-1] + count[-1])
            self.open[name] = bool(open_[-1] and not reset[-1])
        for name in self.values:
            value = batch.column(f"_value_{name}")
            there = value.is_valid().to_numpy(zero_copy_only=False)
            found = self._before(np.where(there, at, -1))
            # Place 0 of what is taken from is the value that came in.
            none = found < begin
            taken = pa.array(np.where(found < 0, 0, found + 1), mask=none)
            both = pa.concat_arrays([pa.array([self.value[name]], value.type), value])
            columns += [both.take(taken), pa.array(first & (found < 0) & self.open[name])]
            names += [f"_before_{name}", f"_open_{name}"]
            still = bool(first[-1] and found[-1] < 0 and self.open[name] and not there[-1])
            if there[-1]:
                self.value[name] = value[-1].as_py()
            else:
                self.value[name] = columns[-2][-1].as_py()
            self.open[name] = still
        columns.append(pa.array((at == 0) & self.at_head))
        names.append(_HEAD)
        self.at_head, self.in_first, self.by = False, bool(first[-1]), by[-1].as_py()
        return pa.RecordBatch.from_arrays(columns, names=names)

    @staticmethod
    def _before(places: np.ndarray) -> np.ndarray:
        """Of places, -1 for none, the last one in front of each row."""
        return np.concatenate([[-1], np.maximum.accumulate(places)[:-1]])


def _flagged(batch: pa.RecordBatch, is_end: bool) -> pa.RecordBatch:
    end = np.zeros(batch.num_rows, bool)
    end[-1] = is_end
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(end)], names=[*batch.schema.names, _END])


def _passed_on(scanned: DataFrame, sums: list[str], values: list[str]) -> DataFrame:
    """What comes into every range: one row each, so one task goes through them in order."""
    heads = scanned.filter(_HEAD).select(_RANGE, F.col(_BY).alias("_first_by"))
    after = [
        F.when(F.col(f"_reset_{n}"), F.lit(0).cast("long")).otherwise(F.col(f"_before_{n}") + F.col(f"_count_{n}")).alias(f"_after_{n}")
        for n in sums
    ]
    after += [F.coalesce(f"_value_{n}", f"_before_{n}").alias(f"_after_{n}") for n in values]
    still = [(F.col(f"_open_{n}") & ~F.col(f"_reset_{n}")).alias(f"_still_{n}") for n in sums]
    still += [(F.col(f"_open_{n}") & F.col(f"_value_{n}").isNull()).alias(f"_still_{n}") for n in values]
    ends = scanned.filter(_END).select(_RANGE, F.col(_BY).alias("_last_by"), F.lit(True).alias("_is_end"), *after, *still)
    line = W.orderBy(_RANGE)
    chain = heads.join(ends, _RANGE).withColumn(
        "_same", F.coalesce(F.lag("_is_end").over(line) & F.lag("_last_by").over(line).eqNullSafe(F.col("_first_by")), F.lit(False))
    )
    incoming = []
    for name in [*sums, *values]:
        # Ranges through which a value goes on unbroken, behind the one it comes from.
        goes_on = F.col("_same") & F.col(f"_still_{name}")
        chain = chain.withColumn("_stretch", F.sum(F.when(goes_on, 0).otherwise(1)).over(line))
        stretch = W.partitionBy("_stretch").orderBy(_RANGE).rowsBetween(W.unboundedPreceding, W.currentRow)
        out = F.sum(f"_after_{name}") if name in sums else F.last(f"_after_{name}", ignorenulls=True)
        chain = chain.withColumn(f"_out_{name}", out.over(stretch))
        came = F.when(F.col("_same"), F.lag(f"_out_{name}").over(line))
        incoming.append((F.coalesce(came, F.lit(0)) if name in sums else came).alias(f"_in_{name}"))
    return chain.select(_RANGE, *incoming)
