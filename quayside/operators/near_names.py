"""Names one or two insertions or deletions apart, through the texts that deletions leave.

Two names are at indel distance D + I exactly when deleting some D characters of one and some I of the other can
leave the same text, and no fewer can. So names at distance 1 meet where a deletion of one equals the other, and
names at distance 2 where two deletions of one equal the other, or one of each leaves the same. No pair
that meets is farther apart than that, however alike the names of a block are, and a text has at most as many
partners as there are ways to put a character or two back. This finds the best partner of names that differ in
a digit among millions which do, where common parts of names would bring all of them together.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.similarity import max_distance
from quayside.operators.skew import n_tasks

# Longest name of which two characters at a time are deleted; it has some 200 such texts.
TWICE_UP_TO = 20


def _without_one(name: str) -> set[str]:
    return {name[:i] + name[i + 1 :] for i in range(len(name))}


def _marks(name: str, is_wanted: bool) -> Iterator[tuple[str, str]]:
    """Texts of a name, tagged by how many deletions of the wanted and of the known name they stand for."""

    def tag(own: int, partner: int) -> str:
        return f"{own}/{partner}" if is_wanted else f"{partner}/{own}"

    once = _without_one(name)
    yield tag(0, 1), name
    yield from ((tag(1, 0), text) for text in once)
    # A known name may be two characters longer than the wanted one.
    if len(name) <= TWICE_UP_TO + (0 if is_wanted else 2):
        yield tag(0, 2), name
        yield from ((tag(1, 1), text) for text in once)
        yield from ((tag(2, 0), text) for text in set().union(*map(_without_one, once)))


def marked_names(names: DataFrame, is_wanted: bool) -> DataFrame:
    """Names with ``tag`` and ``text``, a row for each of their texts.

    Higher-order functions could make them, at twice the time (measured: 7 s for 18,700 names of 30
    characters, against 3.3 s this way with the join)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                rows, tags, texts = [], [], []
                for i, name in enumerate(part.column("sorted_name").to_pylist()):
                    for tag, text in _marks(name, is_wanted):
                        rows.append(i)
                        tags.append(tag)
                        texts.append(text)
                columns = [column.take(pa.array(rows, pa.int32())) for column in part.columns]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(tags, pa.string()), pa.array(texts, pa.string())], names=[*part.schema.names, "tag", "text"]
                )

    # A name makes hundreds of rows: a table small enough for one task by its bytes is work for all of them.
    names = names.repartition(n_tasks(names.sparkSession), "block", "sorted_name")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in names.schema.fields)
    return names.mapInArrow(run, f"{fields}, tag string, text string")


def best_within_two(wanted: DataFrame, known: DataFrame, threshold: float) -> DataFrame:
    """Best known name (score, position, ``known_name``) at distance 1 or 2 for each wanted (block, sorted_name)
    that has one reaching the threshold; names longer than ``TWICE_UP_TO`` look at distance 1 only. ``settled``: none
    that is farther can score as high.

    Names equal to a known one must not be among the wanted. Every text of a name is a key of its own, so
    neither a block nor a common part of names makes a large group.
    """
    a = marked_names(wanted.select("block", "sorted_name"), True)
    b = marked_names(known.select("block", "sorted_name", "position"), False).withColumnRenamed("sorted_name", "known_name")
    x, y = F.char_length("sorted_name"), F.char_length("known_name")
    distance = F.when(F.col("tag").isin("1/0", "0/1"), F.lit(1)).otherwise(F.lit(2))
    # Spark sizes both sides by the names they are made of, hundreds of times too small, and would broadcast one.
    pairs = a.join(b.hint("merge"), ["block", "tag", "text"]).withColumn("distance", distance)
    pairs = pairs.filter(F.col("distance") <= max_distance(x, y, threshold))
    common = ((x + y - F.col("distance")) / 2).cast("int")
    scored = pairs.withColumn("score", F.lit(200.0) * common / (x + y))
    best = F.max(F.struct("score", (-F.col("position")).alias("earlier"), "known_name"))
    found = scored.groupBy("block", "sorted_name").agg(best.alias("_best")).select("block", "sorted_name", "_best.*")
    return found.withColumn("settled", F.col("score") > _best_beyond())


def _best_beyond() -> Column:
    """Highest score of a partner too far to be looked at: one that holds the whole name and a little more."""
    n = F.char_length("sorted_name")
    next_distance = F.when(n <= TWICE_UP_TO, F.lit(3)).otherwise(F.lit(2))
    return F.lit(200.0) * n / (2 * n + next_distance)


def may_be_farther(threshold: float) -> Column:
    """Whether a partner that ``best_within_two`` does not look at could reach the threshold."""
    return _best_beyond() >= threshold - 1e-9
