"""What chunks and buckets send one another."""

import numpy as np
import pyarrow as pa
import pytest

from quayside.llm.chunks import KEEP, keep, narrow, packed_numbers, questions, restored, shortened, unpacked_numbers
from quayside.llm.suffix_tree import score_documents


def messages(widths=6):
    rng = np.random.default_rng(5)
    hashes = np.unique(rng.integers(0, 2**64, 40_000, dtype=np.uint64))
    counts = narrow(rng.geometric(0.7, len(hashes)).astype(np.uint64), 4)
    asked = questions(8, 3, hashes, narrow(hashes >> np.uint64(18), widths), counts, 7, to_all=True)
    return pa.Table.from_batches([asked, questions(8, 3, hashes[:0], narrow(hashes[:0], 8), None, 9, True), keep(8, 3, b"state")])


def test_messages_come_back_as_they_were_and_are_shorter():
    table, widths = messages(), {7: ((6, 4), (1, 8)), 9: ((8, 12), (12, 8))}
    short = shortened(table, widths, 0)
    assert restored(short, widths).to_pylist() == table.to_pylist()
    size = lambda t: sum(len(v) for c in ("data", "more") for v in t[c].to_pylist())
    assert size(short) < 0.6 * size(table)
    assert shortened(table, {}, 0).equals(table) and restored(table, {}).equals(table)


def test_packed_numbers_come_back_in_the_bits_they_have():
    rng = np.random.default_rng(2)
    given = [np.zeros(0, int), np.array([0, 2**32 - 1, 0, 2**31, 5]), np.zeros(5000, int), rng.geometric(0.01, 20_000)]
    packed = [packed_numbers(v) for v in given]
    back = unpacked_numbers(b"".join(packed))
    assert [b.tolist() for b in back] == [v.tolist() for v in given]
    assert len(packed[2]) < 40 and len(packed[3]) < 20_000 * 9 / 8
    with pytest.raises(ValueError):
        packed_numbers(np.array([2**34]))


def test_answers_are_told_from_questions():
    table, widths = messages(4), {7: ((6, 4), (4, 4)), 9: ((8, 12), (12, 8))}
    short = shortened(table, widths, 1)
    assert set(short["kind"].to_pylist()) == {-7, -9, KEEP}
    assert restored(short, widths).to_pylist() == table.to_pylist()


def test_the_tree_reads_earlier_answers_where_they_lie(spark):
    """One shuffle of answers per round, each read again by all later rounds: nothing is sent a second time."""
    rows = [(i, " ".join(f"w{(i * k) % 9}" for k in range(40))) for i in range(60)]
    scored = score_documents(spark.createDataFrame(rows, "doc_id long, text string"))
    scored.collect()
    plan = scored._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    shuffles = [line for line in plan.split("\n") if "Exchange hashpartitioning(" in line and "Reused" not in line]
    # The documents, and questions and answers of four rounds.
    assert len(shuffles) == 9 and plan.count("Union") >= 2
