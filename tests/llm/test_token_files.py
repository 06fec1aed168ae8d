import os
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from quayside.llm import token_files
from quayside.llm.token_files import DocumentTokenizer, read_metadata, read_tokens, token_digest, write_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["a  b   c", "\n \n x", " \n y", "x\n z", "'s it's  ", "tab\t \tend", "<|endoftext|> a", "hello <|endoftext|> world", "x<|endoftext|>y <|endoftext", "a <|end oftext|>", "　   b", "\x1c \x1c", "日本 語 ", " ", ""]


@pytest.fixture(scope="module")
def plain():
    library = Tokenizer.from_file(PATH)
    return lambda text: library.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def json_bytes():
    with open(PATH, "rb") as file:
        return file.read()


def test_runs_give_the_librarys_ids(plain, json_bytes, numbered_texts):
    texts = ODD + [t or "" for _, t, _ in numbered_texts]
    found = DocumentTokenizer(json_bytes.decode()).encode(texts)
    assert [np.frombuffer(f, "<u4").tolist() for f in found] == [plain(t) for t in texts]


def test_random_mixtures_give_the_librarys_ids(plain, json_bytes):
    parts = ["a", "b ", "'s", " 's", "'", "'ll", "l'a", "\n", " ", "  ", "\t", "\r\n", "é", "×", "÷", "ª", "½", "¿", "日", "\xa0", "\u3000",
             "\x1c", "\x00", "1", " 23", "...", "—", "<|endoftext|>", "<|endof", "ſ", "я", "a\u0301", "'RE", "\x85", "ƻ", " y", " ."]
    rng = random.Random(3)
    texts = ["".join(rng.choices(parts, k=rng.randrange(14))) for _ in range(5000)]
    machine = DocumentTokenizer(json_bytes.decode())
    for at in range(0, len(texts), 1000):
        found = machine.encode(texts[at : at + 1000])
        assert [np.frombuffer(f, "<u4").tolist() for f in found] == [plain(t) for t in texts[at : at + 1000]]


def test_pieces_are_given_to_the_library_once(json_bytes, monkeypatch):
    machine = DocumentTokenizer(json_bytes.decode())
    first = machine.encode(["one two, three***", "Two three\nfour"])
    given = []
    monkeypatch.setattr(machine, "_encoded", lambda library, texts: given.extend(texts) or DocumentTokenizer._encoded(library, texts))
    assert machine.encode(["one two, three***", "Two three\nfour"]) == first
    machine.encode(["one two*** three,\nfour, two"])
    assert given == []
    monkeypatch.setattr(token_files, "REMEMBERED", 2)
    machine.encode(["five six"])
    assert given == ["five", " six"] and len(machine.known) == 2
    assert machine.encode(["one two, three***", "Two three\nfour"]) == first


def test_a_worker_remembers_from_task_to_task(spark, json_bytes):
    # Functions travel by value here, so each task has its own module.
    def known(_):
        machine = token_files.tokenizer_of(json_bytes)
        before = len(machine.known)
        machine.encode(["a text of some words"])
        return [(os.getpid(), before)]

    tasks = spark.sparkContext.parallelize(range(40), 40).mapPartitions(known).collect()
    assert sum(before == 0 for _, before in tasks) == len({pid for pid, _ in tasks}) < 40


def test_round_trip_and_selective_reads(spark, plain, json_bytes, numbered_texts, tmp_path):
    rows = [(3 * i, t) for i, t, _ in numbered_texts] + [(9, "again"), (None, "no id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    path = str(tmp_path / "tokens")
    write_tokens(df, json_bytes, path, row_group_bytes=4096, page_bytes=1024)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    at, expected = 0, []
    for i, t in order:
        ids = [*plain(t), 0]
        expected.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = sorted((tuple(r) for r in token_digest(read_tokens(spark, path)).collect()), key=lambda r: r[1])
    assert got == expected
    meta = read_metadata(spark, path)
    assert sorted((tuple(r) for r in meta.collect()), key=lambda r: r[1]) == [e[:3] for e in expected]
    assert "ids" not in meta._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1].split("\n")[0]
    part = read_tokens(spark, path, 30, 60)
    assert "GreaterThanOrEqual(doc_id,30)" in part._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["doc_id"] for r in part.collect()) == list(range(30, 61, 3))
    file = pq.ParquetFile(sorted((tmp_path / "tokens").glob("*.parquet"))[-1])
    ids = file.metadata.row_group(0).column(4)
    assert ids.has_offset_index and any("DICTIONARY" in e or "DELTA" in e for e in ids.encodings)


def test_empty_table(spark, json_bytes, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string")
    write_tokens(df, json_bytes, str(tmp_path / "none"))
    assert token_digest(read_tokens(spark, str(tmp_path / "none"))).count() == 0
