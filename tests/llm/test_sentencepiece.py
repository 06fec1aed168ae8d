import random

import public_tokenizers
import pytest
import sentencepiece

from quayside.llm.sentencepiece_fst import BYTE, PieceTransducer, crc_of_ids, decode_column, encode_documents, read_model

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  two  ", "▁x▁", "日本𠀀 ①", "\n\t", "x" * 3000, "naïve Ünïcode ﬁ", "a" + " " * 40 + "b", "The quick brown fox."]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_equals_the_library(library, numbered_texts):
    machine = PieceTransducer(read_model(PATH))
    r = random.Random(2)
    noise = ["".join(r.choice("etaoinshr ETAO.,-12é中") for _ in range(80)) for _ in range(300)]
    spaces = [" " * k + "a" + " " * (k + 3) + "the  cat" + " " * k for k in range(40)]
    texts = ODD + noise + spaces + [t or "" for _, t, _ in numbered_texts]
    ids = [found.tolist() for found in machine.encode_all(texts)]
    assert ids == [machine.encode(t).tolist() for t in texts]
    assert ids == library.encode(texts)
    assert [machine.decode(i) for i in ids] == library.decode(ids)


def test_long_texts_without_spaces(library):
    r = random.Random(3)
    texts = ["abcdefgh" * 8000, "the" * 4000 + "é中" * 3000, "".join(r.choice("etaoinshr") for _ in range(30_000))]
    machine = PieceTransducer(read_model(PATH))
    assert [found.tolist() for found in machine.encode_all(texts)] == library.encode(texts)


def merged_by_rank(pieces, text):
    """BPE by its definition, with plain lists."""
    parts = list(text)
    while True:
        found = [(-pieces[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in pieces]
        if not found:
            return parts
        at = min(found)[1]
        parts[at : at + 2] = [parts[at] + parts[at + 1]]


def test_bpe_of_random_models():
    """Merges in trained order, and pieces that rank before or level with a part they are merged from."""
    r = random.Random(4)
    for trained in [True] * 15 + [False] * 15:
        pieces, known = {c: 0.0 for c in "▁abc"}, list("▁abc")
        for rank in range(1, 25):
            piece = r.choice(known) + r.choice(known)
            if piece not in pieces and len(piece) < 9 and "▁" not in piece[1:]:
                pieces[piece] = -float(rank) if trained else -float(r.randint(1, 12))
                known.append(piece)
        model = b"".join(message((1, message((1, p.encode()), (2, s), (3, 1)))) for p, s in pieces.items())
        model += message((2, message((3, 2)))) + message((3, message((3, 1), (4, 0))))
        machine = PieceTransducer(model)
        texts = ["".join(r.choice("aaabbc ") for _ in range(r.randint(1, 60))) for _ in range(60)]
        texts += ["".join(r.choice("aab") for _ in range(3000))]
        for text in texts:
            assert [machine.pieces[i] for i in machine.encode(text)] == merged_by_rank(pieces, "▁" + text.replace(" ", "▁"))


def message(*fields):
    out = b""
    for number, value in fields:
        if isinstance(value, int):
            out += bytes([number << 3, value])
        elif isinstance(value, float):
            import struct

            out += bytes([number << 3 | 5]) + struct.pack("<f", value)
        else:
            out += bytes([number << 3 | 2, len(value)]) + value
    return out


def test_unigram_takes_the_lightest_path():
    pieces = [("<unk>", 0.0, 2), ("▁a", -1.0, 1), ("b", -1.0, 1), ("▁ab", -2.5, 1), ("bb", -0.5, 1), ("▁", -3.0, 1), ("a", -3.0, 1)]
    pieces += [(f"<0x{v:02X}>", 0.0, BYTE) for v in range(256)]
    model = b"".join(message((1, message((1, p.encode()), (2, s), (3, k)))) for p, s, k in pieces)
    model += message((2, message((3, 1)))) + message((3, message((3, 1), (4, 0))))
    machine = PieceTransducer(model)
    shown = lambda t: [machine.pieces[i] for i in machine.encode(t)]
    assert shown("ab") == ["▁a", "b"]
    assert shown("abb") == ["▁a", "bb"]
    assert shown("az") == ["▁a", "<0x7A>"]
    assert machine.decode(machine.encode("az b")) == "az b"


def test_columns(spark, library):
    rows = [(1, "hello world", "k"), (2, None, None), (3, "", "k"), (3, "", "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_fallback string")
    model = read_model(PATH)
    coded = encode_documents(df, model)
    assert coded.columns == ["doc_id", "ids", "n_fallback"]
    got = coded.withColumn("back", decode_column(coded["ids"], model, spark)).withColumn("crc", crc_of_ids(coded["ids"])).collect()
    assert [(r["doc_id"], r["ids"], r["back"]) for r in got] == [
        (1, library.encode("hello world"), "hello world"), (2, [], ""), (3, [], ""), (3, [], "")
    ]
    assert encode_documents(df.limit(0), model).count() == 0
    checked = encode_documents(df, model, ids_crc32="crc", round_trip="doc_id").collect()
    assert [(r["ids"], r["crc"], r["doc_id"]) for r in checked] == [(r["ids"], r["crc"], True) for r in got]
