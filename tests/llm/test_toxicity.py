import random

import pytest

from quayside.llm import toxicity


@pytest.fixture(scope="module")
def corpus(spark):
    """Insults make a text toxic; a group is mentioned in toxic texts more often than in others."""
    r = random.Random(9)
    plain = ["".join(r.choice("abdeilmnorst") for _ in range(5)) for _ in range(200)]
    insults = ["blockhead", "blockheads", "nitwit", "dunce"]
    docs, labels = [], []
    for i in range(1500):
        toxic = int(i % 6 == 0)
        words = [r.choice(plain) for _ in range(r.randint(5, 60))]
        if toxic:
            words.insert(r.randrange(len(words)), r.choice(insults) + r.choice(["", ".", "!"]))
        if r.random() < (0.6 if toxic else 0.03):
            words.insert(r.randrange(len(words)), "muslims")
        docs.append((i, " ".join(words)))
        labels.append((i, toxic))
    docs += [(5000, None), (5001, ""), (5002, "muslims and their neighbours"), (5003, "BLOCKHEAD"), (5003, "BLOCKHEAD")]
    labels += [(7, 0), (8, None), (None, 1)]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_accuracy(corpus):
    docs, labels = corpus
    model = toxicity.fit(docs, labels)
    truth = {r["doc_id"]: r["toxic"] for r in labels.filter("doc_id is not null and toxic is not null").collect()}
    import zlib

    held = [r for r in toxicity.score(docs, model).collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["doc_id"] < 5000]
    assert len(held) > 200
    right = sum((r["score"] >= 0.5) == (truth[r["doc_id"]] == 1) for r in held)
    assert right / len(held) > 0.98


def test_swaps_take_weight_off_mentions(corpus):
    docs, labels = corpus
    held = toxicity.fit(docs, labels)
    free = toxicity.fit(docs, labels, swap_penalty=0.0)
    text = "muslims and their neighbours"
    assert free.scorer()(text) > 2 * held.scorer()(text)
    assert held.scorer()(text) < 0.5 <= held.scorer()("what a nitwit")


def test_odd_texts_and_filter(spark, corpus):
    docs, labels = corpus
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert {5000, 5001, 5002} <= ids and 5003 not in ids
    none = toxicity.fit(docs, labels.limit(0))
    scores = [r["score"] for r in toxicity.score(docs.limit(0), none).collect()]
    assert scores == [] and none.scorer()("x") == 0.5
