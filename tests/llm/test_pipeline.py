"""Every stage of the pipeline against a plain version of it, on what the stage before kept."""

import re

import pytest
import sentencepiece
from test_simhash import brute as brute_print
from test_simhash import groups
from test_substrings import brute as brute_cut

import corpus_pipeline
from quayside.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, found[-1], SF).write.parquet(f"{folder}/{name}")
        found.append(spark.read.parquet(f"{folder}/{name}"))
    return found


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_order_and_columns(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "simhash_near_dedup", "substring_dedup", "source_mixing", "sentencepiece"]
    for df in stages[1:-1]:
        assert df.dtypes == stages[0].dtypes


def test_toxic_documents_go(spark, stages):
    insult = re.compile(r"\b(stupid|idiot|moron|scum|loser|pathetic|worthless|trash|clown|disgusting)\b", re.I)
    before, after = texts(stages[0]), texts(stages[1])
    gone = before.keys() - after.keys()
    rude = {i for i, t in before.items() if len(insult.findall(t)) >= 1}
    assert len(gone & rude) >= 0.7 * len(rude) and len(gone - rude) <= 0.1 * len(before)
    assert all(after[i] == before[i] for i in after)


def test_one_of_each_group_stays(stages):
    before, after = texts(stages[1]), texts(stages[2])
    component = groups({i: brute_print(t) for i, t in before.items()})
    assert after == {i: t for i, t in before.items() if component[i] == i}


def test_repeats_are_cut(stages):
    before, after = texts(stages[2]), texts(stages[3])
    cut = {i: (n_removed, kept) for i, _, n_removed, kept in brute_cut(before.items(), 20)}
    assert after == {i: cut[i][1] if cut[i][0] else t for i, t in before.items()}


def test_sources_come_near_their_targets(stages):
    from quayside.llm.mixing import targets

    def sizes(df):
        out = {}
        for r in df.collect():
            out[r["source"]] = out.get(r["source"], 0) + len(r["text"].split())
        return out

    before, after = sizes(stages[3]), sizes(stages[4])
    ranked = sorted(before)
    wanted = targets([before[s] for s in ranked], [(3, 1, 2)[i % 3] for i in range(len(ranked))])
    assert all(abs(after.get(s, 0) - t) <= 1.01 for s, t in zip(ranked, wanted, strict=True))


def test_ids_are_the_librarys(spark, stages):
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    before = texts(stages[4])
    got = {r["doc_id"]: (r["n_tokens"], r["ids"]) for r in stages[5].collect()}
    want = dict(zip(before, library.encode(list(before.values())), strict=True))
    assert got == {i: (len(ids), ids) for i, ids in want.items()}


def test_run_equals_the_stages(spark, stages):
    whole = {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, SF).collect()}
    assert whole == {r["doc_id"]: r["ids"] for r in stages[5].collect()}


CLASHING = ["_qs_copy1", "_qs_score", "_qs_id", "_qs_spans", "score", "id", "copy", "fp", "group", "n"]


def test_columns_of_any_name_pass_through(spark):
    """Null ids, repeated ids, null and empty texts and names the operators use themselves."""
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(1, words, "a"), (1, words + " end", "a"), (2, None, "b"), (3, "", None), (None, "of no id " + words[:90], "b")]
    rows += [(i, f"text {i} " + " ".join(f"v{i}x{j}" for j in range(40)), "ab"[i % 2]) for i in range(4, 12)]
    df = spark.createDataFrame(
        [(*r, *[f"{c}-{n}" for c in CLASHING]) for n, r in enumerate(rows)],
        "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in CLASHING),
    )
    labels = spark.createDataFrame([(i, 0, int(i == 4)) for i in range(1, 12)], "doc_id long, quality int, toxic int")
    told = corpus_pipeline.drop_toxic(df, labels)
    once = corpus_pipeline.drop_near_duplicates(df)
    cut = corpus_pipeline.dedup_substrings(df)
    mixed = corpus_pipeline.mixed_documents(df)
    for out in (told, once, cut, mixed):
        assert out.columns == df.columns
        got = out.collect()
        assert got
        for r in got:
            number = r["_qs_id"].split("-")[1]
            assert [r[c] for c in CLASHING] == [f"{c}-{number}" for c in CLASHING]
            assert (r["doc_id"], r["source"]) == (rows[int(number)][0], rows[int(number)][2])
    for stage in (corpus_pipeline.drop_near_duplicates, corpus_pipeline.dedup_substrings, corpus_pipeline.mixed_documents):
        assert stage(df.limit(0)).count() == 0
