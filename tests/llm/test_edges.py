"""Every operator and every stage on nulls, empty and long texts, repeated rows, clashing columns, empty tables."""

from __future__ import annotations

import public_tokenizers
import pytest

import corpus_pipeline
from ledgermill.llm import licenses, lsa, minmax, mixture, rules, secrets, shards, simple8b, suffix_tree, toxicity
from tests.llm.cases import none, odd, odd_rows

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
N = len(odd_rows())


def benchmark(spark):
    return spark.createDataFrame([(1, "alpha beta gamma delta " * 5), (2, None), (3, ""), (None, "x y"), (1, "alpha beta gamma delta " * 5)], "item_id bigint, text string")


def labels(spark):
    return spark.createDataFrame([(4, 1), (4, 0), (5, 0), (6, 0), (None, 1), (7, None)], "doc_id bigint, label int")


OPERATORS = {
    "licenses": lambda s, d: licenses.scan(d),
    "suffix_tree": lambda s, d: suffix_tree.scores(d),
    "simple8b": lambda s, d: simple8b.read_digests(simple8b.write_ids(d, TOKENIZER)),
    "minmax": lambda s, d: minmax.near_duplicates(d),
    "toxicity": lambda s, d: toxicity.fit(d, labels(s)).score(d),
    "secrets": lambda s, d: secrets.secrets(d),
    "rules": lambda s, d: rules.judged(d),
    "shards": lambda s, d: shards.balanced(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_result_for_each_row(spark, name):
    assert len(OPERATORS[name](spark, odd(spark)).collect()) == N


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, none(spark)).collect() == []


def test_mixture_and_leaks_of_an_empty_table(spark):
    assert mixture.mix(none(spark), {"src0": 1.0}, 0.5).collect() == []
    assert lsa.leaks(none(spark), benchmark(spark)).collect() == []
    assert lsa.leaks(odd(spark), benchmark(spark).limit(0)).collect() == []


def test_leaks_of_odd_rows(spark):
    assert lsa.leaks(odd(spark), benchmark(spark)).collect() == []
    assert lsa.without_leaks(odd(spark), benchmark(spark)).count() == N


def test_a_text_of_the_mixture_may_be_missing(spark):
    rows = mixture.mix(odd(spark), {"src0": 1.0}, 1.0, target=10**9).select("d.*", "n_copies").collect()
    assert {r["doc_id"] for r in rows} == {None, 1, 2, 3, 4, 5, 6, 7, 8, 9}


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
@pytest.mark.parametrize("table", (odd, none))
def test_stages_bear_anything(spark, sf_dir, stage, table):
    name, function = corpus_pipeline.STAGES[stage]
    docs = table(spark)
    out = function(spark, docs, sf_dir)
    if stage < len(corpus_pipeline.STAGES) - 1:
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
    rows = out.collect()
    if table is none:
        assert rows == []
    elif name == "quality":
        assert sorted(r["doc_id"] or 0 for r in rows) == [0, 5, 6, 6, 7, 8]
    elif name == "near_dedup":
        # 6 once, 7, 8 and a row without doc_id are its copies; rows without words stay
        assert sorted(r["doc_id"] or 0 for r in rows) == [0, 1, 2, 3, 4, 5, 6, 9]
    elif name == "decontaminate":
        assert len(rows) == N
    elif name == "token_files":
        order = [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"])]
        assert sorted(order, key=lambda i: i or 0) == [None, None, 1, 2, 3, 4, 5, 6, 6, 7, 8, 9] and order != sorted(order, key=lambda i: i or 0)


def test_rows_without_words(spark):
    got = {r["doc_id"]: r for r in minmax.near_duplicates(odd(spark)).where("doc_id is not null").collect()}
    for doc_id in (1, 2, 3):
        assert (got[doc_id]["n_shingles"], got[doc_id]["component_id"], got[doc_id]["kept"]) == (0, doc_id, True)
    assert got[4]["n_shingles"] == 1
    assert [got[i]["component_id"] for i in (6, 7, 8)] == [6, 6, 6]
    sizes = {r["doc_id"]: (r["size"], r["text_crc32"]) for r in shards.balanced(odd(spark)).collect()}
    assert sizes[1] == sizes[2] == (8, 0)
    scores = {r["doc_id"]: r for r in suffix_tree.scores(odd(spark)).collect()}
    assert scores[1]["n_tokens"] == scores[2]["n_tokens"] == scores[3]["n_tokens"] == 1


def test_rows_without_an_id_are_judged_too(spark):
    item = " ".join(f"item{i}" for i in range(20))
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(None, f"{text} {item}", "a"), (1, f"{item} {text}", "b"), (None, text, "c"), (None, text, "d"), (2, "other words", "e"), (None, "other words", "f")]
    docs = spark.createDataFrame([(None, "never " * 3 + "near anything", "g"), *rows], "doc_id bigint, text string, d string")
    clean = lsa.without_leaks(docs, spark.createDataFrame([(1, item)], "item_id bigint, text string"))
    assert sorted(r["d"] for r in clean.collect()) == ["c", "d", "e", "f", "g"]
    kept = sorted(r["d"] for r in minmax.without_near_duplicates(docs.where("d not in ('a', 'b')")).collect())
    assert kept in (["c", "e", "g"], ["d", "e", "g"])


def test_token_files_are_in_the_order_of_the_mixture(spark, sf_dir):
    docs = spark.createDataFrame([(i, f"text number {i}", "en", "src0", 9) for i in range(40)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    wanted = [r["doc_id"] for r in mixture.mix(docs, {"src0": 1.0}, 0.0, target=3000).select("d.doc_id", "place").orderBy("place").collect()]
    stages = dict(corpus_pipeline.STAGES)
    mixed = mixture.mix(docs, {"src0": 1.0}, 0.0, target=3000).select("d.*").repartition(3)
    got = [r["doc_id"] for r in stages["token_files"](spark, mixed, sf_dir).orderBy("start").collect()]
    assert got == wanted and got != sorted(got) and len(got) > len(set(got))


def test_labels_of_one_class_give_a_constant(spark):
    only = labels(spark).where("label = 0")
    assert {r["score"] for r in toxicity.fit(odd(spark), only).score(odd(spark)).collect()} == {0.0}
    assert {r["score"] for r in toxicity.fit(odd(spark), only.limit(0)).score(odd(spark)).collect()} == {0.0}
