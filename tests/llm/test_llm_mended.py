"""Edge cases of operators: rows that share an id, letters, ids of any type, rare languages."""

import random

import pytest

from panelforge.llm import common, decontamination, language, simhash

A = "one two three four five six seven eight nine ten eleven twelve " * 3
B = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu " * 3


@pytest.mark.parametrize("seed", range(3))
def test_near_duplicates_keep_a_row_of_each_group_in_any_order(spark, seed):
    rows = [(5, B), (5, A), (3, B), (None, A), (None, "quite another text of its own here"), (7, None), (8, "")]
    random.Random(seed).shuffle(rows)
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3))
    assert sorted(kept.collect(), key=str) == sorted([(3, B), (5, A), (None, "quite another text of its own here"), (7, None)], key=str)


def test_near_duplicates_of_rows_that_share_id_and_text(spark):
    rows = [(1, A, "x", 1), (1, A, "y", 2), (1, B, "z", 3), (2, A, "w", 4)]
    schema = "doc_id bigint, text string, `a.b` string, __own int"
    for some in (rows, rows[::-1]):
        kept = sorted(simhash.keep_one(spark.createDataFrame(some, schema)).collect())
        assert [(r.doc_id, r.text) for r in kept] == [(1, B), (1, A)] or [(r.doc_id, r.text) for r in kept] == [(1, A), (1, B)]
        assert len(kept) == 2 and kept[1 if kept[1].text == A else 0]["__own"] in (1, 2)
    first = simhash.keep_one(spark.createDataFrame(rows, schema)).collect()
    again = simhash.keep_one(spark.createDataFrame(rows[::-1], schema).repartition(4)).collect()
    assert sorted(first) == sorted(again)
    assert simhash.keep_one(spark.createDataFrame([], schema)).count() == 0


def test_numbers_are_no_letters(spark):
    model = language.fit([("the cat sat on the mat", "en"), ("le chat est sur la table", "fr")] * 5)
    texts = ["½ ²", "Ⅷ ①", "12 _ !", None, "", "a½", "日本"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    got = {r.doc_id: r.language for r in language.identify(df, model).collect()}
    assert [got[i].language == "und" and got[i].score == 0 for i in range(7)] == [True] * 5 + [False] * 2


def test_a_rare_language_is_in_the_sample(spark):
    rows = [(i, f"text {i}", "en") for i in range(3000)] + [(5000 + i, f"teksto {i}", "eo") for i in range(3)] + [(1, "text 1", "en")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(5)
    drawn = common.drawn(df, 20, "lang")
    assert sum(r.lang == "eo" for r in drawn) == 3 and sum(r.lang == "en" for r in drawn) == 20
    assert drawn == common.drawn(df.repartition(2), 20, "lang")


@pytest.mark.parametrize("ids,kind", [(["q-1", "q-2"], "string"), ([7, 8], "int"), ([70000000000, 8], "bigint")])
def test_items_have_ids_of_any_type(spark, ids, kind):
    text = " ".join(f"w{i}" for i in range(20))
    docs = spark.createDataFrame([(1, f"before {text} after"), (2, "nothing of it"), (3, None), (4, "")], "doc_id bigint, text string")
    bench = spark.createDataFrame([(ids[0], text), (ids[1], "other words " * 10)], f"item_id {kind}, text string")
    hits = {r.doc_id: r.hits for r in decontamination.decontaminate(docs, bench).collect()}
    assert hits[1]["items"] == [ids[0]] and hits[1]["n_hit"] == 20 and hits[1]["contaminated"]
    assert all(hits[i]["items"] == [] and not hits[i]["contaminated"] for i in (2, 3, 4))
    none = decontamination.decontaminate(docs, bench.where("false")).collect()
    assert all(r.hits["items"] == [] for r in none)
