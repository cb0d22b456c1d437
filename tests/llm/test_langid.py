"""Language identification: held-out accuracy, backoff, and rows without words."""

import pytest

from vacantia.llm import langid

EN = ["the house and the garden with a river", "and with the tree of the house", "a garden of the river"]
DE = ["das haus und der garten mit einem fluss", "und mit dem baum der garten", "ein garten und das haus"]


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, t, "en") for i, t in enumerate(EN * 3)] + [(i, t, "de") for i, t in enumerate(DE * 3)]
    rows += [(1, None, "en"), (2, "nobody says", None)]
    return langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_known_words_and_backoff(spark, model):
    assert model.langs == ["de", "en"]
    scorer = langid.Scorer(model)
    assert scorer.predict("The river!")[0] == "en"
    assert scorer.predict("Das Haus.")[0] == "de"
    assert "fluxx" not in model.words and scorer.predict("Flusse")[0] == "de"
    # No 5-gram of this word is known, a shorter run is.
    assert scorer.unseen_words(["zzgart"]).tolist() != [0, 0]


def test_rows_without_words(spark, model):
    rows = [(1, None), (2, ""), (3, "123 --- 45"), (4, "das " * 30_000), (4, "das " * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("text", "score")
    got = docs.select("doc_id", langid.predicted(model, docs, "score").alias("p")).collect()
    found = sorted((r.doc_id, r.p.lang, round(r.p.score, 3)) for r in got)
    assert [f[1] for f in found] == ["und", "und", "und", "de", "de"]
    assert found[0][2] == 0 and all(0 <= f[2] <= 1 for f in found)


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    empty = langid.fit(none)
    assert empty.langs == [] and langid.Scorer(empty).predict("some words") == ("und", 0.0)


def test_held_out_accuracy(spark):
    import zlib

    from vacantia.llm.workloads import QUERIES

    folder = "/root/testdata/sf0.001"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op9_word_first_language"](spark, folder).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def test_whole_words_count(spark):
    """Languages without spaces whose texts begin alike and differ after 24 characters."""
    head = "的一不是" * 8
    one, two = "我人在有他", "のはがをに"
    rows = [(i, head + own * (10 + i), lang) for i in range(20) for own, lang in ((one, "zh"), (two, "ja"))]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    scorer = langid.Scorer(model)
    assert scorer.predict(head + one * 40)[0] == "zh"
    assert scorer.predict(head + two * 40)[0] == "ja"
    assert two[-2:] + "$" in model.grams[3] and head[21:24] + "$" not in model.grams[4]
    assert scorer.unseen_words([two * 50_000]).shape == (2,)


def test_small_language_keeps_its_words(spark):
    """Bounds are shared among languages, whatever their sizes; no other rule at any size."""
    rows = [(i, f"the house w{'abcdefghij'[i % 10]}x of{'abcdefghij'[i // 10 % 10]}", "en") for i in range(400)] + [(1000, "hasi mbali kabisa", "sw")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df, max_rows=40, max_words=8, max_grams=40)
    assert {"hasi", "mbali", "kabisa"} <= set(model.words) and len(model.words) <= 8
    scorer = langid.Scorer(model)
    assert scorer.predict("mbali kabisa")[0] == "sw"
    # nothing known: the language with most learned words, with an equal share
    assert scorer.predict("\u0416\u0416") == ("en", 0.5)
    assert langid.sample(df, "lang", "text", 40).filter("lang = 'sw'").count() == 1
    assert langid.sample(df, "lang", "text", 40).count() < 60
