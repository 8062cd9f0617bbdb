import zlib

from llm_data import words
from pyspark.sql import functions as F

from matchstream.llm import language_id as L


def test_held_out_accuracy(spark, sf_dir):
    found = L.op9_language_id(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = found.join(docs, "doc_id").where("held_out").collect()
    assert len(rows) > 200
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.99 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)
    assert {r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found.collect()} == {True}
    wrong = [r for r in rows if r.lang_pred != r.lang and not r.rejected]
    assert len(wrong) <= 0.01 * len(rows)


def test_edge_cases(make_docs):
    samples = {"a": "der die und ein nicht " * 30 + "schreiben gehen haus", "b": "the and of with house writing going " * 30}
    rows = [(1, None), (2, ""), (3, "12 + 3!"), (4, "der Haus und die schreiben nicht"), (5, "the house and writing with"), (None, "the writing and the house"),
            (6, words(100_000, 1)), (6, words(100_000, 1)), (7, "²³ ½")]
    docs = make_docs(rows).withColumn("score", F.lit("old"))
    found = L.identify(docs, samples).collect()
    by_id = {r.doc_id: r for r in found}
    assert len(found) == len(rows)
    for i in (1, 2, 3, 7):
        assert (by_id[i].lang_pred, by_id[i].score, by_id[i].rejected) == ("und", 0.0, True)
    assert by_id[4].lang_pred == "a" and by_id[5].lang_pred == "b" and by_id[None].lang_pred == "b"
    assert not by_id[4].rejected and not by_id[5].rejected
    assert all(r.lang_pred == "und" for r in L.identify(docs, {}).collect())
    assert L.identify(make_docs([]), samples).count() == 0
    assert {r.lang_pred for r in L.identify(docs, {"x": "one"}).collect()} == {"x", "und"}


def test_learns_only_from_labelled_letters(make_docs):
    rows = [(1, "alpha beta", "x"), (2, None, "x"), (3, "gamma", None), (4, "123", "y"), (5, "delta", "z"), (5, "delta", "z")]
    samples = L.learn_samples(make_docs(rows))
    assert set(samples) == {"x", "z"} and samples["x"] == "alpha beta"
    assert L.learn_samples(make_docs([])) == {}
    kept = {r.doc_id for r in L.training_rows(make_docs([(i, "t") for i in range(200)] + [(None, "t")])).collect()}
    assert kept == {i for i in range(200) if zlib.crc32(str(i).encode()) % 4 != 2}


def test_copies_of_a_text_teach_once(make_docs):
    import matchstream.llm.language_id as X

    rows = [(i, "copied text of one kind", "aa") for i in range(900)] + [(1000 + i, f"other {chr(97 + i)} text", "aa") for i in range(20)]
    sample = X.learn_samples(make_docs(rows))["aa"].split("\n")
    assert len(sample) == len(set(sample)) == 21
