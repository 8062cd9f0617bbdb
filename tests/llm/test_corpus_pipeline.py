import hashlib

import corpus_pipeline
import duckdb
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F
from test_jaccard import brute

from matchstream.llm import bpe, decontaminate, exact_dedup, language_id
from matchstream.llm.registry import ORACLES, QUERIES


def test_run_against_brute_force(spark, sf_dir):
    """Each stage anew in plain Python, on what the one before kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    samples = language_id.learn_samples(language_id.training_rows(docs))
    classifier = language_id.Classifier(samples)
    rows = [r for r in docs.collect() if not classifier.classify(r.text or "")[2]]
    first = {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        first.setdefault(exact_dedup.normalised((r.text or "").encode()), r)
    rows = list(first.values())
    found, _ = brute([(r.doc_id, r.text) for r in rows], 5, (80, 100))
    heads = {c for _, _, c in found}
    rows = [r for r in rows if r.doc_id in heads]
    items = [decontaminate.words_only(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    rows = [r for r in rows if not any(i in decontaminate.words_only(r.text) for i in items)]
    with open(bpe.default_vocabulary(), "rb") as f:
        ranks = bpe.read_ranks(f.read())
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert set(got) == {r.doc_id for r in rows}
    for r in rows:
        assert got[r.doc_id].token_ids == encoding.encode_ordinary(r.text)
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()


def test_stages_return_the_columns_of_documents(spark, sf_dir, make_docs):
    docs = make_docs([(1, None), (2, ""), (3, "x"), (None, "y z"), (3, "x")])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns
        assert stage(spark, docs.where("false"), sf_dir).columns == docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language ID", "exact dedup", "n-gram Jaccard join", "benchmark decontamination", "byte-level BPE",
    ]


def test_stages_keep_the_input_s_own_values(spark, sf_dir, make_docs):
    """Columns named like those that the operators add come back with their values."""
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").where("length(text) > 400").orderBy("doc_id").limit(30).collect()]
    docs = make_docs([(i, t, "en", "s", i) for i, t in enumerate(texts)])
    names = ["score", "rejected", "lang_pred", "kept", "keep_id", "group_size", "text_sha256", "leaks", "_row", "row", "id", "_chunk", "component"]
    for i, name in enumerate(names):
        docs = docs.withColumn(name, (F.col("doc_id") * 100 + i).cast("double" if i % 2 else "string"))
    known = {r.doc_id: tuple(r) for r in docs.collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, sf_dir)
        assert got.schema == docs.schema
        rows = got.collect()
        assert rows and all(known[r.doc_id] == tuple(r) for r in rows)


def test_registered_queries_against_sql(spark, sf_dir):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    assert sorted(k.split("_")[0] for k in QUERIES) == sorted(f"op{n}" for n in range(1, 14))
    for name, sql in ORACLES.items():
        want = con.sql(sql)
        got = QUERIES[name](spark, sf_dir)
        assert sorted(got.columns) == sorted(want.columns)
        assert sorted(tuple(r[c] for c in want.columns) for r in got.collect()) == sorted(want.fetchall())
