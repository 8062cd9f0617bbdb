import hashlib
import random
import re

import numpy as np
from llm_data import words
from pyspark.sql import functions as F

from matchstream.llm import fill_middle as X

TOKEN = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def brute(doc_id, text):
    text = text or ""
    tokens = TOKEN.findall(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(tokens)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


ODD = ["", None, "a", " ", "é", "a<", "<P", "S>x<", "<<P<S><M", "<P>", "x<S>y", "<M>", "日本語 text ñ 🙂🙂", "a\r\n\tb", "\0", "<", ">", "P>a<S"]


def test_against_brute_force_and_round_trip(make_docs):
    draw = random.Random(5)
    texts = [words(draw.randrange(40), i) + draw.choice(["", "é", "<P", "\n", " 🙂."]) for i in range(300)]
    rows = [(i, t) for i, t in enumerate(ODD * 20 + texts)]
    rows += [(7, "twice"), (7, "twice"), (None, "no id"), (None, None), (9001, words(300_000, 2) + "é")]
    made = X.restored(X.fill_in_middle(make_docs(rows).select("doc_id", "text", F.col("text").alias("given"))))
    got = sorted(((r.doc_id, r.given or "", r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in made.collect()), key=str)
    want = sorted(((i, t or "", *brute(i, t)) for i, t in rows), key=str)
    assert got == want
    assert all(r.restored == (r.given or "") for r in made.collect())
    assert {r[3] for r in got} == {"plain", "psm", "spm"}


def test_controls_across_texts_do_not_count():
    numbers = np.array([[0, 0, 0, 50]] * 3, np.int64)
    out, bounds, n, form, _, _ = X.transform([b"a<", b"P", b">b"], numbers)
    assert form.tolist() == [1, 1, 1] and n.tolist() == [2, 1, 2]
    back, ends = X.restore([bytes(out[a:b]) for a, b in zip(bounds, bounds[1:])], ["psm"] * 3)
    assert bytes(back) == b"a<P>b" and ends.tolist() == [0, 2, 3, 5]


def test_empty_table_and_clashing_columns(make_docs):
    docs = make_docs([(1, "one two"), (2, None)]).withColumn("form", F.lit("mine")).withColumn("_row", F.lit(5))
    made = X.restored(X.fill_in_middle(docs).withColumn("restored", F.lit("old")))
    assert made.columns == ["doc_id", "lang", "source", "n_chars", "_row", *X.RESULT.names, "restored"]
    assert {(r.doc_id, r._row, r.restored) for r in made.collect()} == {(1, 5, "one two"), (2, 5, "")}
    assert X.restored(X.fill_in_middle(make_docs([]))).count() == 0


def test_query(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = X.op13_fill_middle(spark, sf_dir).collect()
    assert len(got) == len(docs)
    for r in got:
        n, form, prefix, middle, output = brute(r.doc_id, docs[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, prefix, middle)
        assert r.output_sha256 == hashlib.sha256(output.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256((docs[r.doc_id] or "").encode()).hexdigest()
