import random

from llm_data import words
from pyspark.sql import functions as F

from matchstream.llm import decontaminate as D

ITEMS = [(1, words(40, 1)), (2, words(25, 2)), (3, words(90, 3)), (4, "too short"), (5, None), (6, words(40, 1)), (7, words(6, 7))]


def distance(piece, text):
    """The fewest edits that make the piece a part of the text."""
    before = [0] * (len(text) + 1)
    for c in piece:
        now = [before[0] + 1]
        for j, d in enumerate(text):
            now.append(min(before[j] + (c != d), before[j + 1] + 1, now[j] + 1))
        before = now
    return min(before)


def edited(text, n, draw):
    out = list(text)
    for _ in range(n):
        k = draw.randrange(len(out))
        what = draw.randrange(3)
        if what == 0:
            out[k] = draw.choice("abcdef ")
        elif what == 1:
            del out[k]
        else:
            out.insert(k, draw.choice("abcdef "))
    return "".join(out)


def test_lemma_and_alignment_against_brute_force():
    draw = random.Random(1)
    probes = D.Probes(ITEMS)
    texts = []
    for _ in range(120):
        item = draw.choice([t for i, t in ITEMS if i in (1, 2, 3, 7)])
        at = draw.randrange(max(1, len(item) - 100))
        texts.append(f"{words(5, draw.random())} {edited(item[at : at + 150], draw.choice([0, 2, 4, 6, 7, 8, 12]), draw)} {words(6, draw.random())}")
    some = 0
    for text, found in zip(texts, probes.search(texts), strict=True):
        reduced = D.words_only(text)
        want = {}
        for item, codes, k in zip(probes.item, probes.codes, probes.budget):
            edits = distance("".join(map(chr, codes)), reduced)
            if edits <= k:
                want[item] = min(want.get(item, 99), edits)
        assert {x["item_id"]: x["edits"] for x in found} == want
        some += bool(want)
    assert 30 < some < 120


def test_operator(spark, make_docs, tmp_path):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    item = ITEMS[0][1]
    rows = [(1, None), (2, ""), (3, words(30_000, 11) + " " + item.upper() + ". " + words(20, 12)), (4, item), (4, item), (None, "So: " + item + "!"),
            (5, words(300, 13)), (6, "too short"), (7, " ".join(reversed(item.split()))), (8, ITEMS[2][1][:200])]
    docs = make_docs(rows).withColumn("leaks", F.lit("old")).withColumn("item_id", F.lit(0))
    found = D.find_leaks(docs, benchmark)
    got = sorted(((r.doc_id or 0), [(x.item_id, x.edits) for x in r.leaks]) for r in found.collect())
    both = [(1, 0), (6, 0)]
    assert got == [(0, both), (1, []), (2, []), (3, both), (4, both), (4, both), (5, []), (6, [(4, 0)]), (7, []), (8, [(3, 0)])]
    assert all(not r.leaks for r in D.find_leaks(docs, benchmark.where("false")).collect())
    assert D.find_leaks(make_docs([]), benchmark).count() == 0


def test_blocks_give_the_same(spark, make_docs, monkeypatch):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = make_docs([(i, f"{words(20, i)} {t or ''} {words(9, i + 50)}") for i, t in ITEMS])
    whole = {r.doc_id: sorted(r.leaks) for r in D.find_leaks(docs, benchmark).collect()}
    monkeypatch.setattr(D, "BLOCK_BYTES", 300)
    assert {r.doc_id: sorted(r.leaks) for r in D.find_leaks(docs, benchmark).collect()} == whole


def test_query_finds_the_items_that_documents_hold(spark, sf_dir):
    docs = {r.doc_id: D.words_only(r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    items = {r.item_id: D.words_only(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    want = {(d, i) for d, text in docs.items() for i, item in items.items() if item in text}
    assert {(r.doc_id, r.item_id) for r in D.op10_decontaminate(spark, sf_dir).collect()} == want
    assert want


def test_short_items_and_items_without_an_id(spark, make_docs):
    """Short items are found by their whole words, in any number and place; an item without an id counts too."""
    item = words(30, 21)
    items = [(1, "What is the capital of Peru?"), (2, "is the"), (None, "Lima!"), (None, item), (3, "?!"), (4, ""), (5, None), (6, "首都是哪里"), (2, "is the")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = [(1, "so: what IS the\ncapital, of peru"), (2, "what is the capital of perus"), (3, "lima"), (4, "limas alima"), (5, "x " + item + " y"),
            (6, "this the"), (7, "is the is the"), (8, "问 首都是哪里 吗"), (9, "?!"), (10, None)]
    found = D.find_leaks(make_docs(rows), benchmark)
    got = {r.doc_id: sorted(((x.item_id or 0), x.start, x.end, x.edits) for x in r.leaks) for r in found.collect()}
    assert got == {
        1: [(1, 3, 30, 0), (2, 8, 14, 0)], 2: [(2, 5, 11, 0)], 3: [(0, 0, 4, 0)], 4: [],
        5: [(0, 2, 122, 0)],  # the place of a piece
        6: [], 7: [(2, 0, 6, 0)], 8: [(6, 2, 7, 0)], 9: [], 10: [],
    }
