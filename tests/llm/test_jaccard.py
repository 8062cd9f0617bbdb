import random
import re

import numpy as np
import pytest
from llm_data import words
from pyspark.sql import functions as F

from matchstream.llm import jaccard_join as J
from matchstream.llm.components import components
from matchstream.llm.rtree import CountRTree, count_vector


def shingles(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return set(zip(*(w[k:] for k in range(width)))) if len(w) >= width else ({tuple(w)} if w else set())


def brute(rows, width, share):
    """(id, set size, smallest reachable id) of each row, by comparing all pairs."""
    sets = [shingles(t, width) for _, t in rows]
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and share[1] * both >= share[0] * len(sets[i] | sets[j]):
                group[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[top(i)] = min(least.get(top(i), doc_id), doc_id)
    return sorted((d, len(sets[i]), least.get(top(i))) for i, (d, _) in enumerate(rows) if d is not None), len({top(i) for i in range(len(rows))})


def near_copies(n, seed, length=120, most=8):
    draw = random.Random(seed)
    base = words(length, seed).split()
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(draw.randint(0, most)):
            w[draw.randrange(len(w))] = f"x{draw.randrange(10_000)}"
        out.append(" ".join(w))
    return out


@pytest.fixture(scope="module")
def rows():
    passage = words(60, 77)
    texts = [None, "", " \n", "one", "ONE", "one two three", "one two  Three", "a b c d", "a b c d e", words(30_000, 5), words(30_000, 5) + " end"]
    for seed in range(6):
        texts += near_copies(25, seed, most=seed * 2)
    texts += [words(40, 1000 + i) + " " + passage for i in range(40)]  # a shared passage links nothing
    texts += [passage] * 3 + near_copies(60, 99, length=30, most=3)
    order = random.Random(2).sample(range(len(texts)), len(texts))
    return [(i * 3 + 1, texts[k]) for i, k in enumerate(order)]


@pytest.mark.parametrize("width,share", [(4, (85, 100)), (5, (80, 100))])
def test_against_brute_force(make_docs, rows, width, share, monkeypatch):
    found = J.jaccard_groups(make_docs(rows), width, share).collect()
    want, groups = brute(rows, width, share)
    assert sorted((r.id, r.n_shingles, r.component_id) for r in found) == want
    assert sum(r.first for r in found) == groups


def test_null_ids_repeats_and_clashing_columns(spark, make_docs):
    text = words(50, 1)
    rows = [(None, text), (4, text + " end"), (4, text), (4, text), (None, "lone words"), (None, None)]
    docs = make_docs(rows).withColumn("row", F.lit("old")).withColumn("first", F.lit("old"))
    found = J.jaccard_groups(docs, 4, (85, 100)).collect()
    assert sorted(r.component_id for r in found if r.component_id is not None) == [4, 4, 4, 4]
    assert sum(r.first for r in found) == 3
    kept = J.jaccard_stage(spark, docs, "")
    assert kept.columns == docs.columns and kept.count() == 3
    assert J.jaccard_groups(make_docs([]), 4, (85, 100)).count() == 0


def test_completion_finds_what_contraction_misses(make_docs, rows, monkeypatch):
    """Without any link from the first rounds, the prefixes alone give all groups."""
    contract = J._contract
    monkeypatch.setattr(J, "_contract", lambda kept, share: contract(kept, share).where("false"))
    monkeypatch.setattr(J, "BLOCK", 16)
    found = J.jaccard_groups(make_docs(rows), 4, (85, 100)).collect()
    assert sorted((r.id, r.n_shingles, r.component_id) for r in found) == brute(rows, 4, (85, 100))[0]


def test_rtree_keeps_all_links():
    draw = np.random.default_rng(1)
    base = draw.integers(0, 1 << 62, 400).astype(np.uint64)
    sets = [np.unique(np.concatenate([draw.choice(base, draw.integers(1, 300)), draw.integers(0, 1 << 62, draw.integers(0, 40)).astype(np.uint64)])) for _ in range(150)]
    sets += [np.unique(np.concatenate([s[2:], s[:1]])) for s in sets]
    points, sizes = np.stack([count_vector(s) for s in sets]), np.array([len(s) for s in sets])
    found = set(zip(*(x.tolist() for x in CountRTree(points, sizes, (85, 100)).candidates(points, sizes))))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            both = len(np.intersect1d(a, b))
            if 100 * both >= 85 * (len(a) + len(b) - both):
                assert (i, j) in found
    assert len(found) < len(sets) ** 2 / 4


def test_components(spark):
    draw = random.Random(4)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1080)] + [(5, 5)]
    group = {}

    def top(i):
        while group.setdefault(i, i) != i:
            i = group[i]
        return i

    for a, b in links:
        if a != b:
            x, y = sorted((top(a), top(b)))
            group[y] = x
    found = components(spark.createDataFrame(links, "a long, b long"))
    assert {(r.node, r.component) for r in found.collect()} == {(i, top(i)) for i in list(group)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
