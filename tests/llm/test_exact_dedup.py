import hashlib
import os
import random
import re

from llm_data import words
from pyspark.sql import functions as F

from matchstream.llm import exact_dedup as X


def brute(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(i)
    out = set()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        for i in ids:
            out.add((i, min(known) if known else None, len(ids), hashlib.sha256(text.encode()).hexdigest()))
    return out, len(groups)


def test_trie_owns_smallest_and_spills():
    draw = random.Random(1)
    keys = [hashlib.sha256(str(draw.randrange(300)).encode()).digest()[:8] + bytes(draw.choice(b"ab") for _ in range(draw.randrange(9))) for _ in range(3000)]
    keys += [b"", b"x", b"xy", b"xyz"]
    want = {}
    for i, k in enumerate(keys):
        known = want.setdefault(k, [i, 0, []])
        known[0], known[1] = min(known[0], i), known[1] + 1
        known[2].append(i)
    for budget in (1 << 30, 5_000, 500):
        trie = X.PatriciaTrie(budget)
        for i, k in enumerate(keys):
            trie.insert(k, i, 1, [i])
        got = sorted((r, n, tuple(sorted(m))) for r, n, m in trie.owners())
        assert got == sorted((r, n, tuple(m)) for r, n, m in want.values())


def test_against_brute_force(make_docs):
    long = words(200_000, 3)
    rows = [(5, "a b"), (4, "a\t\n b"), (9, "a  b "), (7, None), (3, ""), (8, " "), (2, long), (1, long), (1, long), (None, "n"), (6, "n"), (None, "m"), (None, "m")]
    rows += [(100 + i, words(5, i % 7)) for i in range(400)]
    got = X.exact_dedup(make_docs(rows)).collect()
    want, groups = brute(rows)
    assert {(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got} == want
    assert len(got) == len(rows)
    assert sum(r.kept for r in got) == groups  # exactly one row of each group, repeated ids included
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_clashing_columns_and_empty(make_docs):
    docs = make_docs([(1, "x"), (2, "x")]).withColumn("kept", F.lit("old")).withColumn("group_size", F.lit("old"))
    got = X.exact_dedup(docs)
    assert sorted(got.columns) == sorted({*docs.columns, "keep_id", "group_size", "kept", "text_sha256"})
    assert {(r.doc_id, r.kept, r.group_size) for r in got.collect()} == {(1, True, 2), (2, False, 2)}
    assert X.exact_dedup(make_docs([])).count() == 0


def test_temporary_files_are_gone(tmp_path, monkeypatch):
    monkeypatch.setenv("TMPDIR", str(tmp_path))
    trie = X.PatriciaTrie(100)
    for i in range(200):
        trie.insert(bytes([i]) * 12, i, 1, [i])
    assert len(list(trie.owners())) == 200
    assert not os.listdir(tmp_path)


def test_long_common_prefixes_spill_behind_them():
    """Subtrees whose texts share a long prefix are spilled where they part, not byte by byte."""
    prefix = b"x" * 5000
    keys = [prefix + str(i).encode() for i in range(400)] + [prefix, b"y", prefix[:10]]
    trie = X.PatriciaTrie(3_000)
    for i, k in enumerate(keys * 3):
        trie.insert(k, i, 1, [i])
    assert sorted((r, n) for r, n, _ in trie.owners()) == [(i, 3) for i in range(len(keys))]


def test_many_copies_take_linear_time():
    import time

    def seconds(n):
        trie = X.PatriciaTrie()
        start = time.perf_counter()
        for i in range(n):
            trie.insert(b"one text", (False, i, i), 1, [i])
        assert [len(m) for _, _, m in trie.owners()] == [n]
        return time.perf_counter() - start

    seconds(1000)
    assert seconds(400_000) < 40 * seconds(40_000)


def test_reserved_looking_columns_come_back(make_docs):
    docs = make_docs([(1, "x"), (2, "x")]).withColumn("_row", F.lit("mine")).withColumn("_same_as", F.lit(7))
    got = X.exact_dedup(docs).collect()
    assert {(r.doc_id, r._row, r._same_as, r.keep_id) for r in got} == {(1, "mine", 7, 1), (2, "mine", 7, 1)}
