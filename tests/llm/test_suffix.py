import hashlib
import random
from collections import Counter

import pytest
from llm_data import words
from pyspark.sql import functions as F

from matchstream.llm import suffix_dedup as S
from matchstream.llm.bwt import repeated_windows


def brute(rows, length=200):
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(b[k : k + length] for b in data for k in range(len(b) - length + 1))
    out = []
    for (doc_id, _), b in zip(rows, data):
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((doc_id if doc_id is not None else -1, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_repeated_windows_against_counting():
    draw = random.Random(2)
    for trial in range(200):
        length = draw.choice([1, 2, 3, 5, 9])
        strings = ["".join(draw.choice("ab" if trial % 2 else "abcd") for _ in range(draw.randint(0, 40))).encode() for _ in range(draw.randint(1, 8))]
        seen = Counter(s[i : i + length] for s in strings for i in range(len(s) - length + 1))
        want = [[seen[s[i : i + length]] > 1 for i in range(len(s) - length + 1)] for s in strings]
        assert [x.tolist() for x in repeated_windows(strings, length)] == want
    assert repeated_windows([], 5) == []


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(7)
    passage, license = words(70, 500), words(33, 501)[:215]
    texts = [None, "", "short", "a" * 1000, "ab" * 700, "xyz" * 300 + "a" * 450, passage, passage, words(4000, 8), "é漢字" * 200]
    for i in range(60):
        body = words(draw.randint(5, 120), i)
        at = draw.randrange(len(body))
        texts.append(body[:at] + draw.choice([passage, passage[30:], license, license[:199], license[3:], ""]) + body[at:])
    texts += [texts[20], texts[20][:150] + "#" + texts[20][150:], words(4000, 8)[:9000]]
    return list(enumerate(texts))


@pytest.mark.parametrize("most", [1024, 2])
def test_against_brute_force(make_docs, rows, most, monkeypatch):
    """Also with all anchors dealt window by window, and long texts in pieces."""
    docs = make_docs(rows)
    monkeypatch.setattr(S, "MOST_SEGMENTS", most)
    found = S.remove_repeats(docs).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found) == brute(rows)
    for r in found:
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256
        assert sum(s.end - s.start for s in r.spans) == r.n_removed


def test_long_texts_in_pieces(monkeypatch):
    data = words(3000, 9).encode()
    whole = S.segments(data)
    monkeypatch.setattr(S, "PIECE_BYTES", 1000)
    parts = S.segments(data)
    covered = [x for first, n in zip(parts[0], parts[1]) for x in range(first, first + n)]
    assert covered == list(range(len(data) - 199)) and len(parts[0]) >= len(whole[0])


def test_null_ids_repeats_clashing_columns_empty(make_docs):
    text = words(60, 3)
    docs = make_docs([(None, text), (1, text), (1, text), (2, None)]).withColumn("kept", F.lit("old")).withColumn("n_bytes", F.lit("old"))
    found = S.remove_repeats(docs)
    assert set(found.columns) == {"doc_id", "lang", "source", "n_chars", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"}
    assert sorted((r.n_bytes, r.n_removed, r.n_spans) for r in found.collect()) == [(0, 0, 0)] + [(len(text), len(text), 1)] * 3
    assert S.remove_repeats(make_docs([])).count() == 0
