"""Benchmark decontamination by q-gram lemma filtering.

Texts and benchmark items are reduced to their words, lower case, one space
between.  Items are cut into overlapping pieces.  A region of a document that
holds a piece of n characters with at most k edits shares at least
n + 1 - q * (k + 1) of its q-grams, all of them within k + 1 neighbouring
diagonals (position in the document less position in the piece).  So the q-grams
of each document are looked up, hits are counted in overlapping bands of
diagonals, regions with enough are retained and verified by banded alignment.

The benchmark is the query set.  It is broadcast in blocks of bounded size, and
the documents are read once for each block; nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from matchstream.llm.common import aside, mixed, pieces, prepare, spread, table, texts

#: Characters of a q-gram, of a piece, and from one piece of an item to the next.
Q, PIECE, STEP = 12, 120, 60
#: One edit is allowed for so many characters of a piece, fewer where the
#: lemma would leave less than LEAST shared q-grams.
CHARS_PER_EDIT, LEAST = 18, 6
#: Items with fewer characters are found where their words stand exactly, in a row and whole.
SHORTEST = 30
#: Bytes of benchmark text in one broadcast block.
BLOCK_BYTES = 4 << 20
#: Characters of documents handled at once, and alignments at once.
CHUNK_CHARS, ALIGNED = 1 << 20, 4096

_WORD = re.compile(r"\w+")
_LEAK = StructType([StructField(n, LongType()) for n in ("item_id", "start", "end", "edits")])
_BITS = 22

_BASE = 0xD1342543DE82EF95
_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def _order(item_id: int | None) -> tuple:
    """Items by id, one without last."""
    return (item_id is None, item_id or 0)


def words_only(text: str) -> str:
    """The words of a text in lower case, one space between."""
    return " ".join(_WORD.findall(text.lower()))


def _codes(s: str) -> np.ndarray:
    return np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0][0]) < n:
        both = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(max(n, CHUNK_CHARS + (1 << 17)), base, np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps))
        _POWERS[:] = [(both[0], both[1])]
    return _POWERS[0][0][:n], _POWERS[0][1][:n]


def gram_hashes(codes: np.ndarray) -> np.ndarray:
    """A hash of the q-gram that starts at each position."""
    if len(codes) < Q:
        return np.zeros(0, np.uint64)
    powers, inverse = _powers(len(codes))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((codes + np.uint64(0x9E37)) * powers)])
    return mixed((sums[Q:] - sums[:-Q]) * inverse[: len(codes) - Q + 1])


def edit_budget(n: int) -> int:
    """The edits allowed in a piece of n characters."""
    return max(0, min(n // CHARS_PER_EDIT, (n + 1 - LEAST) // Q - 1))


class Probes:
    """The pieces of one block of items and the index of their q-grams; short items as an automaton of words."""

    def __init__(self, items: list[tuple[int | None, str]]) -> None:
        cut: dict[tuple[int | None, str], None] = {}
        short: dict[str, set] = {}
        for item_id, text in items:
            text = words_only(text or "")
            if len(text) >= SHORTEST:
                last = max(0, len(text) - PIECE)
                for at in sorted({*range(0, last, STEP), last}):
                    cut[item_id, text[at : at + PIECE]] = None
            elif text:
                short.setdefault(text, set()).add(item_id)
        self.short = None
        if short:
            self.short = ahocorasick.Automaton()
            for text, ids in short.items():
                self.short.add_word(f" {text} ", (len(text), sorted(ids, key=_order)))
            self.short.make_automaton()
        self.item = [i for i, _ in cut]
        self.codes = [_codes(t) for _, t in cut]
        self.length = np.array([len(c) for c in self.codes], np.int64)
        self.budget = np.array([edit_budget(len(c)) for c in self.codes], np.int64)
        self.enough = self.length + 1 - Q * (self.budget + 1)
        hashes = [gram_hashes(c) for c in self.codes]
        every = np.concatenate([np.zeros(0, np.uint64), *hashes])
        order = np.argsort(every, kind="stable")
        self.grams, self.first, self.count = np.unique(every[order], return_index=True, return_counts=True)
        self.piece = np.repeat(np.arange(len(cut)), [len(h) for h in hashes])[order]
        self.offset = np.concatenate([np.zeros(0, np.int64), *[np.arange(len(h)) for h in hashes]])[order]
        self.seen = np.zeros(1 << _BITS, bool)
        self.seen[(self.grams >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def hits(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions whose q-gram some piece holds, in places dense enough for a match, and the q-gram's index."""
        hashes = gram_hashes(codes)
        at = np.flatnonzero(self.seen[(hashes >> np.uint64(64 - _BITS)).astype(np.int64)])
        gram = np.searchsorted(self.grams, hashes[at])
        same = self.grams[np.minimum(gram, len(self.grams) - 1)] == hashes[at]
        at, gram = at[same], gram[same]
        # A match spans at most the longest piece and its budget.
        span, enough = int((self.length + self.budget).max()), int(self.enough.min())
        last = np.searchsorted(at, at + span)
        dense = np.flatnonzero(last - np.arange(len(at)) >= enough)
        inside = np.zeros(len(at) + 1, np.int64)
        np.add.at(inside, dense, 1)
        np.add.at(inside, last[dense], -1)
        keep = np.cumsum(inside[:-1]) > 0
        return at[keep], gram[keep]

    def regions(self, codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(piece, text, first diagonal) of the bands that share enough q-grams with a piece."""
        at, gram = self.hits(codes)
        n = self.count[gram]
        entry = spread(self.first[gram], n)
        at = np.repeat(at, n)
        piece, offset = self.piece[entry], self.offset[entry]
        text = np.searchsorted(ends, at, side="right")
        wide = self.budget[piece] + 1
        # Bands of two widths, one width apart, so that each window of one width is within one.
        band = (at - offset + PIECE) // wide
        piece, text, offset = (np.concatenate([x, x]) for x in (piece, text, offset))
        band = np.concatenate([band, band - 1])
        order = np.lexsort((offset, band, text, piece))
        piece, text, band, offset = (x[order] for x in (piece, text, band, offset))
        new = np.ones(len(piece), bool)
        new[1:] = (piece[1:] != piece[:-1]) | (text[1:] != text[:-1]) | (band[1:] != band[:-1])
        distinct = new.copy()
        distinct[1:] |= offset[1:] != offset[:-1]
        starts = np.flatnonzero(new)
        shared = np.add.reduceat(distinct.astype(np.int64), starts) if len(starts) else starts
        keep = starts[shared >= self.enough[piece[starts]]] if len(starts) else starts
        return piece[keep], text[keep], band[keep] * (self.budget[piece[keep]] + 1) - PIECE

    def aligned(self, codes: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item, start, end, edits) of the regions that hold a piece within its budget."""
        piece, text, diagonal = self.regions(codes, ends)
        for p in np.unique(piece):
            own = np.flatnonzero(piece == p)
            for i in range(0, len(own), ALIGNED):
                some = own[i : i + ALIGNED]
                yield from self._align(int(p), text[some], diagonal[some], codes, ends)

    def _align(self, p: int, text: np.ndarray, diagonal: np.ndarray, codes: np.ndarray, ends: np.ndarray) -> Iterator[tuple]:
        """Edit distance of a piece to a region, free at both ends of the region, within the band.

        A cell is a piece position and a diagonal of the band; both the start
        and the path may lie a budget beside the hits.
        """
        n, k = int(self.length[p]), int(self.budget[p])
        low = diagonal - k
        begin = np.where(text > 0, ends[text - 1] + 1, 0)
        width = 4 * k + 3
        column = low[:, None] + np.arange(width)[None, :]
        limit = ends[text][:, None]
        steps = np.arange(width)
        # Starting before the text would skip nothing: such cells are closed.
        cost = np.where((column >= begin[:, None]) & (column <= limit), 0, n + 1)
        for i, code in enumerate(self.codes[p].tolist()):
            here = column + i
            inside = (here >= begin[:, None]) & (here < limit)
            differs = np.where(inside, codes[np.clip(here, 0, len(codes) - 1)] != code, n + 1)
            skip_piece = np.concatenate([cost[:, 1:], np.full((len(cost), 1), n + 1)], axis=1) + 1
            cost = np.minimum(cost + differs, skip_piece)
            cost = np.minimum.accumulate(cost - steps, axis=1) + steps
        best = cost.argmin(axis=1)
        edits = cost[np.arange(len(cost)), best]
        for j in np.flatnonzero(edits <= k).tolist():
            end = int(low[j] + n + best[j] - begin[j])
            yield int(text[j]), self.item[p], max(0, end - n), end, int(edits[j])

    def _exact(self, row: str) -> Iterator[dict]:
        """The short items whose words a text holds, each at its first place."""
        seen = set()
        for last, (n, ids) in self.short.iter(f" {row} "):
            for item in ids:
                if item not in seen:
                    seen.add(item)
                    # One space stands before the text, and the match starts with one.
                    yield {"item_id": item, "start": last - n - 1, "end": last - 1, "edits": 0}

    def search(self, rows: list[str]) -> list[list[dict]]:
        """For each text the items found in it, each at its best place."""
        out: list[list[dict]] = [[] for _ in rows]
        reduced = [words_only(r) for r in rows]
        if self.short is not None:
            for found, row in zip(out, reduced):
                found += self._exact(row)
        if not len(self.grams):
            return out
        for a, b in pieces([len(r) for r in reduced], CHUNK_CHARS):
            joined = _codes("\n".join([*reduced[a:b], ""]))
            ends = np.cumsum([len(r) + 1 for r in reduced[a:b]]) - 1
            best: dict[tuple[int, int], tuple] = {}
            for text, item, start, end, edits in self.aligned(joined, ends):
                best[text, item] = min(best.get((text, item), (1 << 60,)), (edits, start, end))
            for (text, item), (edits, start, end) in sorted(best.items(), key=lambda x: (x[0][0], _order(x[0][1]))):
                out[a + text].append({"item_id": item, "start": start, "end": end, "edits": edits})
        return out


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int | None, str]]]:
    """The items in blocks of about ``BLOCK_BYTES``; one block is on the driver at a time."""
    items = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("text != ''")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-total // BLOCK_BYTES))
    for k in range(count):
        rows = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(count)) == k).collect()
        yield [(r["id"], r["text"]) for r in rows]


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` with ``leaks``: the items found in each text, as (item_id, start, end, edits).

    ``start`` and ``end`` count characters of the text's words joined by single
    spaces, in lower case.  A null or empty text has no leaks, nor has any text
    if the benchmark is empty.  Items with fewer than ``SHORTEST`` characters of words
    are found where all their words stand in a row, without an edit; items without a
    word are nowhere.  Items that repeat are found once for each id, and those without
    one together, as id null.  A column ``leaks`` that ``docs`` has already is replaced.
    """
    spark = docs.sparkSession
    prepare(spark)
    out = docs.drop("leaks").withColumn("leaks", F.expr("array()").cast(ArrayType(_LEAK)))
    for items in _blocks(benchmark, item_id, item_text):
        out = _search_block(out, spark.sparkContext.broadcast(items), text)
    return out


def _search_block(docs: DataFrame, items, text: str) -> DataFrame:
    kind = pa.list_(pa.struct([(f.name, pa.int64()) for f in _LEAK.fields]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probes = Probes(items.value)
        for b in batches:
            found = probes.search(texts(b.column(text)))
            before = b.column("leaks").to_pylist()
            leaks = pa.array([[*x, *y] for x, y in zip(before, found, strict=True)], kind)
            others = [b.column(i) for i in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*others, leaks], names=b.schema.names)

    return docs.mapInArrow(run, docs.schema)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document and benchmark item that it holds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a benchmark item go, whether or not the item has an id.

    Documents without text stay, repeated rows go or stay alike.  The input's
    columns come back as they are, whatever their names; an empty table stays empty.
    """
    inner, back = aside(docs, "text")
    return find_leaks(inner, table(spark, sf_dir, "benchmark")).where(F.size("leaks") == 0).select(*back)
