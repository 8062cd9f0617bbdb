"""Best-fit packing of documents into sequences by large-item matching.

Only the lengths of the pieces decide how they are packed, and there are at most
as many different lengths as a sequence has tokens.  So the plan is made from
the count of pieces of each length, which is bounded however large the corpus
is, and covers all pieces:

1. Pieces longer than a third of a sequence are large: at most two fit into one.
   They are matched greedily, the longest first, each with the longest that still
   fits, which matches as many as can be matched.
2. Smaller pieces go, the longest first, into the fullest sequence that has room
   for them; new sequences are opened where there is none.

Sequences with the same contents so far are one run of numbers, so that a step
of the plan places a whole class of pieces.  On Spark each piece gets its rank
among those of its length, and the plan tells from length and rank its sequence
and its place there.
"""

from __future__ import annotations

import os
import re
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType
from tokenizers import Tokenizer

from matchstream.llm.common import pieces as index_ranges
from matchstream.llm.common import prepare, stored, table, texts

#: Tokens of a sequence.
CAPACITY = 2048
#: Characters of text that are taken at once; longer texts are taken in parts.
CHUNK_CHARS = 1 << 20
#: Characters that the library encodes at once, and characters of words whose ids a worker keeps (twice).
LIBRARY_CHARS, KEPT_CHARS = 1 << 17, 8 << 20

#: The tokenizer's pattern ends a match wherever white space follows something else, so texts may be cut there,
#: and wherever signs follow letters.
_CUT = re.compile(r"(?<=\S)[ \n]")
_WORD = re.compile(r"\s*+(?:[A-Za-z\xC0-\xD6\xD8-\xF6\xF8-\xFF]++(?=[\s!-/:-@\[-`{-~])|\S++)|\s+")
#: White space to Python, but not to the tokenizer.
_UNSURE = re.compile(r"[\x1c-\x1f]")

TOKENS = StructType(
    [
        StructField("piece", IntegerType()),
        StructField("start", LongType()),
        StructField("length", LongType()),
        StructField("ids", BinaryType()),
    ]
)


class Plan:
    """Which sequence and place the pieces of each length get, by their rank among those of that length.

    ``counts`` has the number of pieces of each length, 1 to ``capacity``.  The
    size of a plan depends on ``capacity`` alone: matching makes at most two runs
    for each length, each smaller length splits at most one run, and a
    sequence holds fewer than ``sqrt(2 * capacity)`` different lengths.
    """

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY) -> None:
        self.capacity = capacity
        self.sequences = 0
        #: For each length: first rank, pieces in each sequence, first sequence, place of the first piece.
        self.steps: dict[int, list[tuple[int, int, int, int]]] = {}
        self._placed: dict[int, int] = {}
        #: Runs of sequences by the room that is left: first sequence and number of sequences.
        self._runs: dict[int, list[tuple[int, int]]] = {}
        self._rooms: list[int] = []
        left = {n: c for n, c in counts.items() if c > 0 and 1 <= n <= capacity}
        large = [n for n in sorted(left) if 3 * n > capacity]
        small = [n for n in sorted(left, reverse=True) if 3 * n <= capacity]
        self._match(large, left)
        for n in small:
            self._best_fit(n, left[n])

    def _open(self, sequences: int) -> int:
        first = self.sequences
        self.sequences += sequences
        return first

    def _put(self, n: int, pieces: int, each: int, first: int, at: int) -> None:
        """The next ``pieces`` pieces of length ``n`` go to sequences from ``first`` on, ``each`` to one, from place ``at``."""
        rank = self._placed.get(n, 0)
        self.steps.setdefault(n, []).append((rank, each, first, at))
        self._placed[n] = rank + pieces

    def _leave(self, room: int, first: int, sequences: int) -> None:
        """These sequences have so much room left."""
        if not room or not sequences:
            return
        if room not in self._runs:
            self._runs[room] = []
            insort(self._rooms, room)
        self._runs[room].append((first, sequences))

    def _take(self, room: int) -> tuple[int, int]:
        run = self._runs[room].pop()
        if not self._runs[room]:
            del self._runs[room]
            self._rooms.pop(bisect_left(self._rooms, room))
        return run

    def _match(self, large: list[int], left: dict[int, int]) -> None:
        """Pair large pieces: the longest first, each with the longest that fits."""
        while large:
            n = large[-1]
            mate = bisect_left(large, self.capacity - n + 1) - 1
            if mate < 0:  # none fits
                large.pop()
                first = self._open(left[n])
                self._put(n, left[n], 1, first, 0)
                self._leave(self.capacity - n, first, left[n])
                continue
            m = large[mate]
            if m == n:  # pairs of equals; the odd one waits for a shorter mate
                pairs = left[n] // 2
                if pairs:
                    first = self._open(pairs)
                    self._put(n, 2 * pairs, 2, first, 0)
                    self._leave(self.capacity - 2 * n, first, pairs)
                left[n] -= 2 * pairs
                if left[n] and mate == 0:
                    first = self._open(1)
                    self._put(n, 1, 1, first, 0)
                    self._leave(self.capacity - n, first, 1)
                    left[n] = 0
                if left[n]:
                    self._pair(n, large[mate - 1], 1, left)
                large[:] = [x for x in large if left[x]]
                continue
            self._pair(n, m, min(left[n], left[m]), left)
            if not left[n]:
                large.pop()
            if not left[m]:
                large.pop(mate)

    def _pair(self, n: int, m: int, pairs: int, left: dict[int, int]) -> None:
        first = self._open(pairs)
        self._put(n, pairs, 1, first, 0)
        self._put(m, pairs, 1, first, n)
        self._leave(self.capacity - n - m, first, pairs)
        left[n] -= pairs
        left[m] -= pairs

    def _best_fit(self, n: int, count: int) -> None:
        """Place ``count`` pieces, each into the fullest sequence with room for it."""
        while count:
            at = bisect_left(self._rooms, n)
            if at < len(self._rooms):
                room = self._rooms[at]
                first, sequences = self._take(room)
            else:
                room = self.capacity
                sequences = -(-count // (room // n))
                first = self._open(sequences)
            each = room // n
            full = min(sequences, count // each)
            if full:
                self._put(n, full * each, each, first, self.capacity - room)
                self._leave(room - each * n, first, full)
                count -= full * each
            rest = sequences - full
            if rest and count:  # the last sequence that is needed holds fewer
                self._put(n, count, count, first + full, self.capacity - room)
                self._leave(room - count * n, first + full, 1)
                full, rest, count = full + 1, rest - 1, 0
            self._leave(room, first + full, rest)

    def arrays(self) -> tuple[np.ndarray, ...]:
        """The steps, ordered by length and rank: length, first rank, pieces in each, first sequence, place."""
        rows = [(n, *step) for n in sorted(self.steps) for step in self.steps[n]]
        return tuple(np.array(c, np.int64) for c in zip(*rows)) if rows else (np.zeros(0, np.int64),) * 5


def _parts(text: str, most: int = CHUNK_CHARS) -> list[str]:
    """``text`` in parts that are encoded alike apart and together."""
    out, at = [], 0
    while len(text) - at > most:
        cut = _CUT.search(text, at + most)
        if cut is None:
            break
        out.append(text[at : cut.start()])
        at = cut.start()
    return [*out, text[at:]]


class Encoder:
    """A tokenizer that is asked for each word once: white space and the letters, or else what follows up to the next.

    The ids of a text are those of its words in a row.  New words are encoded
    together and their ids told apart by the bytes of the tokens.  The ids of words
    are kept in two generations of ``KEPT_CHARS`` characters, so that frequent
    words stay.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True  # their strings in a text are ordinary text
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0
        vocabulary = self.tok.get_vocab()
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.bytes_of[i] = len(token)  # a token is written with a character for each byte

    def _learn(self, words: set[str]) -> None:
        self.held += sum(map(len, words)) + 8 * len(words)
        again = words & self.older.keys()
        self.known.update((w, self.older[w]) for w in again)
        words -= again
        # Words can stand in a row if each starts with white space and ends with something else.
        rows = [w for w in words if w[0] in " \n\t" and not w[-1].isspace()]
        for i, j in index_ranges([len(w) for w in rows], LIBRARY_CHARS):
            made = self.tok.encode_batch_fast(["".join(rows[i:j])], add_special_tokens=False)[0]
            ids = np.array(made.ids, "<u4")
            ends = np.cumsum([len(w.encode()) for w in rows[i:j]])
            stops = (4 * (np.searchsorted(np.cumsum(self.bytes_of[ids]), ends) + 1)).tolist()
            data = ids.tobytes()
            self.known.update((w, data[a:b]) for w, a, b in zip(rows[i:j], [0, *stops], stops))
        others = list(words.difference(rows))
        for i, j in index_ranges([len(w) for w in others], LIBRARY_CHARS):
            for word, made in zip(others[i:j], self.tok.encode_batch_fast(others[i:j], add_special_tokens=False)):
                self.known[word] = np.array(made.ids, "<u4").tobytes()

    def encode(self, bodies: list[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        parts = [_parts(x) for x in bodies]
        flat = [p for some in parts for p in some]
        owners = [k for k, some in enumerate(parts) for _ in some]
        held: list[bytes] = []
        for i, j in index_ranges([len(p) for p in flat], CHUNK_CHARS):
            if self.held > KEPT_CHARS:
                self.older, self.known, self.held = self.known, {}, 0
            words = [[p] if _UNSURE.search(p) else _WORD.findall(p) for p in flat[i:j]]
            self._learn(set().union(*words).difference(self.known))
            for k, own in zip(range(i, j), words):
                held.append(b"".join(map(self.known.__getitem__, own)))
                if k + 1 == len(flat) or owners[k + 1] != owners[k]:
                    yield b"".join(held)
                    held = []


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """The encoder of a local file, which a worker keeps from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def tokenized(
    docs: DataFrame, tokenizer_path: str, text: str = "text", capacity: int = CAPACITY, end: int = 0
) -> DataFrame:
    """The pieces of all documents: the columns of ``docs`` without its text, with ``piece``, ``start``, ``length`` and ``ids``.

    A document is the ids of its text, then ``end``; a null text counts as empty
    and gives ``end`` alone.  Documents of more than ``capacity`` tokens are cut
    into pieces of ``capacity``, of which the first may be shorter.  ``ids`` are
    little-endian unsigned 32-bit integers.  Rows that repeat are all kept.  Columns of ``docs``
    that have one of the new names are replaced.
    """
    spark = docs.sparkSession
    prepare(spark)
    spark.sparkContext.addFile(tokenizer_path)
    name = os.path.basename(tokenizer_path)
    kept = [f for f in docs.schema.fields if f.name != text and f.name.lower() not in TOKENS.names]
    others = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(SparkFiles.get(name))
        last = np.array([end], "<u4").tobytes()
        for b in batches:
            rows, numbers, starts, lengths, blobs = [], [], [], [], []
            for row, ids in enumerate(encoder.encode(texts(b.column(len(others))))):
                ids += last
                n = len(ids) // 4
                cuts = range((n - 1) % capacity + 1, n + 1, capacity)
                for piece, stop in enumerate(cuts):
                    start = max(0, stop - capacity) if piece else 0
                    rows.append(row)
                    numbers.append(piece)
                    starts.append(start)
                    lengths.append(stop - start)
                    blobs.append(ids[4 * start : 4 * stop])
            own = b.select(range(len(others))).take(pa.array(rows, pa.int64())) if others else None
            new = [pa.array(numbers, pa.int32()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(blobs, pa.binary())]
            yield pa.RecordBatch.from_arrays([*(own.columns if others else []), *new], names=[*others, *TOKENS.names])

    lean = docs.select(*others, F.col(text))  # the text is read by its place
    return lean.mapInArrow(run, StructType(kept + TOKENS.fields))


def _ranked(pieces: DataFrame, length: str, capacity: int) -> DataFrame:
    """``pieces`` with the number of its task, its length (0 if it can't be packed) and its rank, in that task, among those of that length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(capacity + 1, np.int64)
        part = TaskContext.get().partitionId()
        for b in batches:
            own = np.array(b.column(length).cast(pa.int64()).fill_null(0))
            own[(own < 1) | (own > capacity)] = 0
            order = np.argsort(own, kind="stable")
            in_order = own[order]
            new = np.empty(len(own), np.int64)
            new[order] = np.arange(len(own)) - np.searchsorted(in_order, in_order) + seen[in_order]
            seen += np.bincount(own, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.full(len(own), part, np.int64)), pa.array(own), pa.array(new)],
                names=[*b.schema.names, *names],
            )

    names = ["_part", "_length", "_nth"]
    return pieces.mapInArrow(run, StructType([*pieces.schema.fields, *(StructField(n, LongType()) for n in names)]))


def pack(pieces: DataFrame, length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``, packed into few sequences of at most ``capacity``.

    Any table with a column of lengths can be packed.  Pieces whose length is
    null or not 1 to ``capacity`` can't be: they come back with nulls.  Pieces of one length
    are interchangeable: which of them goes where follows the order in which they
    are read; repeated rows are pieces of their own.  The offsets of a sequence
    are gapless from 0, and sequences are numbered from 0 without gaps.  Columns
    named ``sequence_id`` or ``offset`` are replaced; ``_part``, ``_length`` and
    ``_nth`` are reserved.

    The pieces are written once with their ranks.  The driver gets a count for
    each length, and sends back the plan, whose size depends on ``capacity``
    alone.
    """
    spark = pieces.sparkSession
    prepare(spark)
    kept = [f for f in pieces.schema.fields if f.name.lower() not in ("sequence_id", "offset")]
    others = [f.name for f in kept]
    ranked = stored(_ranked(pieces.select(*others), length, capacity), "pieces")
    in_parts = stored(ranked.groupBy("_part", "_length").agg(F.count("*").alias("_n")), "piece-counts")
    counts = in_parts.groupBy("_length").agg(F.sum("_n").alias("n")).collect()  # at most capacity + 1 rows
    plan = Plan({r["_length"]: r["n"] for r in counts}, capacity)
    steps = spark.sparkContext.broadcast(plan.arrays())
    earlier = Window.partitionBy("_length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = in_parts.select("_part", "_length", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    joined = ranked.join(before, ["_part", "_length"]).select(*others, "_length", F.col("_before") + F.col("_nth"))
    schema = StructType([*kept, StructField("sequence_id", LongType()), StructField("offset", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, ranks, each, first, at = steps.value
        for b in batches:
            n, rank = np.array(b.columns[-2]), np.array(b.columns[-1])
            places = [np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)]
            if len(lengths):
                step = np.searchsorted(_key(lengths, ranks), _key(n, rank), side="right") - 1
                nth = rank - ranks[step]
                places = [first[step] + nth // each[step], at[step] + nth % each[step] * n]
            new = [pa.array(p, mask=n == 0) for p in places]
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], *new], names=schema.names)

    return joined.mapInArrow(run, schema)


def _key(lengths: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Length and rank as one sortable number; a rank fits into 44 bits."""
    return (lengths.astype(np.int64) << 44) + ranks


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids, lengths``: the token ids of each sequence and the lengths of its pieces, in order.

    A sequence is at most ``capacity`` tokens, so a group is bounded.
    """
    one = F.sort_array(F.collect_list(F.struct("offset", "length", "ids")))
    grouped = packed.groupBy("sequence_id").agg(one.alias("_pieces"))
    return grouped.select(
        "sequence_id",
        F.aggregate("_pieces.ids", F.lit(b""), lambda a, x: F.concat(a, x)).alias("ids"),
        F.col("_pieces.length").alias("lengths"),
    )


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each piece of every document is packed."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = tokenized(docs, public_tokenizers.path("byte_bpe_50k.json"))
    lean = made.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack(lean)
