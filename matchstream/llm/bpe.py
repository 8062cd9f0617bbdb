"""Byte-level BPE encoding and decoding.

A text is split by the tokenizer's pattern, vectorised over the code points of a
batch.  Each distinct piece is encoded once: its bytes are mapped to Latin-1, the
trie of an Aho-Corasick automaton gives the longest vocabulary entry that starts
at a byte, and a backtracking search joins entries whose neighbours are compatible,
that is, which the merges themselves would leave side by side.  Compatibility of
two neighbours is memoised, and a position that can't be reached is never tried
again, so the search is linear; its result is that of merging by rank.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from matchstream.llm.common import mixed, pieces, prepare, spread, table, texts

#: Characters split and encoded at once, and encoded pieces kept by a worker.
CHUNK_CHARS = 1 << 20
CACHE_PIECES = 250_000
MEMO_PAIRS = 1_000_000

# Classes of code points; END separates texts and ends white space like the end.
_OTHER, _LETTER, _NUMBER, _SPACE, _END = range(5)


_NEVER = 1 << 40


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Vocabulary:
    """Token bytes by rank and the encoder of single pieces."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.most = max(map(len, ranks))
        self.on_path: dict[str, int | None] = {}
        self.edges: dict[int, dict[int, list[tuple[bytes, int, int]]]] = {0: {}, -1: {}}
        self.shorter: dict[int, int | None] = {}
        self.compatible: dict[int, bool] = {}
        self.sizes = [len(t) for t in self.bytes_of]
        self.encoded: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.lengths = np.array(self.sizes, np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def merged(self, data: bytes, below: int = _NEVER) -> list[bytes]:
        """``data`` merged step by step, always the leftmost pair of lowest rank, for ranks under ``below``."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, _NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank >= below:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _edge(self, token: int, side: int) -> list[tuple[bytes, int, int]]:
        """The parts of a token that lie at one of its ends while it is merged.

        For each the bytes, the rank at which it comes to be (-1: a byte) and
        the rank at which it is merged within the token.
        """
        known = self.edges[side].get(token)
        if known is None:
            known, part, ends = [], self.bytes_of[token], _NEVER
            while True:
                rank = self.ranks[part] if len(part) > 1 else -1
                known.append((part, rank, ends))
                if len(part) == 1:
                    break
                halves = self.merged(part, rank)
                part, ends = halves[side], rank
            self.edges[side][token] = known
        return known

    def _fits(self, pair: int) -> bool:
        """Whether merging leaves the two tokens of ``left << 32 | right`` side by side.

        They part if two of their edges are neighbours at some time and merge
        with each other before either merges inside its own token; of equal
        ranks the leftmost merge comes first.
        """
        if len(self.compatible) >= MEMO_PAIRS:
            self.compatible.clear()
        get = self.ranks.get
        right = self._edge(pair & 0xFFFFFFFF, 0)
        known = True
        for x, x_from, x_until in self._edge(pair >> 32, -1):
            for y, y_from, y_until in right:
                rank = get(x + y)
                if rank is not None and rank < x_until and rank <= y_until and x_from <= y_until and y_from < x_until:
                    known = False
        self.compatible[pair] = known
        return known

    def _longest(self, path: str) -> int | None:
        """The longest token that is a prefix of a path of the automaton."""
        data = path.encode("latin-1")
        found = (self.ranks.get(data[:n]) for n in range(len(data), 0, -1))
        known = self.on_path[path] = next((r for r in found if r is not None), None)
        return known

    def _prefix(self, token: int) -> int | None:
        """The longest token that is a proper prefix of ``token``."""
        if token not in self.shorter:
            data = self.bytes_of[token]
            found = (self.ranks.get(data[:n]) for n in range(len(data) - 1, 0, -1))
            self.shorter[token] = next((r for r in found if r is not None), None)
        return self.shorter[token]

    def encode_piece(self, data: bytes) -> list[int]:
        """The token ids of one piece of the pattern."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        n = len(data)
        text = data.decode("latin-1")
        reach, on_path = self.automaton.longest_prefix, self.on_path
        compatible, sizes, shorter = self.compatible, self.sizes, self.shorter
        dead: set[int] = set()
        out: list[int] = []
        at, token, before = 0, -1, None
        while at < n:
            if token == -1:  # the longest token from here
                ahead = text[at : at + self.most]
                path = ahead[: reach(ahead)]
                token = on_path[path] if path in on_path else self._longest(path)
            if token is None:  # nothing fits here: the token before must be shorter
                if not out:
                    raise ValueError("the vocabulary lacks single bytes")
                dead.add(at)
                token = out.pop()
                at -= sizes[token]
                before = out[-1] if out else None
            else:
                end = at + sizes[token]
                if end not in dead:
                    if before is None:
                        fits = True
                    else:
                        pair = before << 32 | token
                        fits = compatible.get(pair)
                        if fits is None:
                            fits = self._fits(pair)
                    if fits:
                        out.append(token)
                        at, before, token = end, token, -1
                        continue
            token = shorter[token] if token in shorter else self._prefix(token)
        return out

    def encode_str(self, piece: str) -> bytes:
        """Token ids of a piece as little-endian 32-bit integers, cached.

        The cache has two generations, so that frequent pieces survive.
        """
        known = self.encoded.get(piece)
        if known is None:
            if len(self.encoded) >= CACHE_PIECES:
                self.older, self.encoded = self.encoded, {}
            known = self.older.get(piece)
            if known is None:
                known = _packed(self.encode_piece(piece.encode("utf-8", "surrogatepass")))
            self.encoded[piece] = known
        return known

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of a sequence of token ids."""
        return self.flat[spread(self.starts[ids], self.lengths[ids])].tobytes()


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """Ranks from the lines of a rank file: token in base64, rank."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines.splitlines() if line.strip())}


_VOCABULARIES: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary in a local rank file, loaded once by a worker."""
    if path not in _VOCABULARIES:
        with open(path, "rb") as f:
            _VOCABULARIES[path] = Vocabulary(read_ranks(f.read()))
    return _VOCABULARIES[path]


_CLASSES: list[np.ndarray] = []


def _classes() -> np.ndarray:
    """The class of each code point, by the pattern's own character classes."""
    if not _CLASSES:
        every = "".join(map(chr, range(0x110000)))
        table = np.zeros(0x110000, np.uint8)
        for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+")):
            for m in regex.finditer(pattern, every):
                table[m.start() : m.end()] = kind
        _CLASSES.append(table)
    return _CLASSES[0]


def _codes(s: str) -> np.ndarray:
    return np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32)


def piece_starts(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where the pieces of the pattern start, in texts that stand in a row.

    ``codes`` holds the texts with one further code point after each, at the
    positions ``ends``; these become pieces of their own.  The pattern is that of
    the rank file's tokenizer: contractions, an optional space before a run of
    letters, numbers or other signs, and white space that leaves its last
    character to what follows.
    """
    n = len(codes)
    kind = _classes()[codes]
    kind[ends] = _END
    start = np.empty(n + 1, bool)
    start[0] = start[n] = True
    np.not_equal(kind[1:], kind[:-1], out=start[1:n])
    start[ends] = start[ends + 1] = True  # also between adjacent ends
    # White space before something else leaves its last character; a space joins what follows.
    last = np.flatnonzero((kind[:-1] == _SPACE) & (kind[1:] < _SPACE))
    start[last] = True
    joining = last[codes[last] == 0x20]
    start[joining + 1] = False
    # Contractions: a lone apostrophe that starts a piece, and letters after it.
    quote = np.flatnonzero((codes[:-1] == 0x27) & start[: n - 1] & (kind[1:] == _LETTER))
    if len(quote):
        padded = np.concatenate([codes, np.zeros(2, np.uint32)])
        one, two = padded[quote + 1], padded[quote + 2]
        is_two = ((one == 0x72) & (two == 0x65)) | ((one == 0x76) & (two == 0x65)) | ((one == 0x6C) & (two == 0x6C))
        is_one = np.isin(one, (0x73, 0x74, 0x6D, 0x64))
        start[quote[is_one | is_two] + 1] = False
        start[quote[is_one] + 2] = True
        start[quote[is_two] + 3] = True
    return np.flatnonzero(start[:n])


_FACTOR = 0x9E3779B97F4A7C15 | 1
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64)]


def _powers(n: int) -> np.ndarray:
    if len(_POWERS[0]) < n:
        steps = np.full(max(n, CHUNK_CHARS + 4096), _FACTOR, np.uint64)
        steps[0] = 1
        _POWERS[0] = np.cumprod(steps)
    return _POWERS[0][:n]


def _fingerprints(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each piece, equal for equal pieces."""
    weighted = mixed(codes.astype(np.uint64) + np.uint64(1))
    # The position within its piece weights each code point.
    within = np.arange(len(codes)) - np.repeat(starts, lengths)
    longest = int(lengths.max())
    return mixed(np.add.reduceat(weighted * _powers(longest)[within], starts) + lengths.astype(np.uint64))


def encode_texts(vocab: Vocabulary, rows: list[str]) -> list[np.ndarray]:
    """Token ids of each text."""
    if not rows:
        return []
    joined = "\0".join(rows) + "\0"
    codes = _codes(joined)
    ends = np.cumsum([len(r) + 1 for r in rows]) - 1
    starts = piece_starts(codes, ends)
    lengths = np.diff(np.append(starts, len(codes)))
    hashes = _fingerprints(codes, starts, lengths)
    is_end = np.zeros(len(codes), bool)
    is_end[ends] = True
    hashes[is_end[starts]] = 0
    distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    encode = vocab.encode_str
    ids_of = [b"" if h == 0 else encode(joined[s : s + n]) for h, s, n in zip(distinct.tolist(), starts[first].tolist(), lengths[first].tolist())]
    counts = np.array([len(b) // 4 for b in ids_of], np.int64)
    flat = np.frombuffer(b"".join(ids_of), "<u4")
    offsets = np.cumsum(counts) - counts
    tokens = counts[which]
    ids = flat[spread(offsets[which], tokens)]
    after = np.concatenate([[0], np.cumsum(tokens)])
    bounds = after[np.searchsorted(starts, ends, side="right")]
    return np.split(ids, bounds[:-1])


def _cut(text: str, most: int) -> list[str]:
    """A long text cut where a piece surely starts: before a space between two letters."""
    out = []
    while len(text) > most:
        m = _SAFE.search(text, most)
        if not m:
            break
        out.append(text[: m.start() + 1])
        text = text[m.start() + 1 :]
    return [*out, text]


_SAFE = regex.compile(r"\p{L} (?=\p{L})")


def encode_all(vocab: Vocabulary, rows: list[str]) -> Iterator[np.ndarray]:
    """Token ids of each text, at most ``CHUNK_CHARS`` characters at a time where they can be cut."""
    for a, b in pieces([len(r) for r in rows], CHUNK_CHARS):
        if b == a + 1:
            parts = _cut(rows[a], CHUNK_CHARS)
            found = [ids for part in parts for ids in encode_texts(vocab, [part])]
            yield np.concatenate(found)
        else:
            yield from encode_texts(vocab, rows[a:b])


_NEW = StructType(
    [
        StructField("token_ids", ArrayType(IntegerType())),
        StructField("n_tokens", LongType()),
        StructField("ids_sha256", StringType()),
        StructField("decoded_sha256", StringType()),
    ]
)


def byte_bpe(docs: DataFrame, vocabulary_path: str, text: str = "text", with_ids: bool = True) -> DataFrame:
    """``docs`` with ``token_ids``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``.

    ``vocabulary_path`` is a rank file; it is shipped to the executors.  A null
    text counts as empty and has no tokens.  The ids are decoded again; where
    the bytes are not those of the text, the text is encoded anew piece by
    piece.  ``with_ids=False`` leaves the ids out.  Columns of ``docs`` that have
    one of the new names are replaced.
    """
    spark = docs.sparkSession
    prepare(spark)
    spark.sparkContext.addFile(vocabulary_path)
    name = vocabulary_path.rsplit("/", 1)[-1]
    fields = [f for f in _NEW.fields if with_ids or f.name != "token_ids"]
    kept = docs.select(*[c for c in docs.columns if c not in _NEW.names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(SparkFiles.get(name))
        for b in batches:
            rows = texts(b.column(text))
            counts, shas, decoded, ids_of = [], [], [], []
            for row, ids in zip(rows, encode_all(vocab, rows), strict=True):
                data = row.encode("utf-8", "surrogatepass")
                back = vocab.decode(ids)
                if back != data:  # two pieces of one batch had the same hash
                    ids = exactly(vocab, row)
                    back = vocab.decode(ids)
                counts.append(len(ids))
                shas.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                decoded.append(hashlib.sha256(back).hexdigest())
                if with_ids:
                    ids_of.append(ids)
            new = [pa.array(counts, pa.int64()), pa.array(shas), pa.array(decoded)]
            if with_ids:
                flat = np.concatenate([np.zeros(0, np.uint32), *ids_of]).astype(np.int32)
                new.insert(0, pa.ListArray.from_arrays(pa.array(np.cumsum([0, *counts]), pa.int32()), pa.array(flat)))
            yield pa.RecordBatch.from_arrays([*b.columns, *new], names=[*b.schema.names, *[f.name for f in fields]])

    return kept.mapInArrow(run, StructType(kept.schema.fields + fields))


def exactly(vocab: Vocabulary, row: str) -> np.ndarray:
    """Token ids of a text, piece by piece by the pattern."""
    found = [vocab.encode_piece(p.encode("utf-8", "surrogatepass")) for p in _pattern().findall(row)]
    return np.array([i for ids in found for i in ids], np.uint32)


def _pattern() -> regex.Pattern:
    import public_tokenizers

    return regex.compile(public_tokenizers.PATTERN)


def default_vocabulary() -> str:
    """The rank file that the query and the pipeline use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded bytes of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = byte_bpe(docs, default_vocabulary(), with_ids=False)
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents as token ids."""
    return byte_bpe(docs, default_vocabulary()).drop("text")
