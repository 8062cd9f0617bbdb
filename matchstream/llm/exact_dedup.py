"""Exact deduplication with Patricia tries that own the texts.

Texts are compared after white-space normalisation.  Each task first collapses
the copies it sees, so that a text copied into half of all rows is shuffled once
for a batch and not once for a row.  The remaining texts are dealt by length and
content hash; each partition inserts the full bytes into a compressed radix trie
whose terminal nodes store the smallest id.  A byte of the content hash stands before
the text, so that a trie has many subtrees of similar size; below it texts share
their prefixes.  When a trie outgrows its memory its largest subtrees go to
temporary files and are finished one by one.
"""

from __future__ import annotations

import hashlib
import pickle
import re
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from matchstream.llm.common import aside, first_row, prepare, stored, table, utf8

#: Bytes of text that a trie holds in memory before subtrees are spilled.
TRIE_BYTES = 48 << 20
#: Bytes of distinct text that the first pass looks back over for copies.
LOCAL_BYTES = 16 << 20

#: Runs of ASCII white space that differ from a single space.
_SPACES = re.compile(rb"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+")


def normalised(text: bytes) -> bytes:
    """``text`` with each run of ASCII white space replaced by one space."""
    return _SPACES.sub(b" ", text)


class _Node:
    __slots__ = ("children", "label", "owner")

    def __init__(self, label: bytes) -> None:
        self.label = label
        self.children: dict[int, _Node] = {}
        self.owner: list | None = None


def _common(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of ``a`` and ``b[at:]``."""
    low, high = 0, min(len(a), len(b) - at)
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[low:mid] == b[at + low : at + mid] else (low, mid - 1)
    return low


class _Spilled:
    """A subtree in a temporary file, and how many bytes all its keys have in common."""

    def __init__(self) -> None:
        self.file = tempfile.TemporaryFile()  # noqa: SIM115  closed by owners()
        self.first: bytes | None = None
        self.shared = 0

    def add(self, key: bytes, rank: tuple, rows: int, members: list) -> None:
        if self.first is None:
            self.first, self.shared = key, len(key)
        else:
            self.shared = min(self.shared, _common(self.first, key, 0))
        pickle.dump((key, rank, rows, members), self.file)

    def entries(self) -> Iterator[tuple]:
        self.file.seek(0)
        while True:
            try:
                yield pickle.load(self.file)
            except EOFError:
                self.file.close()
                return


class PatriciaTrie:
    """A compressed radix trie over bytes; an owner is kept for each key.

    An owner is ``[smallest rank, rows, members]``, where a rank is any
    comparable value.  All keys agree in their first ``depth`` bytes.
    """

    def __init__(self, budget: int = TRIE_BYTES, depth: int = 0) -> None:
        self.root = _Node(b"")
        self.budget, self.depth = budget, depth
        self.held: dict[int, int] = {}
        self.files: dict[int, _Spilled] = {}

    def insert(self, key: bytes, rank: tuple, rows: int, members: list) -> None:
        branch = key[self.depth] if self.depth < len(key) else -1
        if branch in self.files:
            self.files[branch].add(key, rank, rows, members)
            return
        node = self._terminal(key, branch)
        if node.owner is None:
            node.owner = [rank, rows, list(members)]
        else:
            node.owner[0] = min(node.owner[0], rank)
            node.owner[1] += rows
            node.owner[2] += members
        if sum(self.held.values()) > self.budget and len(self.held) > 1:
            self._spill(max(self.held, key=self.held.__getitem__))

    def _terminal(self, key: bytes, branch: int) -> _Node:
        node, at = self.root, min(self.depth, len(key))
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                child = node.children[key[at]] = _Node(key[at:])
                self.held[branch] = self.held.get(branch, 0) + len(child.label) + 400
                return child
            if not key.startswith(child.label, at):
                shared = _common(child.label, key, at)
                fork = _Node(child.label[:shared])
                child.label = child.label[shared:]
                fork.children[child.label[0]] = child
                node.children[key[at]] = child = fork
                self.held[branch] += 400
            node, at = child, at + len(child.label)
        return node

    def _spill(self, branch: int) -> None:
        """Move the subtree below one child of the root to a temporary file."""
        top = self.root.children.pop(branch)
        out = self.files[branch] = _Spilled()
        # The bytes before this trie's depth are the same in all keys, so they can be left open.
        for key, (rank, rows, members) in self._walk(top, bytes(self.depth)):
            out.add(key, rank, rows, members)
        del self.held[branch]

    @staticmethod
    def _walk(top: _Node, prefix: bytes) -> Iterator[tuple[bytes, list]]:
        stack = [(top, prefix)]
        while stack:
            node, before = stack.pop()
            key = before + node.label
            if node.owner is not None:
                yield key, node.owner
            stack += [(child, key) for child in node.children.values()]

    def owners(self) -> Iterator[list]:
        """The owner of each key, in no order.  The trie is used up."""
        if self.root.owner is not None:
            yield self.root.owner
        for top in self.root.children.values():
            for _, owner in self._walk(top, b""):
                yield owner
        self.root, self.held = _Node(b""), {}
        for spilled in self.files.values():
            # Where texts share a long prefix, the next trie starts behind it.
            below = PatriciaTrie(self.budget, max(self.depth + 1, spilled.shared))
            for entry in spilled.entries():
                below.insert(*entry)
            yield from below.owners()


_MARKS = StructType(
    [
        StructField("_row", LongType()),
        StructField("_same_as", LongType()),
        StructField("_copies", LongType()),
        StructField("_length", LongType()),
        StructField("_sha256", BinaryType()),
    ]
)
_OWNERS = StructType(
    [
        StructField("_same_as", LongType()),
        StructField("_keep_row", LongType()),
        StructField("keep_id", LongType()),
        StructField("group_size", LongType()),
    ]
)


def _rank(doc_id: int | None, row: int) -> tuple:
    """Order of the rows of a group: by id, null last, then by row."""
    return (doc_id is None, doc_id or 0, row)


def _mark(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with a number for each row and the copies within a task collapsed.

    ``_same_as`` is the number of the row that stands for this one; ``_copies``
    counts, at the standing row itself, the rows of its text in this task so
    far as they are not reported yet, and is null at other rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = first_row()
        seen: dict[bytes, list] = {}
        held = 0
        for b in batches:
            found = []
            first_here: dict[bytes, int] = {}
            ids = b.column(id_col).to_pylist()
            for i, text in enumerate(utf8(b.column(text_col))):
                text = normalised(text)
                sha = hashlib.sha256(text).digest()
                same = seen.get(text)
                # A standing row must have the smallest rank of those it stands for.
                if same is None or _rank(ids[i], row) < same[1]:
                    if same is None:
                        held += len(text) + 200
                    same = seen[text] = [row, _rank(ids[i], row)]
                    first_here[text] = i
                    found.append([row, row, 1, len(text), sha])
                else:
                    at = first_here.get(text)
                    if at is None:  # its standing row left with an earlier batch
                        same = seen[text] = [row, _rank(ids[i], row)]
                        first_here[text] = i
                        found.append([row, row, 1, len(text), sha])
                    else:
                        found[at][2] += 1
                        found.append([row, same[0], None, len(text), sha])
                row += 1
            new = [pa.array([f[i] for f in found], k) for i, k in enumerate([pa.int64()] * 4 + [pa.binary()])]
            yield pa.RecordBatch.from_arrays([*b.columns, *new], names=[*b.schema.names, *_MARKS.names])
            if held > LOCAL_BYTES:
                seen, held = {}, 0

    return docs.mapInArrow(run, StructType(docs.schema.fields + _MARKS.fields))


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One partition's trie: for each standing row, the owner of its text."""
    trie = PatriciaTrie()
    for b in batches:
        columns = [b.column(c).to_pylist() for c in ("_id", "_same_as", "_copies", "_sha256")]
        for doc_id, row, copies, sha, text in zip(*columns, utf8(b.column("_text")), strict=True):
            trie.insert(sha[:1] + normalised(text), _rank(doc_id, row), copies, [row])
    schema = pa.schema([(n, pa.int64()) for n in _OWNERS.names])
    rows: list[tuple] = []
    for (no_id, doc_id, row), count, members in trie.owners():
        rows += [(member, row, None if no_id else doc_id, count) for member in members]
        if len(rows) > 20_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=schema)
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=schema)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows of ``docs`` with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when their normalised bytes are; a null text counts as
    empty.  Of each group the row with the smallest id is kept.  A null id comes
    after all others, and of rows with the same id the one read first stays, so
    each group keeps exactly one row.  ``keep_id`` is null if all ids of a group
    are.  Columns of ``docs`` that have one of the new names are replaced, all
    others come back as they are.
    """
    spark = docs.sparkSession
    prepare(spark)
    new = ["keep_id", "group_size", "kept", "text_sha256"]
    docs, back = aside(docs.select(*[c for c in docs.columns if c not in new]), id_col, text_col)
    marked = stored(_mark(docs, id_col, text_col), "exact-dedup")
    standing = marked.where("_copies is not null").select(
        F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"), "_same_as", "_copies", "_length", "_sha256"
    )
    owners = standing.repartition("_length", "_sha256").mapInArrow(_own, _OWNERS)
    return marked.join(owners, "_same_as").select(
        *back,
        "keep_id",
        "group_size",
        (F.col("_row") == F.col("_keep_row")).alias("kept"),
        F.lower(F.hex("_sha256")).alias("text_sha256"),
    )


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays of its group."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP2_SQL = r"""
SELECT doc_id,
       min(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept,
       sha256(t) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
WINDOW same AS (PARTITION BY t)
"""


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each group of equal texts stays.

    Null counts as empty, so one document without text stays.  The smallest id
    stays, null last, and of equal ids the row read first.  The input's columns
    come back as they are, whatever their names; an empty table stays empty.
    """
    inner, back = aside(docs, "doc_id", "text")
    return exact_dedup(inner).where("kept").select(*back)
