"""Removal of repeated byte strings, exact at every length from a threshold on.

A byte goes if a window of ``LENGTH`` bytes that covers it occurs anywhere else.

1. Each window has an anchor: of the hashes of its ``GRAM``-byte strings the
   smallest, the leftmost of equals.  Equal windows have equal anchors at equal
   places.  Neighbouring windows with the same anchor form a segment, the bytes
   that they cover.  Only hashes of segments are shuffled, once for a chunk of
   documents however often a chunk has them.
2. Segments that occur twice are repeated as a whole.  Of the rest, those whose
   anchor has several different segments may hold windows of one another; their
   bytes are fetched and dealt by anchor to blocks.
3. In each block a Burrows-Wheeler transform of the segments is expanded
   breadth first: common prefixes by increasing value, stopping at ``LENGTH``.
4. An anchor with very many different segments is dealt window by window, by
   the hash of the window, so that no block grows with its frequency.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from matchstream.llm.bwt import repeated_windows
from matchstream.llm.common import aside, chunked, mixed, prepare, reducers, stored, table, utf8

LENGTH = 200
GRAM = 64
#: Bytes of a long document that are looked at at once.
PIECE_BYTES = 1 << 20
#: Bytes of segments in a block of the transform.
BLOCK_BYTES = 1 << 19
#: An anchor with more different segments is dealt window by window.
MOST_SEGMENTS = 1024

_U64, _I64, _U32, _U8 = np.dtype("<u8"), np.dtype("<i8"), np.dtype("<u4"), np.dtype("u1")
_VALUE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0xDA942042E4DD58B5
_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0][0]) < n:
        both = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(max(n, PIECE_BYTES + LENGTH + 1), base, np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps))
        _POWERS[:] = [(both[0], both[1])]
    return _POWERS[0][0][:n], _POWERS[0][1][:n]


def segments(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, anchor hash, content hash) of the segments of a text.

    Each window start belongs to exactly one segment.  A long text is taken in
    pieces that overlap by a window less one byte.
    """
    found = [_piece(data, at) for at in range(0, max(1, len(data) - LENGTH + 1), PIECE_BYTES)]
    return tuple(np.concatenate(c) for c in zip(*found))


def _piece(data: bytes, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    b = np.frombuffer(data, np.uint8, min(len(data) - at, PIECE_BYTES + LENGTH - 1), at)
    windows = len(b) - LENGTH + 1
    if windows < 1:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(_U64), none.astype(_U64)
    powers, inverse = _powers(len(b) + 1)
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_VALUE[b] * powers[:-1], out=sums[1:])
    grams = mixed((sums[GRAM:] - sums[:-GRAM]) * inverse[: len(b) - GRAM + 1])
    # The smallest gram of each window; the low bits hold its place.
    place = np.uint64((1 << 24) - 1)
    least = (grams & ~place) | np.arange(len(grams), dtype=np.uint64)
    width, have = LENGTH - GRAM + 1, 1
    while have < width:
        shift = min(have, width - have)
        least = np.minimum(least[:-shift], least[shift:])
        have += shift
    anchor = (least & place).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    count = np.diff(np.append(first, windows))
    ends = first + count + LENGTH - 1
    content = mixed((sums[ends] - sums[first]) * inverse[first] + count.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    # Anchors are small among hashes; mixed again they are spread evenly.
    return first + at, count, mixed(grams[anchor[first]] + np.uint64(1)), content


def _pack(x: np.ndarray, kind: np.dtype) -> bytes:
    return x.astype(kind).tobytes()


def _all(column: pa.ChunkedArray | pa.Array, kind: np.dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _repeat(values: pa.ChunkedArray, sizes: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.repeat(np.array(values.to_pylist(), np.int64), [len(x) // width for x in sizes.to_pylist()])


def _hash_blobs(docs: DataFrame, text: str, buckets: int) -> DataFrame:
    """The distinct segments of each chunk, packed by bucket of the anchor, and whether the chunk has them twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.array([k * (1 << 64) // buckets for k in range(1, buckets)], _U64)
        kinds = [pa.int32(), pa.int64()] + [pa.binary()] * 4

        def packed(chunk: int, found: list[tuple]) -> pa.RecordBatch:
            _, count, anchor, content = (np.concatenate(c) for c in zip(*found))
            order = np.lexsort((content, anchor))
            count, anchor, content = count[order], anchor[order], content[order]
            new = np.concatenate([np.ones(min(1, len(anchor)), bool), (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1])])
            lead = np.flatnonzero(new)
            twice = np.diff(np.append(lead, len(anchor))) > 1
            count, anchor, content = count[lead], anchor[lead], content[lead]
            cuts = np.concatenate([[0], np.searchsorted(anchor, edges), [len(anchor)]]).tolist()
            rows = [
                (k, chunk, _pack(anchor[a:b], _U64), _pack(content[a:b], _U64), _pack(count[a:b], _U8), _pack(twice[a:b], _U8))
                for k, (a, b) in enumerate(zip(cuts, cuts[1:]))
                if a < b
            ]
            columns = zip(*rows) if rows else [[]] * 6
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["bucket", "chunk", "anchor", "content", "windows", "twice"]
            )

        chunk, found = None, []
        for b in batches:
            for own, data in zip(b.column("_chunk").to_pylist(), utf8(b.column(text)), strict=True):
                if own != chunk and found:
                    yield packed(chunk, found)
                    found = []
                chunk = own
                found.append(segments(data))
        if found:
            yield packed(chunk, found)

    return docs.mapInArrow(
        run, "bucket int, chunk long, anchor binary, content binary, windows binary, twice binary"
    )


#: What is known of a segment after counting: repeated as a whole, or to be
#: fetched; and whether this chunk fetches it.
_WHOLE, _FETCH = 1, 2


def _count_bucket(t: pa.Table) -> pa.Table:
    """One bucket: for each chunk its segments that are repeated as a whole or to be fetched."""
    chunk = _repeat(t["chunk"], t["anchor"], 8)
    anchor, content = _all(t["anchor"], _U64), _all(t["content"], _U64)
    windows, twice = _all(t["windows"], _U8).astype(np.int64), _all(t["twice"], _U8)
    order = np.lexsort((chunk, content, anchor))
    chunk, anchor, content, windows, twice = (x[order] for x in (chunk, anchor, content, windows, twice))
    n = len(anchor)
    new_anchor = np.concatenate([[True], anchor[1:] != anchor[:-1]])
    new = new_anchor.copy()
    new[1:] |= content[1:] != content[:-1]
    lead = np.flatnonzero(new)
    sizes = np.diff(np.append(lead, n))
    whole_class = (sizes > 1) | (twice[lead] > 0)  # a chunk lists a segment once
    of_class = np.cumsum(new) - 1
    of_anchor = np.cumsum(new_anchor) - 1
    anchor_of_class = of_anchor[lead]
    classes = np.bincount(anchor_of_class)
    open_classes = np.bincount(anchor_of_class, weights=~whole_class)
    fetch = new & (classes[of_anchor] > 1) & (open_classes[of_anchor] > 0)
    flags = whole_class[of_class] * _WHOLE + fetch * _FETCH
    # Bytes of a segment that are dealt: at once, or for each window.
    split = classes > MOST_SEGMENTS
    total = np.bincount(of_anchor[fetch], weights=windows[fetch], minlength=len(classes)) * LENGTH
    blocks = np.where(split, np.ceil(total / BLOCK_BYTES), 0).astype(np.int64)[of_anchor]
    keep = flags > 0
    order = np.flatnonzero(keep)[np.argsort(chunk[keep], kind="stable")]
    cuts = np.flatnonzero(np.concatenate([np.ones(min(1, len(order)), bool), chunk[order][1:] != chunk[order][:-1]]))
    rows = []
    for own in np.split(order, cuts[1:]) if len(order) else []:
        some = own[(flags[own] & _FETCH) > 0]
        size = int(np.where(blocks[some] > 0, windows[some] * LENGTH, windows[some] + LENGTH).sum())
        rows.append((int(chunk[own[0]]), _pack(anchor[own], _U64), _pack(content[own], _U64), _pack(flags[own], _U8), _pack(blocks[own], _U32), size))
    columns = zip(*rows) if rows else [[]] * 6
    kinds = [pa.int64()] + [pa.binary()] * 4 + [pa.int64()]
    return pa.Table.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], names=["chunk", "anchor", "content", "flags", "blocks", "size"]
    )


class _Known:
    """The flags of a chunk's segments, looked up by their hashes."""

    def __init__(self, t: pa.Table) -> None:
        self.key = _all(t["anchor"], _U64) ^ mixed(_all(t["content"], _U64))
        order = np.argsort(self.key, kind="stable")
        self.key = self.key[order]
        self.flags, self.blocks = _all(t["flags"], _U8)[order], _all(t["blocks"], _U32)[order]

    def of(self, anchor: np.ndarray, content: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The index and the flags of segments; flags 0 if nothing is known."""
        if not len(self.key):
            return np.zeros(len(anchor), np.int64), np.zeros(len(anchor), np.uint8)
        key = anchor ^ mixed(content)
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return at, np.where(self.key[at] == key, self.flags[at], 0)


_PACKED = "block long, chunk long, rows binary, ats binary, sizes binary, whole binary, bytes binary"


def _fetch(text: str, total_blocks: int):
    """Per chunk: the bytes of the segments to be fetched, packed by block."""

    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        blocks: dict[int, list[tuple]] = {}
        chunk = docs["_chunk"][0].as_py() if docs.num_rows else 0
        if known.num_rows:
            flags = _Known(known)
            done = np.zeros(len(flags.key), bool)
            for row, data in zip(docs["_row"].to_pylist(), utf8(docs[text]), strict=True):
                first, count, anchor, content = segments(data)
                at, flag = flags.of(anchor, content)
                for i in np.flatnonzero(flag & _FETCH).tolist():
                    if done[at[i]]:
                        continue
                    done[at[i]] = True
                    a, n, parts = int(first[i]), int(count[i]), int(flags.blocks[at[i]])
                    whole = bool(flag[i] & _WHOLE)
                    if not parts:
                        block = int(anchor[i] % np.uint64(total_blocks))
                        blocks.setdefault(block, []).append((row, a, whole, data[a : a + n + LENGTH - 1]))
                        continue
                    for p in range(a, a + n):
                        window = data[p : p + LENGTH]
                        part = int.from_bytes(hashlib.blake2b(window, digest_size=8).digest(), "little") % parts
                        block = int(mixed(anchor[i : i + 1] + np.uint64(part + 1))[0] % np.uint64(total_blocks))
                        blocks.setdefault(block, []).append((row, p, whole, window))
        packed = []
        for block, own in blocks.items():
            rows, ats, whole, strings = zip(*own)
            sizes = np.array([len(x) for x in strings])
            packed.append(
                (block, chunk, _pack(np.array(rows), _I64), _pack(np.array(ats), _I64), _pack(sizes, _U32), bytes(whole), b"".join(strings))
            )
        columns = zip(*packed) if packed else [[]] * 7
        kinds = [pa.int64()] * 2 + [pa.binary()] * 5
        names = [f.split()[0] for f in _PACKED.split(", ")]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return run


def _expand(t: pa.Table) -> pa.Table:
    """One block: the repeated windows of segments that aren't repeated as a whole, as runs packed by chunk."""
    strings: list[bytes] = []
    for sizes, data in zip(t["sizes"].to_pylist(), t["bytes"].to_pylist()):
        ends = np.cumsum(np.frombuffer(sizes, _U32), dtype=np.int64)
        strings += [data[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
    chunks = np.repeat(np.array(t["chunk"].to_pylist(), np.int64), [len(x) // 4 for x in t["sizes"].to_pylist()])
    places = zip(chunks.tolist(), _all(t["rows"], _I64).tolist(), _all(t["ats"], _I64).tolist(), _all(t["whole"], _U8).tolist())
    runs: dict[int, list[tuple[int, int, int]]] = {}
    for (chunk, row, at, whole), repeated in zip(places, repeated_windows(strings, LENGTH), strict=True):
        if not whole and repeated.any():
            edge = np.diff(np.concatenate([[0], repeated.astype(np.int8), [0]]))
            starts = np.flatnonzero(edge == 1)
            own = runs.setdefault(chunk, [])
            own += [(row, at + a, b - a) for a, b in zip(starts.tolist(), np.flatnonzero(edge == -1).tolist())]
    packed = [np.array(r, np.int64).tobytes() for r in runs.values()]
    return pa.table({"chunk": pa.array(list(runs), pa.int64()), "runs": pa.array(packed, pa.binary())})


_RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>, kept binary"


def _cover(data: bytes, first: np.ndarray, count: np.ndarray) -> tuple[list[dict], bytes]:
    """The maximal runs that the windows cover, and the bytes outside them."""
    edge = np.zeros(len(data) + 1, np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, first + count + LENGTH - 1, -1)
    gone = np.cumsum(edge[:-1]) > 0
    change = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
    spans = [{"start": a, "end": b} for a, b in zip(np.flatnonzero(change == 1).tolist(), np.flatnonzero(change == -1).tolist())]
    return spans, np.frombuffer(data, np.uint8)[~gone].tobytes()


def _remove(text: str, others: list[str], with_kept: bool):
    """Per chunk: the spans that go from each document and what is left of it."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        flags = _Known(known.filter(pa.array([x is not None for x in known["anchor"].to_pylist()], pa.bool_())))
        runs = np.frombuffer(b"".join(r for r in known["runs"].to_pylist() if r is not None), np.int64).reshape(-1, 3)
        runs = runs[np.argsort(runs[:, 0], kind="stable")]
        out: list[tuple] = []
        for row, data in zip(docs["_row"].to_pylist(), utf8(docs[text]), strict=True):
            first, count, anchor, content = segments(data)
            whole = (flags.of(anchor, content)[1] & _WHOLE) > 0
            more = runs[slice(*np.searchsorted(runs[:, 0], [row, row + 1]))]
            spans, kept = _cover(data, np.concatenate([first[whole], more[:, 1]]), np.concatenate([count[whole], more[:, 2]]))
            out.append((len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), spans, kept if with_kept else None))
        columns = list(zip(*out)) if out else [[]] * 6
        kinds = [pa.int64()] * 3 + [pa.string(), kind, pa.binary()]
        names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]
        return pa.Table.from_arrays(
            [*(docs[c].combine_chunks() for c in others), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=[*others, *names]
        )

    return run


def remove_repeats(docs: DataFrame, text: str = "text", with_kept: bool = True) -> DataFrame:
    """``docs`` without its text, and what is left once repeated strings of ``LENGTH`` bytes are gone.

    Adds ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs),
    ``kept_sha256``, ``spans`` (byte offsets) and ``kept`` (the bytes left;
    null if not ``with_kept``).  A byte goes if some string of ``LENGTH`` bytes
    that covers it starts anywhere else as well, in the same or in another row.
    A null text counts as empty; texts shorter than ``LENGTH`` stay whole.
    Segments are compared by 128 bits of hashes, windows by their bytes.
    ``docs`` must be a table read from storage, whose rows come in the same
    partitions and order again.  Columns of ``docs`` that have one of the new
    names are replaced, all others come back as they are.
    """
    spark = docs.sparkSession
    prepare(spark)
    result = StructType.fromDDL(_RESULT)
    docs, back = aside(docs.select(*[c for c in docs.columns if c == text or c not in result.names]), text)
    back = [c for c, name in zip(back, docs.columns) if name != text]
    others = [c for c in docs.columns if c != text]
    blobs = _hash_blobs(chunked(docs.select(text), text), text, 4 * reducers(spark))
    counted = blobs.groupBy("bucket").applyInArrow(
        _count_bucket, "chunk long, anchor binary, content binary, flags binary, blocks binary, size long"
    )
    counted = stored(counted, "repeat-segments")
    size = counted.agg(F.sum("size")).first()[0] or 0
    total_blocks = max(1, -(-size // BLOCK_BYTES))
    lean = chunked(docs.select(text), text)
    fetched = lean.groupBy("_chunk").cogroup(counted.groupBy("chunk")).applyInArrow(
        _fetch(text, total_blocks), _PACKED
    )
    runs = fetched.groupBy("block").applyInArrow(_expand, "chunk long, runs binary")
    runs = stored(runs, "repeat-runs")
    nothing = [F.lit(None).cast("binary").alias(c) for c in ("anchor", "content", "flags", "blocks")]
    known = counted.select("chunk", "anchor", "content", "flags", "blocks", F.lit(None).cast("binary").alias("runs"))
    known = known.unionByName(runs.select("chunk", *nothing, "runs"))
    fields = [f for f in docs.schema.fields if f.name in others]
    removed = chunked(docs.select(*others, text), text).groupBy("_chunk").cogroup(known.groupBy("chunk")).applyInArrow(
        _remove(text, others, with_kept), StructType(fields + result.fields)
    )
    return removed.select(*back, *result.names)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is removed from every document, strings of 200 bytes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, with_kept=False).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
