"""N-gram Jaccard self-join of documents, to connected groups of near copies.

1. Each document becomes a set of hashed word shingles.  Documents with equal
   sets are one class; a representative stands for it from here on.
2. The shingles are dealt by hash, packed in blobs, and counted: how many
   documents hold each.  Those that two or more hold go back to the documents.
   A linked document shares at least the threshold's part of its shingles, so
   most documents are done with here.
3. Of the rest each has a prefix: its rarest shingles, so many that linked
   documents have at least one of them in common.
4. First, documents with the same smallest hash are joined in blocks and the
   links contracted to groups, which disposes of large groups of copies.
5. Then documents of different groups that share a prefix shingle are joined:
   the count vectors of one block are the points of an R-tree, those of the
   other its queries; surviving pairs are verified on the shingles themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchstream.llm.common import aside, first_row, mixed, numbered, prepare, reducers, stored, table, utf8
from matchstream.llm.components import components
from matchstream.llm.rtree import GROUPS, CountRTree, count_vector
from matchstream.llm.shingles import shingle_sets, signature

#: Shingles and documents of a chunk, within which a document has 16 bits.
CHUNK_SHINGLES, CHUNK_DOCS = 1 << 20, 1 << 16
#: A shingle that so many documents of a chunk hold is sent as a count.
HOT = 16
#: Documents of a block of the joins.
BLOCK = 512
#: Rounds of joins on the smallest hash, each with another hash.
ROUNDS = 2

_U64, _U32, _U16 = np.dtype("<u8"), np.dtype("<u4"), np.dtype("<u2")


def _blob(x: np.ndarray, kind: np.dtype) -> bytes:
    return x.astype(kind).tobytes()


def _join_blobs(column: pa.ChunkedArray | pa.Array, kind: np.dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _counts(column: pa.ChunkedArray | pa.Array, kind: np.dtype) -> np.ndarray:
    return np.array([len(x) // kind.itemsize for x in column.to_pylist()], np.int64)


def _chunks(batches: Iterator[pa.RecordBatch], id_col: str, text_col: str, width: int) -> Iterator[tuple]:
    """(first row number, ids, sets, signatures, index of the first equal set) chunk by chunk.

    Row numbers follow from the partition and the order in it, so that a
    second run over the same partitions gives the same.
    """
    row = first_row()
    ids, sets, total = [], [], 0

    def done() -> tuple:
        marks = [signature(s) for s in sets]
        first: dict[bytes, int] = {}
        same = [first.setdefault(m, i) for i, m in enumerate(marks)]
        return row, ids, sets, marks, same

    for b in batches:
        rows = utf8(b.column(text_col))
        for doc_id, s in zip(b.column(id_col).to_pylist(), shingle_sets(rows, width), strict=True):
            ids.append(doc_id)
            sets.append(s)
            total += len(s)
            if total >= CHUNK_SHINGLES or len(ids) == CHUNK_DOCS:
                yield done()
                row += len(ids)
                ids, sets, total = [], [], 0
    if ids:
        yield done()


def _incidences(sets: list[np.ndarray], same: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, document and count in the chunk, of each shingle of the standing documents, by hash."""
    own = [i for i, s in enumerate(same) if s == i]
    hashes = np.concatenate([np.zeros(0, _U64), *[sets[i] for i in own]])
    docs = np.repeat(np.array(own, np.int64), [len(sets[i]) for i in own])
    order = np.argsort(hashes, kind="stable")
    hashes, docs = hashes[order], docs[order]
    cuts = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
    held = np.diff(np.append(cuts, len(hashes)))
    return hashes, docs, np.repeat(held, held)


def _document_rows(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """One row for each document: number, id, size and signature, and its shingles that are sent as counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for first, ids, sets, marks, same in _chunks(batches, id_col, text_col, width):
            hashes, holders, held = _incidences(sets, same)
            hot = held >= HOT
            order = np.argsort(holders[hot], kind="stable")
            holders, hashes = holders[hot][order], hashes[hot][order]
            cuts = np.searchsorted(holders, np.arange(len(ids) + 1))
            yield pa.RecordBatch.from_pydict(
                {
                    "row": pa.array(np.arange(first, first + len(ids))),
                    "id": pa.array(ids, pa.int64()),
                    "chunk": pa.array(np.full(len(ids), first)),
                    "n": pa.array([len(s) for s in sets], pa.int64()),
                    "mark": pa.array(marks, pa.binary()),
                    "stands": pa.array([s == i for i, s in enumerate(same)]),
                    "hot": pa.array([_blob(hashes[a:b], _U64) for a, b in zip(cuts, cuts[1:])], pa.binary()),
                }
            )

    return docs.mapInArrow(run, "row long, id long, chunk long, n long, mark binary, stands boolean, hot binary")


def _incidence_blobs(docs: DataFrame, id_col: str, text_col: str, width: int, buckets: int) -> DataFrame:
    """The shingles of each chunk, packed by bucket of their hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for first, _, sets, _, same in _chunks(batches, id_col, text_col, width):
            hashes, holders, held = _incidences(sets, same)
            # Buckets are ranges of the hash, so the order by hash is one by bucket as well.
            edges = [np.uint64(k * (1 << 64) // buckets) for k in range(1, buckets)]
            cuts = np.concatenate([[0], np.searchsorted(hashes, np.array(edges, _U64)), [len(hashes)]]).astype(int)
            rows: dict[str, list] = {k: [] for k in ("bucket", "chunk", "cold", "docs", "hot", "held")}
            for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                if a == b:
                    continue
                h, d, c = hashes[a:b], holders[a:b], held[a:b]
                is_hot = c >= HOT
                lead = is_hot & np.concatenate([[True], h[1:] != h[:-1]])
                rows["bucket"].append(k)
                rows["chunk"].append(first)
                rows["cold"].append(_blob(h[~is_hot], _U64))
                rows["docs"].append(_blob(d[~is_hot], _U16))
                rows["hot"].append(_blob(h[lead], _U64))
                rows["held"].append(_blob(c[lead], _U32))
            kinds = [pa.int32(), pa.int64()] + [pa.binary()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows.values(), kinds)], names=list(rows))

    return docs.mapInArrow(run, "bucket int, chunk long, cold binary, docs binary, hot binary, held binary")


def _count_bucket(t: pa.Table) -> pa.Table:
    """One bucket: the shingles that two or more documents hold, for each chunk."""
    chunks = np.array(t["chunk"].to_pylist(), np.int64)
    n_cold, n_hot = _counts(t["cold"], _U64), _counts(t["hot"], _U64)
    cold, hot = _join_blobs(t["cold"], _U64), _join_blobs(t["hot"], _U64)
    docs = _join_blobs(t["docs"], _U16)
    weight = np.concatenate([np.ones(len(cold), np.int64), _join_blobs(t["held"], _U32).astype(np.int64)])
    hashes = np.concatenate([cold, hot])
    distinct, which = np.unique(hashes, return_inverse=True)
    df = np.bincount(which, weights=weight, minlength=len(distinct)).astype(np.int64)[which]
    df_cold, df_hot = np.minimum(df[: len(cold)], 0xFFFFFFFF), np.minimum(df[len(cold) :], 0xFFFFFFFF)
    rows: dict[str, list] = {k: [] for k in ("chunk", "shared", "docs", "df", "hot", "hot_df")}
    at_cold, at_hot = np.cumsum(n_cold) - n_cold, np.cumsum(n_hot) - n_hot
    for i in range(len(chunks)):
        a, b = at_cold[i], at_cold[i] + n_cold[i]
        c, d = at_hot[i], at_hot[i] + n_hot[i]
        two = df_cold[a:b] >= 2
        if two.any() or c < d:
            rows["chunk"].append(int(chunks[i]))
            rows["shared"].append(_blob(cold[a:b][two], _U64))
            rows["docs"].append(_blob(docs[a:b][two], _U16))
            rows["df"].append(_blob(df_cold[a:b][two], _U32))
            rows["hot"].append(_blob(hot[c:d], _U64))
            rows["hot_df"].append(_blob(df_hot[c:d], _U32))
    kinds = [pa.int64()] + [pa.binary()] * 5
    return pa.Table.from_arrays([pa.array(v, k) for v, k in zip(rows.values(), kinds)], names=list(rows))


def _needed(n: np.ndarray | int, share: tuple[int, int]):
    """The fewest shingles that a set of size n has in common with a linked one."""
    return -((-share[0] * n) // share[1])


def _survivors(share: tuple[int, int]):
    """Per chunk: the documents that may be linked, their shared shingles and their prefix."""

    def run(docs: pa.Table, shared: pa.Table) -> pa.Table:
        rows: dict[str, list] = {k: [] for k in ("row", "n", "shared", "prefix")}
        if docs.num_rows and shared.num_rows:
            hashes, df = _join_blobs(shared["shared"], _U64), _join_blobs(shared["df"], _U32)
            holders = _join_blobs(shared["docs"], _U16)
            order = np.argsort(holders, kind="stable")
            hashes, df, holders = hashes[order], df[order], holders[order]
            hot, hot_df = _join_blobs(shared["hot"], _U64), _join_blobs(shared["hot_df"], _U32)
            order = np.argsort(hot, kind="stable")
            hot, hot_df = hot[order], hot_df[order]
            for row, chunk, n, own in zip(*(docs[c].to_pylist() for c in ("row", "chunk", "n", "hot"))):
                i = row - chunk
                a, b = np.searchsorted(holders, [i, i + 1])
                own = np.frombuffer(own, _U64)
                count = b - a + len(own)
                single = n - count
                prefix = n - _needed(n, share) + 1
                if not count or single >= prefix:
                    continue
                h = np.concatenate([hashes[a:b], own])
                f = np.concatenate([df[a:b], hot_df[np.searchsorted(hot, own)]])
                rows["row"].append(row)
                rows["n"].append(n)
                rows["shared"].append(_blob(np.sort(h), _U64))
                rows["prefix"].append(_blob(h[np.lexsort((h, f))][: prefix - single], _U64))
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        return pa.Table.from_arrays([pa.array(v, k) for v, k in zip(rows.values(), kinds)], names=list(rows))

    return run


def _linked(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int, share: tuple[int, int]) -> bool:
    """Whether two sets are linked, from their sorted shared shingles and their sizes."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    both = int(np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a)) if len(b) else 0
    return share[1] * both >= share[0] * (n_a + n_b - both)


def _join_block(share: tuple[int, int]):
    """Links that connect the linked documents of a block."""

    def run(t: pa.Table) -> pa.Table:
        rows, sizes = t["row"].to_pylist(), np.array(t["n"].to_pylist(), np.int64)
        sets = [np.frombuffer(x, _U64) for x in t["shared"].to_pylist()]
        points = np.stack([count_vector(s) for s in sets])
        query, other = CountRTree(points, sizes, share).candidates(points, sizes)
        below = other < query
        group = list(range(len(rows)))

        def top(i: int) -> int:
            while group[i] != i:
                group[i] = i = group[group[i]]
            return i

        links = []
        for q, o in zip(query[below].tolist(), other[below].tolist()):
            if top(q) != top(o) and _linked(sets[q], sets[o], int(sizes[q]), int(sizes[o]), share):
                group[top(q)] = top(o)
                links.append((rows[q], rows[o]))
        a, b = zip(*links) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _candidate_cell(share: tuple[int, int]):
    """Pairs of different groups in one cell: the first block's queries against the second's tree."""

    def run(t: pa.Table) -> pa.Table:
        asks = np.array(t["asks"].to_pylist(), bool)
        rows, n, group = (np.array(t[c].to_pylist(), np.int64) for c in ("row", "n", "component"))
        points = np.frombuffer(b"".join(t["point"].to_pylist()), _U32).reshape(-1, GROUPS)
        a = b = np.zeros(0, np.int64)
        q, p = np.flatnonzero(asks), np.flatnonzero(~asks)
        if len(q) and len(p):
            query, other = CountRTree(points[p], n[p], share).candidates(points[q], n[q])
            query, other = q[query], p[other]
            apart = group[query] != group[other]
            a, b = rows[query[apart]], rows[other[apart]]
        return pa.table({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b))})

    return run


def _verify(share: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            columns = [t.column(c).to_pylist() for c in ("a", "b", "n_a", "n_b", "shared_a", "shared_b")]
            found = [
                (a, b)
                for a, b, n_a, n_b, s_a, s_b in zip(*columns)
                if _linked(np.frombuffer(s_a, _U64), np.frombuffer(s_b, _U64), n_a, n_b, share)
            ]
            a, b = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _smallest(seed: int):
    """``row, n, shared`` with the smallest of the shared shingles after mixing with a seed, as key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = mixed(np.array([seed + 1], _U64))
        for t in batches:
            keys = [int(mixed(np.frombuffer(s, _U64) ^ salt).min().view(np.int64)) for s in t.column("shared").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *t.columns], names=["key", *t.schema.names])

    return run


def _points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each prefix shingle of a document."""
    for t in batches:
        prefixes = [np.frombuffer(p, _U64).view(np.int64) for p in t.column("prefix").to_pylist()]
        if prefixes:
            rows = np.repeat(np.array(t.column("row").to_pylist(), np.int64), [len(p) for p in prefixes])
            yield pa.RecordBatch.from_pydict({"key": pa.array(np.concatenate(prefixes)), "row": pa.array(rows)})


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t in batches:
        points = [count_vector(np.frombuffer(s, _U64)).astype(_U32).tobytes() for s in t.column("shared").to_pylist()]
        yield pa.RecordBatch.from_arrays([t.column("row"), t.column("n"), pa.array(points, pa.binary())], names=["row", "n", "point"])


def _contract(kept: DataFrame, share: tuple[int, int]) -> DataFrame:
    """Links found among documents with the same smallest shingle, in blocks dealt at random."""
    links = None
    for seed in range(ROUNDS):
        keyed = kept.select("row", "n", "shared").mapInArrow(_smallest(seed), "key long, row long, n long, shared binary")
        sizes = keyed.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
        dealt = keyed.join(sizes, "key").withColumn(
            "block", F.pmod(F.xxhash64("row", F.lit(seed)), F.ceil(F.col("members") / BLOCK))
        )
        found = dealt.groupBy("key", "block").applyInArrow(_join_block(share), "a long, b long")
        links = found if links is None else links.unionByName(found)
    return links


def _complete(kept: DataFrame, groups: DataFrame, share: tuple[int, int]) -> DataFrame:
    """Links between documents of different groups, by the prefix shingles they share."""
    spark = kept.sparkSession
    grouped = kept.select("row").join(groups, F.col("row") == F.col("node"), "left")
    grouped = grouped.select("row", F.coalesce("component", "row").alias("component"))
    prefix = kept.select("row", "prefix").mapInArrow(_points, "key long, row long")
    prefix = prefix.join(grouped, "row")
    # The largest group of a key need not be compared with itself.
    per_group = prefix.groupBy("key", "component").agg(F.count("*").alias("c"))
    keys = per_group.groupBy("key").agg(F.sum("c").alias("members"), F.max(F.struct("c", "component")).alias("top"))
    keys = keys.where("members > top.c").select(
        "key",
        F.col("top.component").alias("largest"),
        F.ceil(F.col("members") / BLOCK).alias("blocks"),
        F.ceil((F.col("members") - F.col("top.c")) / BLOCK).alias("asking"),
    )
    dealt = stored(prefix.join(keys, "key"), "prefixes")
    block = F.pmod(F.xxhash64("row"), F.col("blocks"))
    ask_block = F.pmod(F.xxhash64("row"), F.col("asking"))
    asks = dealt.where("component != largest").select(
        "key", "row", "component", F.lit(True).alias("asks"), ask_block.alias("i"),
        F.explode(F.expr("sequence(0L, blocks - 1)")).alias("j"),
    )
    answers = dealt.select(
        "key", "row", "component", F.lit(False).alias("asks"),
        F.explode(F.expr("sequence(0L, asking - 1)")).alias("i"), block.alias("j"),
    )
    vectors = kept.select("row", "n", "shared").mapInArrow(_vectors, "row long, n long, point binary")
    cells = asks.unionByName(answers).join(vectors, "row")
    pairs = cells.groupBy("key", "i", "j").applyInArrow(_candidate_cell(share), "a long, b long").distinct()
    sets = kept.select("row", "n", "shared")
    for side in "ab":
        own = sets.select(F.col("row").alias(side), F.col("n").alias(f"n_{side}"), F.col("shared").alias(f"shared_{side}"))
        pairs = pairs.join(own, side)
    return pairs.mapInArrow(_verify(share), "a long, b long")


def jaccard_groups(
    docs: DataFrame, width: int, share: tuple[int, int], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``row, id, n_shingles, component_id, first`` for each row of ``docs``.

    Documents link when 100 * intersection >= threshold * union of their sets
    of ``width``-word shingles, with ``share`` = (numerator, denominator) of the
    threshold; words are runs of characters other than ASCII white space, A-Z
    in lower case.  ``component_id`` is the smallest id that can be reached.  A
    null or empty text has no shingles and is linked with nothing.  A null id
    comes after all others; a group of null ids has a null ``component_id``.
    ``first`` marks one row of each group: that of the smallest id, the one read
    first if the id repeats.  Shingles are compared by 64-bit hashes.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = stored(_document_rows(docs, "id", "text", width), "jaccard-documents")
    buckets = 4 * reducers(spark)
    blobs = _incidence_blobs(docs, "id", "text", width, buckets)
    shared = blobs.groupBy("bucket").applyInArrow(
        _count_bucket, "chunk long, shared binary, docs binary, df binary, hot binary, hot_df binary"
    )
    classes = rows.groupBy("mark").agg(F.min("row").alias("class"))
    standing = rows.where("stands").select("chunk", "row", "n", "hot")
    standing = standing.join(classes.select(F.col("class").alias("row")), "row", "left_semi")
    may = standing.groupBy("chunk").cogroup(shared.groupBy("chunk"))
    kept = may.applyInArrow(_survivors(share), "row long, n long, shared binary, prefix binary")
    kept = stored(kept, "jaccard-survivors")

    links = stored(_contract(kept, share), "jaccard-links")
    groups = components(links)
    stars = groups.select(F.col("node").alias("a"), F.col("component").alias("b"))
    groups = components(stars.unionByName(_complete(kept, groups, share)))

    classes = classes.join(groups, F.col("class") == F.col("node"), "left")
    classes = classes.select("mark", F.coalesce("component", "class").alias("component"))
    empty = F.col("n") == 0
    placed = rows.select("row", "id", "n", "mark").join(classes, "mark")
    placed = placed.select("row", "id", "n", F.when(empty, F.col("row")).otherwise(F.col("component")).alias("component"))
    heads = placed.groupBy("component").agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("id"), F.col("row").alias("row"))).alias("head")
    )
    return placed.join(heads, "component").select(
        "row",
        "id",
        F.col("n").alias("n_shingles"),
        F.col("head.id").alias("component_id"),
        (F.col("row") == F.col("head.row")).alias("first"),
    )


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle count and group of every document, four words and 0.85."""
    found = jaccard_groups(table(spark, sf_dir, "documents"), 4, (85, 100))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each group of near copies stays, five words and 0.8.

    Documents without words or text are near copies of nothing and stay, and
    repeated rows leave one.  Of a group the smallest id stays, null last, and of
    equal ids the row read first.  The input's columns come back as they are,
    whatever their names.  The rows that go are written first, so that the size of
    that table is known when the join with the texts is planned.
    """
    gone = jaccard_groups(docs, 5, (80, 100)).where("not first").select(F.col("row").alias("_row"))
    inner, back = aside(docs)
    return numbered(inner).join(stored(gone, "jaccard-gone"), "_row", "left_anti").select(*back)
