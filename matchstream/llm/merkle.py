"""Merkle manifest of a dataset in the van Emde Boas layout.

A tree has three children to a node; its leaves are digests in a given order.
It is stored in blocks: aligned subtrees of at most ``HEIGHT`` levels above their
leaves, whose roots are the leaves of the next tier of blocks, up to the root.
Within a block the nodes lie in the van Emde Boas layout: the levels are split at
half height, the upper subtree is stored first, then the lower ones one after
the other, each of them laid out the same way.  The address of a node follows
from its level and index by arithmetic alone, which serves both to fill a block
and to find siblings.

On Spark the leaves are dealt by range of their order, so that the order within
a tree is counted without bringing a tree into one task; blocks are made and
read in groups of bounded size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from matchstream.llm.common import prepare, stored, table

#: Children of a node, and levels of a block above its leaves: 3 ** 7 = 2187 leaves.
WAYS, HEIGHT = 3, 7
#: Bytes of a digest.
DIGEST = 32

#: A tree's number, how many leaves it has, a leaf's place from 0 and its digest.
LEAVES = ["tree", "n", "place", "digest"]
_BLOCK = "tree long, n long, place long, height int, nodes binary, digest binary"
_BLOCK_ARROW = pa.schema(
    [("tree", pa.int64()), ("n", pa.int64()), ("place", pa.int64()), ("height", pa.int32()), ("nodes", pa.binary()), ("digest", pa.binary())]
)


def size(height: int) -> int:
    """Nodes of a full tree with so many levels above its leaves."""
    return (WAYS ** (height + 1) - 1) // (WAYS - 1)


def levels_above(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves; a lone leaf is the root itself."""
    height = 0
    while n > 1:
        n, height = -(-n // WAYS), height + 1
    return height


def address(height: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Where nodes lie in a block of the van Emde Boas layout; ``depth`` counts from its root.

    A tree of k levels is split into an upper tree of k // 2 levels and, below
    it, lower trees of the rest, which follow it in order.
    """
    levels, at, index = height + 1, 0, np.asarray(index, np.int64)
    while levels > 1:
        upper = levels // 2
        if depth < upper:
            levels = upper
            continue
        depth -= upper
        levels -= upper
        below = WAYS**depth
        at = at + size(upper - 1) + index // below * size(levels - 1)
        index = index % below
    return at + index


@cache
def _addresses(height: int) -> list[np.ndarray]:
    """The addresses of all nodes of a block, level by level from the leaves."""
    return [address(height, depth, np.arange(WAYS**depth)) for depth in range(height, -1, -1)]


def parent(children: str) -> bytes:
    """The digest above some children, whose digests are joined in hexadecimal."""
    return hashlib.sha256(children.encode()).digest()


def build(leaves: list[bytes], height: int) -> bytes:
    """A block over 1 to ``WAYS ** height`` leaves; what lies behind the last node is left out.

    A run of children that is cut off by the end has fewer of them, even one.
    """
    nodes = np.zeros((size(height), DIGEST), np.uint8)
    last, width = 0, 2 * DIGEST * WAYS
    level = leaves
    for places in _addresses(height):
        own = places[: len(level)]
        nodes[own] = np.frombuffer(b"".join(level), np.uint8).reshape(-1, DIGEST)
        last = max(last, int(own.max()))
        text = b"".join(level).hex()
        level = [parent(text[i : i + width]) for i in range(0, len(text), width)]
    return nodes[: last + 1].tobytes()


def siblings(nodes: bytes, height: int, n: int, places: np.ndarray) -> list[list[tuple[str, str]]]:
    """For some leaves of a block, level by level: the hexadecimal digests before and after it in its run.

    ``n`` is the number of leaves of the block.
    """
    digests = np.frombuffer(nodes, np.uint8).reshape(-1, DIGEST)
    out: list[list[tuple[str, str]]] = [[] for _ in places]
    index = np.asarray(places, np.int64)
    for level, addresses in enumerate(_addresses(height)[:-1]):
        count = -(-n // WAYS**level)
        first = index - index % WAYS
        texts = []
        for k in range(WAYS):
            there = first + k
            found = (there != index) & (there < count)
            hexes = digests[addresses[np.where(found, there, 0)]].tobytes().hex()
            texts.append([hexes[2 * DIGEST * i : 2 * DIGEST * (i + 1)] if f else "" for i, f in enumerate(found.tolist())])
        for own, at, *parts in zip(out, (index % WAYS).tolist(), *texts):
            own.append(("".join(parts[:at]), "".join(parts[at:])))
        index //= WAYS
    return out


def fold(digest: bytes, path: Sequence[tuple[str, str]]) -> bytes:
    """The root that a leaf and the siblings on its way up give."""
    for before, after in path:
        digest = parent(before + digest.hex() + after)
    return digest


def packed(path: Sequence[tuple[str, str]]) -> str:
    """A path as text: a line for each level, the digests before and after it with a blank between."""
    return "".join(f"{before} {after}\n" for before, after in path)


def unpacked(text: str) -> list[tuple[str, str]]:
    """The path that was given to ``packed``."""
    return [tuple(line.split(" ")) for line in text.split("\n")[:-1]]


def _numbered(leaves: DataFrame, tree: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``leaves`` with the task that has them and their place there, and how many each task has of each tree.

    Leaves are dealt by range of (tree, order), whatever the size of a tree, and
    each task numbers its own.  Ties in ``order`` are broken by ``_digest`` and then
    by the order in which rows are read.  ``leaves`` must be read from storage.
    The counts have ``_part``, the columns of ``tree``, ``_n`` (leaves of the tree) and
    ``_before`` (those of earlier tasks).
    """
    keys = [*tree, *order, "_digest", "_tie"]
    rows = leaves.withColumn("_tie", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")

    def run(batches):
        part, before, nth = TaskContext.get().partitionId(), None, 0
        for b in batches:
            numbers = []
            for key in zip(*(b.column(c).to_pylist() for c in tree)) if tree else [()] * b.num_rows:
                nth = nth + 1 if key == before else 0
                before = key
                numbers.append(nth)
            new = [pa.array(np.full(b.num_rows, part, np.int64)), pa.array(numbers, pa.int64())]
            yield pa.RecordBatch.from_arrays([*b.columns, *new], names=[*b.schema.names, "_part", "_nth"])

    new = [StructField("_part", LongType()), StructField("_nth", LongType())]
    numbered = stored(rows.mapInArrow(run, StructType([*leaves.schema.fields, *new])), "merkle-leaves")
    counts = stored(numbered.groupBy(*tree, "_part").agg(F.count("*").alias("_c")), "merkle-counts")
    # A row for each tree and task that has some of its leaves.
    whole = Window.partitionBy(*tree)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_c").over(earlier), F.lit(0))
    return numbered, counts.select(*tree, "_part", F.sum("_c").over(whole).alias("_n"), before.alias("_before"))


def _tier(leaves: DataFrame, tier: int, most: int) -> DataFrame:
    """The blocks over the nodes of one tier (``LEAVES``): a row for each, with its nodes and its root."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        n = rows["n"][0].as_py()
        height = min(most, levels_above(n) - tier * most)  # the root ends the last tier
        order = np.argsort(np.array(rows["place"]))
        nodes = build(rows["digest"].combine_chunks().take(pa.array(order)).to_pylist(), height)
        values = (key[0].as_py(), n, key[1].as_py(), height, nodes, nodes[:DIGEST])
        return pa.table([pa.array([v], f.type) for v, f in zip(values, _BLOCK_ARROW)], schema=_BLOCK_ARROW)

    return leaves.groupBy("tree", F.expr(f"place div {WAYS**most}")).applyInArrow(run, _BLOCK)


def manifest(leaves: DataFrame, height: int = HEIGHT) -> list[DataFrame]:
    """The stored blocks of all trees, tier by tier from the leaves.

    ``leaves`` has the columns ``LEAVES``; places of a tree run from 0 without gaps.
    Each tier has a row for each block: ``tree``, ``n`` (leaves of the whole tree),
    ``place`` of the block in its tier, ``height``, ``nodes`` in the van Emde Boas
    layout, and ``digest``, its root.  The number of tiers is the logarithm of
    the largest tree to base 2187 (with the usual height).
    """
    prepare(leaves.sparkSession)
    tiers, left = [], leaves.select(*LEAVES)
    while True:
        tiers.append(stored(_tier(left, len(tiers), height), f"merkle-tier-{len(tiers)}"))
        left = tiers[-1].where(F.col("n") > WAYS ** (height * len(tiers))).select(*LEAVES)
        if left.isEmpty():
            return tiers


def roots(tiers: list[DataFrame], height: int = HEIGHT) -> DataFrame:
    """``tree, n, digest``: the root of each tree, from the tier that holds it."""
    out = None
    for tier, blocks in enumerate(tiers):
        top = blocks.where((F.col("n") <= WAYS ** (height * (tier + 1))) & (F.col("place") == 0)).select("tree", "n", "digest")
        out = top if out is None else out.unionByName(top)
    return out


def _leaves_of_block(n: int, tier: int, place: int, height: int) -> int:
    """The leaves of a block of a tier of a tree of ``n`` leaves."""
    nodes = -(-n // WAYS ** (height * tier))
    return min(WAYS**height, nodes - place * WAYS**height)


def paths(tiers: list[DataFrame], above: DataFrame, height: int = HEIGHT) -> DataFrame:
    """The blocks of the lowest tier with ``path``, the siblings on the way from their root upwards, ``subroot`` and ``root``.

    ``above`` gives for each ``tree`` the ``path`` that follows above its root, and
    the other two.  The tiers are read from the top down; each block hands to
    those below it their way through it, a row for each block.
    """
    blocks = None
    for tier in reversed(range(len(tiers))):
        own = tiers[tier]
        topmost = F.col("n") <= WAYS ** (height * (tier + 1))
        ended = own.where(topmost).join(above.select("tree", "path", "subroot", "root"), "tree")
        if blocks is not None:
            schema = "tree long, place long, path string, subroot binary, root binary"
            ways = stored(blocks.groupBy("tree", "place").applyInArrow(_ways_down(tier + 1, height), schema), "merkle-ways")
            ended = ended.unionByName(own.where(~topmost).join(ways, ["tree", "place"]))
        blocks = ended
    return blocks


def _ways_down(tier: int, most: int):
    """For a block: the paths of the blocks below it."""

    def run(block: pa.Table) -> pa.Table:
        tree, n, place, height, nodes, path, subroot, root = (
            block[c][0].as_py() for c in ("tree", "n", "place", "height", "nodes", "path", "subroot", "root")
        )
        count = _leaves_of_block(n, tier, place, most)
        below = [packed(way) + path for way in siblings(nodes, height, count, np.arange(count))]
        first = place * WAYS**most
        columns = {
            "tree": pa.array([tree] * count, pa.int64()),
            "place": pa.array(np.arange(first, first + count)),
            "path": pa.array(below, pa.string()),
            "subroot": pa.array([subroot] * count, pa.binary()),
            "root": pa.array([root] * count, pa.binary()),
        }
        return pa.table(columns)

    return run


_PROVED = [("proof", StringType()), ("proof_sha256", StringType()), ("folded", BinaryType()), ("subroot", BinaryType()), ("root", BinaryType())]


def proofs(leaves: DataFrame, blocks: DataFrame, height: int = HEIGHT, with_proof: bool = True) -> DataFrame:
    """``leaves`` with ``proof``, ``proof_sha256``, ``folded``, ``subroot`` and ``root``.

    ``leaves`` has ``tree``, ``place`` and ``claimed``, the digest to be tested, and any
    columns besides; ``blocks`` are those of ``paths``.  A proof lists the siblings level
    by level, as in ``packed``; it is null if not ``with_proof``.  ``folded`` is the
    root that ``claimed`` gives with the siblings of its place.
    """
    names = leaves.columns

    def run(rows: pa.Table, block: pa.Table) -> pa.Table:
        made: list[tuple] = []
        if rows.num_rows:
            n, place, own_height, nodes, path, subroot, root = (
                block[c][0].as_py() for c in ("n", "place", "height", "nodes", "path", "subroot", "root")
            )
            above = unpacked(path)
            up = "".join(before + after for before, after in above)
            places = np.array(rows["place"]) - place * WAYS**height
            ways = siblings(nodes, own_height, _leaves_of_block(n, 0, place, height), places)
            for way, digest in zip(ways, rows["claimed"].to_pylist()):
                joined = "".join(before + after for before, after in way) + up
                proof = packed(way) + path if with_proof else None
                made.append((proof, hashlib.sha256(joined.encode()).hexdigest(), fold(fold(digest, way), above), subroot, root))
        columns = list(zip(*made)) if made else [[]] * len(_PROVED)
        new = [pa.array(c, pa.string() if isinstance(kind, StringType) else pa.binary()) for c, (_, kind) in zip(columns, _PROVED)]
        return pa.Table.from_arrays([*(rows[c].combine_chunks() for c in names), *new], names=[*names, *(n for n, _ in _PROVED)])

    schema = StructType([*leaves.schema.fields, *(StructField(n, kind) for n, kind in _PROVED)])
    block = F.expr(f"place div {WAYS**height}")
    return leaves.groupBy("tree", block).cogroup(blocks.groupBy("tree", "place")).applyInArrow(run, schema)


def field(value: Column) -> Column:
    """A value in the input of a leaf: its UTF-8 byte count, a colon and itself, or ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(docs: DataFrame, columns: Sequence[str], **changed: Column) -> Column:
    """The digest of a row over some columns, of which some may be ``changed``."""
    values = [changed[c] if c in changed else docs[c] for c in columns]
    return F.unhex(F.sha2(F.concat(*map(field, values)), 256))


@dataclass
class Manifest:
    """The stored tables of a dataset's manifest.

    ``leaves``: ``id``, ``tree``, ``n``, ``place``, ``digest``, ``claimed``.  ``tops``, a row for each
    tree: ``tree``, its value ``key``, ``n``, ``digest`` (its root), ``place`` and ``n_trees``.
    ``tiers`` are the blocks of the trees, ``upper`` those of the tree above.
    """

    leaves: DataFrame
    tops: DataFrame
    tiers: list[DataFrame]
    upper: list[DataFrame]
    height: int


def dataset_manifest(
    docs: DataFrame, columns: Sequence[str], id_col: str = "doc_id", tree_col: str = "source", claimed: Column | None = None, height: int = HEIGHT
) -> Manifest:
    """The manifest of ``docs``, whose leaves are the SHA-256 of the named columns of each row.

    Each value of ``tree_col``, null included, is a tree over its leaves in order of
    ``id_col``, null first; rows that repeat an id are ordered by their digest,
    then as they are read, and are leaves of their own.  The roots, in order of
    ``tree_col``, null first, are the leaves of the tree above.  ``claimed`` are
    the digests to test later, by default the leaves themselves.  An empty table
    gives empty tables.  Columns of ``docs`` that are not named play no part,
    whatever their names.
    """
    prepare(docs.sparkSession)
    digest = leaf(docs, columns)
    rows = docs.select(
        docs[id_col].alias("_id"), docs[tree_col].alias("_key"), digest.alias("_digest"), (digest if claimed is None else claimed).alias("_claimed")
    )
    # Only digests travel from here on; the texts are read once.
    numbered, counts = _numbered(stored(rows, "merkle-digests"), ["_key"], ["_id"])
    keys = stored(counts.groupBy("_key").agg(F.first("_n").alias("_size")).withColumn("_digest", F.lit(b"")), "merkle-keys")
    keys, parts = _numbered(keys, [], ["_key"])
    keys = keys.join(parts, "_part").select(
        F.col("_key").alias("key"), (F.col("_before") + F.col("_nth")).alias("tree"), F.col("_n").alias("n_trees")
    )
    keys = stored(keys, "merkle-trees")
    counts = counts.join(keys, counts["_key"].eqNullSafe(keys["key"])).select(F.col("_part").alias("_in"), "key", "tree", "_n", "_before")
    leaves = numbered.join(counts, (F.col("_part") == F.col("_in")) & F.col("_key").eqNullSafe(F.col("key"))).select(
        F.col("_id").alias("id"), "tree", F.col("_n").alias("n"), (F.col("_before") + F.col("_nth")).alias("place"),
        F.col("_digest").alias("digest"), F.col("_claimed").alias("claimed"),
    )
    leaves = stored(leaves, "merkle-places")
    tiers = manifest(leaves, height)
    tops = stored(roots(tiers, height).join(keys, "tree").withColumn("place", F.col("tree")), "merkle-roots")
    upper = manifest(tops.select(F.lit(0).cast("long").alias("tree"), F.col("n_trees").alias("n"), "place", "digest"), height)
    return Manifest(leaves, tops, tiers, upper, height)


def verified_leaves(made: Manifest, with_proof: bool = True) -> DataFrame:
    """The leaves of a manifest with the columns of ``proofs`` and ``verified``: whether ``folded`` is the root."""
    nothing = (F.lit("").alias("path"), F.lit(None).cast("binary").alias("subroot"))
    above = roots(made.upper, made.height).select("tree", *nothing, F.col("digest").alias("root"))
    ends = made.tops.select(F.lit(0).cast("long").alias("tree"), "place", F.col("digest").alias("claimed"), F.col("tree").alias("of"))
    ends = proofs(ends, paths(made.upper, above, made.height), made.height)
    ends = stored(ends.select(F.col("of").alias("tree"), F.col("proof").alias("path"), F.col("claimed").alias("subroot"), "root"), "merkle-ends")
    leaves = proofs(made.leaves, paths(made.tiers, ends, made.height), made.height, with_proof)
    return leaves.withColumn("verified", F.col("folded") == F.col("root"))


#: The columns of a leaf, in order.
DOCUMENT = ["doc_id", "source", "lang", "n_chars", "text"]


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The proof of every document, tested against a copy of which some texts lack their line ends."""
    docs = table(spark, sf_dir, "documents")
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(even, F.translate("text", "\n", "")).otherwise(F.col("text"))
    made = verified_leaves(dataset_manifest(docs, DOCUMENT, claimed=leaf(docs, DOCUMENT, text=tampered)), with_proof=False)
    hexed = [F.lower(F.hex(a)).alias(b) for a, b in (("digest", "leaf"), ("subroot", "subroot"), ("root", "root"), ("folded", "folded_root"))]
    return made.select(F.col("id").alias("doc_id"), "proof_sha256", *hexed, "verified")


#: The trees level by level, then the tree above them, then each leaf's way up in both.  The checksum's steps are those of
#: crc32, a bit at a time: a byte is added, or (-1) the register shifted.
OP11_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id, text, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
         replace(text, chr(10), '') AS cut,
         list_concat([4294967295], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                                                          lambda c: [CAST(ord(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))) AS steps
  FROM documents
), leaves AS (
  SELECT r, doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS h,
         sha256(head || coalesce(strlen(cut) || ':' || cut, '-')) AS h_cut,
         (4294967295 - list_reduce(steps, lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END)) % 2 = 0 AS even
  FROM docs
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM leaves
), nodes(tree, lvl, i, n, h) AS (
  SELECT tree, 0, i, n, h FROM ranked
  UNION ALL
  SELECT tree, lvl + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY tree, lvl, i // 3, n
), subroots AS (
  SELECT tree, lvl, h, count(*) OVER () AS n FROM nodes WHERE n = 1
), above(lvl, i, n, h) AS (
  SELECT 0, tree, n, h FROM subroots
  UNION ALL
  SELECT lvl + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM above WHERE n > 1 GROUP BY lvl, i // 3, n
), inside(r, tree, lvl, i, proof, folded) AS (
  SELECT r, tree, 0, i, '', CASE WHEN even THEN h_cut ELSE h END FROM ranked
  UNION ALL
  SELECT w.r, w.tree, w.lvl + 1, w.i // 3, w.proof || string_agg(CASE WHEN e.i = w.i THEN '' ELSE e.h END, '' ORDER BY e.i),
         sha256(string_agg(CASE WHEN e.i = w.i THEN w.folded ELSE e.h END, '' ORDER BY e.i))
  FROM inside w JOIN nodes e ON e.tree = w.tree AND e.lvl = w.lvl AND e.i // 3 = w.i // 3 AND e.n > 1
  GROUP BY w.r, w.tree, w.lvl, w.i, w.proof, w.folded
), upward(r, tree, lvl, i, proof, folded) AS (
  SELECT w.r, w.tree, 0, w.tree, w.proof, w.folded FROM inside w JOIN subroots s ON s.tree = w.tree AND s.lvl = w.lvl
  UNION ALL
  SELECT w.r, w.tree, w.lvl + 1, w.i // 3, w.proof || string_agg(CASE WHEN e.i = w.i THEN '' ELSE e.h END, '' ORDER BY e.i),
         sha256(string_agg(CASE WHEN e.i = w.i THEN w.folded ELSE e.h END, '' ORDER BY e.i))
  FROM upward w JOIN above e ON e.lvl = w.lvl AND e.i // 3 = w.i // 3 AND e.n > 1
  GROUP BY w.r, w.tree, w.lvl, w.i, w.proof, w.folded
)
SELECT d.doc_id, d.h AS leaf, s.h AS subroot, a.h AS root, sha256(w.proof) AS proof_sha256, w.folded AS folded_root, w.folded = a.h AS verified
FROM ranked d JOIN subroots s USING (tree) JOIN (SELECT lvl, h FROM above WHERE n = 1) a ON true
JOIN upward w ON w.r = d.r AND w.lvl = a.lvl
"""
