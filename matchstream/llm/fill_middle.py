"""Fill-in-the-middle transformation by displacement scatter.

All texts of a batch lie in one byte array.  A scan finds the tokens and the
two cuts of each text.  A difference array then holds, at the first byte of each
prefix, middle and suffix, by how much its displacement differs from that of the
part before; the cumulative sum gives every byte of the batch its shift, and one
scatter writes all outputs.  Restoring finds the control strings in the output,
builds the difference array of the way back, and gathers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from matchstream.llm.common import CHUNK_BYTES, pieces, prepare, table, utf8

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Names of the forms: untouched, prefix-suffix-middle, suffix-prefix-middle.
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Texts in a hundred that are transformed, and of these the ones in spm form.
TRANSFORMED, AS_SPM = 90, 20

RESULT = StructType(
    [
        StructField("n", LongType()),
        StructField("form", StringType()),
        StructField("prefix_chars", LongType()),
        StructField("middle_chars", LongType()),
        StructField("output", StringType()),
    ]
)


def draws(doc_id: int | None, seed: str) -> tuple[int, int, int, int]:
    """Four 32-bit numbers of a document; a null id draws as an empty one."""
    text = f"{seed}:{'' if doc_id is None else doc_id}"
    digest = hashlib.sha256(text.encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array, and where each starts; one bound more than texts."""
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), bounds


def _token_starts(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a byte starts a character, and whether it starts a token: a run of ASCII letters, or any other character."""
    char = (data & 0xC0) != 0x80
    lower = data | 0x20
    letter = (lower >= ord("a")) & (lower <= ord("z"))
    token = char.copy()
    token[1:] &= ~(letter[1:] & letter[:-1])
    starts = bounds[:-1]
    token[starts[starts < len(data)]] |= char[starts[starts < len(data)]]  # a text's first letter continues no run
    return char, token


def _controls(data: np.ndarray, mark: bytes) -> np.ndarray:
    """Where a control string of three bytes starts."""
    if len(data) < 3:
        return np.zeros(0, np.int64)
    return np.flatnonzero((data[:-2] == mark[0]) & (data[1:-1] == mark[1]) & (data[2:] == mark[2]))


def _holds(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Which texts hold a control string; one that lies across two texts counts for neither."""
    found = np.zeros(len(bounds) - 1, bool)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        at = _controls(data, mark)
        first, last = (np.searchsorted(bounds, p, side="right") - 1 for p in (at, at + 2))
        found[first[first == last]] = True
    return found


def _moved(size: int, starts: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """The target of each of ``size`` elements, of which runs begin at sorted ``starts`` and go to ``targets``.

    Of runs with the same start all but the last are empty.
    """
    shift = targets - starts
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, starts, np.diff(shift, prepend=0))
    return np.arange(size, dtype=np.int64) + np.cumsum(change[:size])


def transform(texts: list[bytes], numbers: np.ndarray) -> tuple[np.ndarray, ...]:
    """Outputs of a batch: bytes, bounds, tokens, form (0 plain, 1 psm, 2 spm), characters of prefix and of middle.

    ``numbers`` has four columns for each text: two cuts, the draw between plain
    and transformed, and the draw between psm and spm.
    """
    data, bounds = _joined(texts)
    starts, ends = bounds[:-1], bounds[1:]
    char, token = _token_starts(data, bounds)
    places = np.append(np.flatnonzero(token), len(data))
    first = np.searchsorted(places, starts)
    n = np.searchsorted(places, ends) - first
    n[starts == ends] = 0
    cuts = np.sort(numbers[:, :2] % (n + 1)[:, None], axis=1)
    # The token after a text's last one starts where the text ends.
    left, right = (np.minimum(places[np.minimum(first + cuts[:, k], len(places) - 1)], ends) for k in (0, 1))
    form = np.where(numbers[:, 3] % 100 < AS_SPM, 2, 1)
    form[(starts == ends) | _holds(data, bounds) | (numbers[:, 2] % 100 >= TRANSFORMED)] = 0
    left, right = np.where(form == 0, ends, left), np.where(form == 0, ends, right)

    sizes = ends - starts + np.where(form == 0, 0, 9)
    out_bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    at = out_bounds[:-1]
    suffix = ends - right
    # Where the parts go: <P>prefix<S>suffix<M>middle, or <S>suffix<P>prefix<M>middle.
    to_prefix = np.select([form == 1, form == 2], [at + 3, at + 6 + suffix], at)
    to_suffix = np.select([form == 1, form == 2], [at + 6 + left - starts, at + 3], at + ends - starts)
    to_middle = np.where(form == 0, at + ends - starts, at + 9 + left - starts + suffix)
    runs = np.stack([starts, left, right], axis=1).reshape(-1)
    targets = np.stack([to_prefix, to_middle, to_suffix], axis=1).reshape(-1)
    out = np.zeros(int(out_bounds[-1]), np.uint8)
    out[_moved(len(data), runs, targets)] = data
    made = form > 0
    for mark, where in ((PREFIX, to_prefix), (SUFFIX, to_suffix), (MIDDLE, to_middle)):
        for k in range(3):
            out[where[made] - 3 + k] = mark[k]
    chars = np.concatenate([[0], np.cumsum(char)]).astype(np.int64)
    return out, out_bounds, n, form, chars[left] - chars[starts], chars[right] - chars[left]


def restore(outputs: list[bytes], forms: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The texts that ``transform`` was given, from outputs and forms: bytes and bounds."""
    data, bounds = _joined(outputs)
    starts, ends = bounds[:-1], bounds[1:]
    form = np.array([{PSM: 1, SPM: 2}.get(f, 0) for f in forms], np.int64)
    made = np.flatnonzero(form)
    places = []
    for mark in (PREFIX, SUFFIX, MIDDLE):
        at = _controls(data, mark)
        place = ends.copy()
        # A transformed text holds each string once; the first at or after its start is it.
        place[made] = at[np.searchsorted(at, starts[made])] if len(made) else 0
        places.append(place)
    p, s, m = places
    plain = form == 0
    from_prefix = np.where(plain, starts, p + 3)
    from_middle = np.where(plain, ends, m + 3)
    from_suffix = np.where(plain, ends, s + 3)
    prefix = np.select([form == 1, form == 2], [s, m], ends) - from_prefix
    middle = np.where(plain, 0, ends - from_middle)
    suffix = np.select([form == 1, form == 2], [m, p], ends) - from_suffix
    sizes = np.stack([prefix, middle, suffix], axis=1).reshape(-1)
    runs = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    sources = np.stack([from_prefix, from_middle, from_suffix], axis=1).reshape(-1)
    back = data[_moved(int(runs[-1]), runs[:-1], sources)]
    return back, runs[::3].copy()


def _strings(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """An Arrow string column over the bytes of an array."""
    return pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(data)).cast(pa.string())


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text: str = "text", seed: str = "1") -> DataFrame:
    """``docs`` without its text, with ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    A token is a run of ASCII letters or any other code point; ``n`` counts
    them.  Cuts and form follow from the SHA-256 of ``seed:id``, so rows that
    repeat an id are cut by the same numbers, and a null id draws as an empty
    one.  Null counts as an empty text; empty texts and those that hold a control
    string stay plain, with null ``prefix_chars`` and ``middle_chars``.  A text
    is one record, whatever its length.  Columns of ``docs`` that have one of the
    new names are replaced.
    """
    prepare(docs.sparkSession)
    kept = [f for f in docs.schema.fields if f.name != text and f.name.lower() not in RESULT.names]
    others = [f.name for f in kept]
    lean = docs.select(*others, F.col(id_col), F.col(text))  # both are read by their places

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([PLAIN, PSM, SPM])
        for whole in batches:
            bodies = utf8(whole.column(len(others) + 1))
            for i, j in pieces([len(x) for x in bodies], CHUNK_BYTES):
                b = whole.slice(i, j - i)
                numbers = np.array([draws(x, seed) for x in b.column(len(others)).to_pylist()], np.int64).reshape(-1, 4)
                out, bounds, n, form, prefix, middle = transform(bodies[i:j], numbers)
                new = [pa.array(n), pa.array(names[form].tolist(), pa.string())]
                new += [pa.array(c, mask=form == 0) for c in (prefix, middle)]
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[: len(others)], *new, _strings(out, bounds)], names=[*others, *RESULT.names]
                )

    return lean.mapInArrow(run, StructType(kept + RESULT.fields))


def restored(made: DataFrame, output: str = "output", form: str = "form", name: str = "restored") -> DataFrame:
    """``made`` with the texts rebuilt from output and form in the new last column ``name``.

    A null output gives an empty text, a null form counts as plain.  A column of
    ``made`` that has the new name is replaced.
    """
    prepare(made.sparkSession)
    kept = [f for f in made.schema.fields if f.name.lower() != name.lower()]
    others = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            outputs, forms = utf8(whole.column(output)), whole.column(form).to_pylist()
            for i, j in pieces([len(x) for x in outputs], CHUNK_BYTES):
                b = whole.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c) for c in others), _strings(*restore(outputs[i:j], forms[i:j]))], names=[*others, name]
                )

    return made.select(*others).mapInArrow(run, StructType([*kept, StructField(name, StringType())]))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document transformed, and rebuilt from what came out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return restored(fill_in_middle(docs)).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


OP13_SQL = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS tokens,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), numbers AS (
  SELECT *, len(tokens) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM cut
), parts AS (
  SELECT doc_id, text, n,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
              THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(tokens[1:least(h1 % (n + 1), h2 % (n + 1))], '') AS prefix,
         array_to_string(tokens[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], '') AS middle,
         array_to_string(tokens[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:n], '') AS suffix
  FROM numbers
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
