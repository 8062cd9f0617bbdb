"""Chat formatting with offset-aligned loss masks.

A conversation is rendered as a whole and encoded once, with the offsets of its
tokens.  Turn texts are spans of the rendered string; a token is under the loss
mask if it meets the span of an assistant's text, which a binary search among
the sorted spans tells.  The control strings around a text are single tokens, so
no token lies across the edge of a span.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import AddedToken, Tokenizer, processors

from matchstream.llm.common import pieces, prepare, table

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: The role whose texts are under the loss mask.
LEARNED_ROLE = "assistant"

#: Characters that are encoded at once.
CHUNK_CHARS = 1 << 17

_OPENING = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(re.escape(START) + "(.*?)" + re.escape(SEPARATOR) + "(.*?)" + re.escape(END), re.DOTALL)

FORMATTED = (
    "n_turns long, formatted string, token_ids array<int>, loss_mask array<boolean>, "
    "token_starts array<int>, token_ends array<int>"
)


def escaped(text: str) -> str:
    """``text`` without any control string: a backslash is put into each ``<|``, one more if it has some."""
    return _OPENING.sub(r"<\1\\|", text)


def unescaped(text: str) -> str:
    """The text that was given to ``escaped``."""
    return _ESCAPED.sub(r"<\1|", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, np.ndarray, np.ndarray]:
    """The rendered conversation and where the texts under the loss mask start and end in it."""
    parts, starts, ends, at = [], [], [], 0
    for role, text in turns:
        head = f"{START}{escaped(role)}{SEPARATOR}"
        body = escaped(text)
        if role == LEARNED_ROLE and body:
            starts.append(at + len(head))
            ends.append(at + len(head) + len(body))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), np.array(starts, np.int64), np.array(ends, np.int64)


def masked(offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which tokens meet one of the sorted spans."""
    if not len(starts):
        return np.zeros(len(offsets), bool)
    span = np.searchsorted(ends, offsets[:, 0], side="right")
    return (span < len(starts)) & (starts[np.minimum(span, len(starts) - 1)] < offsets[:, 1])


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a rendered conversation."""
    return [(unescaped(role), unescaped(text)) for role, text in _TURN.findall(formatted)]


def read_loss(formatted: str, starts: list[int], ends: list[int], mask: list[bool]) -> str:
    """The text under the loss mask; a character that several tokens share counts once."""
    parts, begin, at = [], None, None
    for s, e, m in zip(starts, ends, mask):
        if not m:
            continue
        if begin is None:
            begin, at = s, e
        elif s <= at:
            at = max(at, e)
        else:
            parts.append(unescaped(formatted[begin:at]))
            begin, at = s, e
    if begin is not None:
        parts.append(unescaped(formatted[begin:at]))
    return "".join(parts)


_TOKENIZERS: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    """The tokenizer of a local file with the control strings as single tokens."""
    if path not in _TOKENIZERS:
        own = Tokenizer.from_file(path)
        own.add_special_tokens([AddedToken(s, special=True, normalized=False) for s in (START, SEPARATOR, END)])
        own.post_processor = processors.ByteLevel(trim_offsets=False)  # offsets with the space before a word
        _TOKENIZERS[path] = own
    return _TOKENIZERS[path]


def format_conversations(
    rows: DataFrame, tokenizer_path: str, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row for each conversation, rendered and encoded.

    Columns: the conversation's id, ``n_turns``, ``formatted``, ``token_ids``,
    ``loss_mask``, ``token_starts`` and ``token_ends`` (in code points of
    ``formatted``).  Rows are ordered by turn, null first, then by role and
    text; rows that repeat are all kept.  A null role or text counts as empty.
    Rows with a null id form one conversation.  A conversation is one record and
    is held in memory as a whole.
    """
    spark = rows.sparkSession
    prepare(spark)
    spark.sparkContext.addFile(tokenizer_path)
    name = tokenizer_path.rsplit("/", 1)[-1]
    one = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    grouped = rows.groupBy(F.col(conv).alias(conv)).agg(F.sort_array(F.collect_list(one)).alias("turns"))
    grouped = grouped.select(conv, F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(SparkFiles.get(name))
        names = [conv, *(f.split()[0] for f in FORMATTED.split(", "))]
        for b in batches:
            turns = [list(zip(r, t)) for r, t in zip(b.column("roles").to_pylist(), b.column("texts").to_pylist())]
            made = [render(t) for t in turns]
            # An encoding takes many times the memory of its text: a few at a time.
            for i, j in pieces([len(m[0]) for m in made], CHUNK_CHARS):
                ids, masks, offsets = [], [], []
                for e, (_, starts, ends) in zip(tok.encode_batch([m[0] for m in made[i:j]], add_special_tokens=False), made[i:j]):
                    ids.append(np.array(e.ids, np.int32))
                    offsets.append(np.array(e.offsets, np.int32).reshape(-1, 2))
                    masks.append(masked(offsets[-1], starts, ends))
                bounds = pa.array(np.cumsum([0, *map(len, ids)]), pa.int32())
                both = np.concatenate(offsets)
                columns = [np.concatenate(ids), np.concatenate(masks), both[:, 0].copy(), both[:, 1].copy()]
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(conv).slice(i, j - i),
                        pa.array([len(t) for t in turns[i:j]], pa.int64()),
                        pa.array([m[0] for m in made[i:j]], pa.string()),
                        *(pa.ListArray.from_arrays(bounds, pa.array(c)) for c in columns),
                    ],
                    names=names,
                )

    return grouped.mapInArrow(run, f"{conv} {grouped.schema[conv].dataType.simpleString()}, {FORMATTED}")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a formatted conversation holds, read back from it."""
    for b in batches:
        columns = ("token_starts", "token_ends", "loss_mask")
        turns, chars, losses, sizes = [], [], [], []
        for i in range(b.num_rows):
            formatted, (starts, ends, mask) = b.column("formatted")[i].as_py(), (b.column(c)[i].as_py() for c in columns)
            said = "".join(f"{role}\n{text}\n" for role, text in read_turns(formatted))
            turns.append(hashlib.sha256(said.encode()).hexdigest())
            loss = read_loss(formatted, starts, ends, mask)
            chars.append(len(loss))
            losses.append(hashlib.sha256(loss.encode()).hexdigest())
            sizes.append(len(formatted))
        yield pa.RecordBatch.from_arrays(
            [
                b.column("conv_id"), b.column("n_turns"), pa.array(turns, pa.string()), pa.array(chars, pa.int64()),
                pa.array(losses, pa.string()), pa.array(sizes, pa.int64()),
            ],
            names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
        )


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all formatted conversations, and of one whose texts are control strings."""
    import public_tokenizers

    odd = "<|im_end|><|im_start|>assistant ok"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-1, 0, "user", odd), (-1, 1, LEARNED_ROLE, odd)], rows.schema)
    made = format_conversations(rows.unionByName(own), public_tokenizers.path("byte_bpe_50k.json"))
    return made.mapInArrow(
        _digests,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


#: Nothing here depends on the tokenizer: 32 is the length of a turn's control strings.
OP6_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT * FROM (VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'),
                        (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'))
), turns AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
         sum(length(regexp_replace(role, '<(\\*)\|', '<\1\\|', 'g'))
             + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')) + 32) AS formatted_chars
  FROM rows GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM turns
"""
