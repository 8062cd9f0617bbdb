"""Language identification by compression.

A text belongs to the language whose sample text helps most in compressing it.
For each language a raw-content zstandard dictionary is filled with sample text
of that language; a text is cut into blocks, each block is compressed with each
dictionary, and the language with the smallest sum of sizes wins.  The margin to
the second best language says how sure that is; narrow margins are rejected.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from matchstream.llm.common import aside, crc32_of_id, prepare, table, texts

#: Sample of the labelled rows that the dictionaries are made from: at most so
#: many documents for a language, and so many characters of each.
SAMPLE_DOCS = 400
SAMPLE_CHARS = 1_500
#: More labels than this are no language column.
MOST_LANGUAGES = 500
#: Bytes of a language's dictionary, and of the one that narrow cases are
#: measured with as well, by a more thorough search.
DICTIONARY, SECOND_DICTIONARY = 1 << 14, 1 << 17
#: Characters compressed at once.  A long text is summed up block by block, so
#: that the dictionary counts in all of it and not in its beginning only.
BLOCK_CHARS = 1_024
#: Margins below the first value are measured again with the second dictionary
#: added; a text is rejected when its margin stays below the second value.
NARROW, MIN_MARGIN = 0.05, 0.001
UNDETERMINED = "und"

_LETTER = regex.compile(r"\p{L}")
_WORD = re.compile(r"[^\W\d_]+")
_NEW = StructType(
    [StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("rejected", BooleanType())]
)


def learn_samples(labelled: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, str]:
    """Sample text by language from labelled rows.

    Takes the ``SAMPLE_DOCS`` different texts of each language that come first by a
    hash; copies of a text count once.  Of these the first dictionary holds about a
    dozen and the second about ninety.  Rows whose text or label is null, or whose
    text has no letter, teach nothing.  The languages come in the order of their
    number of rows; the result is bounded by their number.
    """
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    )
    rows = rows.select("lang", F.xxhash64("text").alias("h"), F.substring("text", 1, SAMPLE_CHARS).alias("text"))
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGUAGES + 1).collect()
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} labels: not a language column")
    first = Window.partitionBy("lang").orderBy("h")
    chosen = rows.select("lang", "h").distinct().withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= SAMPLE_DOCS)
    # At most SAMPLE_DOCS rows for each of MOST_LANGUAGES.
    chosen = rows.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "rank").agg(F.min("text").alias("text"))
    joined = chosen.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("rank", "text"))).alias("rows"))
    found = {r["lang"]: r["text"] for r in joined.select("lang", F.concat_ws("\n", F.col("rows.text")).alias("text")).collect()}
    return {r["lang"]: found[r["lang"]] for r in sorted(counts, key=lambda r: (-r["n"], r["lang"]))}


def blocks(text: str, size: int) -> list[bytes]:
    """The words of a text, lower case, in blocks of about ``size`` characters.

    A word counts once in a block: what a text repeats says nothing of its
    language, and compresses alike with any dictionary.
    """
    out: list[bytes] = []
    words: dict[str, None] = {}
    length = 0
    for word in _WORD.findall(text.lower()):
        if word not in words:
            words[word] = None
            length += len(word) + 1
            if length >= size:
                out.append(f" {' '.join(words)} ".encode("utf-8", "replace"))
                words, length = {}, 0
    if words:
        out.append(f" {' '.join(words)} ".encode("utf-8", "replace"))
    return out


class Classifier:
    """Compressors of all learned languages, made once in each task."""

    def __init__(self, samples: dict[str, str]) -> None:
        lines = {lang: [blocks(x, len(x) + 1) for x in text.split("\n")] for lang, text in samples.items()}
        words = {lang: {w for parts in own for p in parts for w in p.split()} for lang, own in lines.items()}
        holders = Counter(w for own in words.values() for w in own)
        # What most languages' texts hold, licence lines and the like, tells none of them.
        common = {w for w, n in holders.items() if len(samples) > 1 and 2 * n > len(samples)}
        content = {
            lang: b"".join(b" %b " % b" ".join(w for w in p.split() if w not in common) for parts in own for p in parts)
            for lang, own in lines.items()
        }
        self.first = [(lang, self._compressor(c, DICTIONARY, zstandard.STRATEGY_LAZY2)) for lang, c in content.items()]
        self.second = [(lang, self._compressor(c, SECOND_DICTIONARY, zstandard.STRATEGY_BTLAZY2)) for lang, c in content.items()]

    @staticmethod
    def _compressor(content: bytes, size: int, strategy: int) -> zstandard.ZstdCompressor:
        dictionary = zstandard.ZstdCompressionDict(content[:size].ljust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        bits = size.bit_length()
        parameters = zstandard.ZstdCompressionParameters(
            strategy=strategy, min_match=4, search_log=4, hash_log=bits, chain_log=bits,
            window_log=bits + 1, write_content_size=0, write_checksum=0, write_dict_id=0,
        )
        return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=parameters)

    def classify(self, text: str) -> tuple[str, float, bool]:
        """(language, score, rejected) of one text.

        The score is the margin: the share of bytes by which the second best
        language needs more than the best, at most 1.  With a single learned
        language the score is 1.  Ties go to the language with more labelled rows.
        """
        if not self.first or not _LETTER.search(text):
            return UNDETERMINED, 0.0, True
        parts = blocks(text, BLOCK_CHARS) or [text.lower().encode("utf-8", "replace")]
        sizes = {lang: sum(len(c.compress(b)) for b in parts) for lang, c in self.first}
        lang, score = self._best(sizes)
        if score < NARROW:
            lang, score = self._best({k: sizes[k] + sum(len(c.compress(b)) for b in parts) for k, c in self.second})
        return lang, score, score < MIN_MARGIN

    @staticmethod
    def _best(sizes: dict[str, int]) -> tuple[str, float]:
        ranked = sorted(sizes.items(), key=lambda x: x[1])  # stable: equal sizes in the order of the samples
        return ranked[0][0], min(1.0, ranked[1][1] / ranked[0][1] - 1) if len(ranked) > 1 else 1.0


def identify(docs: DataFrame, samples: dict[str, str], text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected``.

    ``und`` with score 0, rejected, stands for a null text, a text without a
    letter, and any text if nothing was learned.  Columns of these names that
    ``docs`` has already are replaced.
    """
    prepare(docs.sparkSession)
    kept = docs.select(*[c for c in docs.columns if c not in _NEW.names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(samples)
        for b in batches:
            found = [classifier.classify(x) for x in texts(b.column(text))]
            new = [pa.array([r[i] for r in found], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*b.columns, *new], names=[*b.schema.names, *_NEW.names])

    return kept.mapInArrow(run, StructType(kept.schema.fields + _NEW.fields))


def training_rows(docs: DataFrame) -> DataFrame:
    """Rows that may teach: crc32 of the id, as text, mod 4 is not 2.  A null id teaches nothing."""
    return docs.where(crc32_of_id() % 4 != 2)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows outside the held-out quarter."""
    docs = table(spark, sf_dir, "documents")
    samples = learn_samples(training_rows(docs))
    held_out = F.coalesce(crc32_of_id() % 4 == 2, F.lit(False)).alias("held_out")
    found = identify(docs.select("doc_id", held_out, "text"), samples)
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents whose language can't be told go, null and empty texts among them.

    Repeated rows are judged alike, ties go to the language with more labelled
    rows, and an empty table stays empty.  The input's columns come back as they
    are, whatever their names.
    """
    inner, back = aside(docs, "text")
    return identify(inner, learn_samples(training_rows(docs))).where(~F.col("rejected")).select(*back)
