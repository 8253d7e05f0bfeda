"""Operator 9: quality rules combined by weak supervision.

Each rule looks at a count of the whole text and votes good or bad or abstains.
The number of documents with each pattern of votes, over all documents, gives
the rules' reliabilities by expectation-maximisation, and a document is kept
when its posterior probability of being good reaches ``KEEP`` and it doesn't fail
the two base limits (words, repeated words).

Words are runs of characters other than ASCII white space.  A null text has no
words: every count is 0 and it fails.  A text of any length is counted whole.
Repeated rows get equal verdicts; an empty table gives no rows; further columns of
any name and type pass through untouched.  With equal odds (0.5) a document stays.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common, weak

LEAST_WORDS, MOST_REPEATED, KEEP = 50, 50, 0.5

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_marks", "n_plain_words")

_SPACE = " \t\n\v\f\r"
_SYMBOLS = "#*$%&|<>"
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_LETTERS = _UPPER + bytes(range(ord("a"), ord("z") + 1)) + bytes(range(128, 256))
_MARKS = b"!?"


def counted(text: str) -> tuple[int, ...]:
    """``COUNTS`` of a text."""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    repeated = 0
    if n > 2:
        # Words as numbers: a window is three of them, an array of windows takes 24 bytes for each word.
        number: dict[bytes, int] = {}
        ids = np.fromiter((number.setdefault(word, len(number)) for word in words), np.int64, n)
        windows = np.stack([ids[:-2], ids[1:-1], ids[2:]], axis=1)
        order = np.lexsort(windows.T)
        same = np.flatnonzero((windows[order[1:]] == windows[order[:-1]]).all(axis=1))
        if len(same):
            again = np.zeros(n, bool)
            for shift in range(3):
                again[order[same] + shift] = again[order[same + 1] + shift] = True
            repeated = int(again.sum())
    lines = Counter(line for line in text.split("\n") if line.strip(_SPACE))
    n_lines = sum(lines.values())
    without = lambda drop: len(raw) - len(raw.translate(None, drop))
    return (
        n, len(text) - sum(map(text.count, _SPACE)), sum(map(text.count, _SYMBOLS)), n_lines - len(lines), repeated,
        n_lines, without(_UPPER), without(_LETTERS), without(_MARKS),
        sum(word.strip(b".,;:!?\"'()").isalpha() or max(word) > 127 for word in words),
    )


def with_counts(df: DataFrame) -> DataFrame:
    """``row`` (all columns of ``df``, whatever their names) and ``counts`` (``COUNTS`` of its text)."""
    common.small_batches(df.sparkSession)
    inside = df.select(common.row_of(df).alias("row"), common.text_of().alias("body"))
    struct = pa.struct([(c, pa.int64()) for c in COUNTS])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = [counted(text.as_py()) for text in batch.column(1)]
            columns = [pa.array(column, pa.int64()) for column in zip(*each)] or [pa.array([], pa.int64())] * len(COUNTS)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.StructArray.from_arrays(columns, fields=list(struct))], ["row", "counts"])

    kinds = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])
    return inside.mapInArrow(count, T.StructType([T.StructField("row", inside.schema["row"].dataType), T.StructField("counts", kinds)]))


def votes(c: Column) -> dict[str, Column]:
    """The rules: 1 for good, -1 for bad, 0 abstains."""
    words, letters = F.greatest(c["n_words"], F.lit(1)), F.greatest(c["n_letters"], F.lit(1))

    def ratio(value: Column, bad: float, good: float) -> Column:
        """Bad from ``bad`` on, good up to ``good``."""
        return F.when(value >= bad, -1).when(value <= good, 1).otherwise(0)

    mean_length = c["word_chars"] / words
    return {
        "words": F.when(c["n_words"] < LEAST_WORDS, -1).when(c["n_words"] >= 2 * LEAST_WORDS, 1).otherwise(0),
        "word_length": F.when((mean_length < 2.5) | (mean_length > 12), -1).when(mean_length.between(3, 10), 1).otherwise(0),
        "symbols": ratio(c["n_symbols"] / words, 0.1, 0.02),
        "lines": ratio(c["n_dup_lines"] / F.greatest(c["n_lines"], F.lit(1)), 0.3, 0.1),
        "repeats": ratio(c["n_repeat_words"] / words, 0.3, 0.1),
        "upper": ratio(c["n_upper"] / letters, 0.3, 0.1),
        "marks": ratio(c["n_marks"] / words, 0.2, 0.05),
        "plain": ratio(1 - c["n_plain_words"] / words, 0.4, 0.15),
    }


def base_failed(c: Column) -> Column:
    return (c["n_words"] < LEAST_WORDS) | (100 * c["n_repeat_words"] > MOST_REPEATED * c["n_words"])


def fitted(counted_df: DataFrame) -> weak.Model:
    """Reliabilities from all rows of a table with ``counts``."""
    rules = votes(F.col("counts"))
    return weak.fit(weak.pattern_counts(counted_df, rules), len(rules))


def with_verdict(counted_df: DataFrame, model: weak.Model) -> DataFrame:
    """Adds ``p_good`` (probability of being good), ``base_failed`` and ``kept``."""
    c = F.col("counts")
    fails, good = base_failed(c), model.posterior(list(votes(c).values()))
    return counted_df.select("*", good.alias("p_good"), fails.alias("base_failed"), (~fails & (good >= KEEP)).alias("kept"))


def judged(df: DataFrame) -> DataFrame:
    """``row`` (a struct of all columns of ``df``) with ``counts`` and the verdict.  Texts are counted twice, and never shuffled or written."""
    return with_verdict(with_counts(df), fitted(with_counts(df.select("text"))))


def kept_rows(df: DataFrame) -> DataFrame:
    """The rows of ``df`` that are kept."""
    return judged(df).where("kept").select("row.*")


def scored(df: DataFrame) -> DataFrame:
    """doc_id, ``counts`` and the verdict; the counts are written once."""
    counts = with_counts(df.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).select("row.doc_id", "counts")
    counts = common.staged(counts, "rule-counts")
    return with_verdict(counts, fitted(counts))
