"""Quality rules: document statistics, a fixed base rule, and boosted trees over the statistics.

Statistics are computed for every word of every text. The trees are fitted on labelled rows, at
most ``SAMPLE`` of them (half per class, those with the smallest id hash), shipped as flat arrays
and applied to each Arrow batch at once. Symbols, repeated lines and repeated windows can only
lower a document's score (monotone features).

Defined results: a null text counts as empty; an empty text has no words, so the base rule rejects
it. Without labels, or with one class only, the trees accept everything (or reject everything, if
all labels are 0). Repeated document ids are judged row by row; repeated labels of an id count as
their minimum, null labels are left out. Other columns are never read, so their names don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchlake.llm import boosting
from batchlake.llm.arrow import ship, steps, sums, text_bytes, with_columns

#: Most labelled rows the trees are fitted on.
SAMPLE = 8192
#: Reject below this probability of good quality.
THRESHOLD = 0.5

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Feature names with the sign of their influence on the score (0: free).
FEATURES = {
    "log_words": 0,
    "word_length": 0,
    "symbols_per_word": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "upper_share": 0,
    "digit_share": 0,
    "stops_per_word": 0,
    "exclamations_per_word": 0,
    "words_per_line": 0,
    "non_ascii_share": 0,
    "short_word_share": 0,
    "wordless_share": 0,
}

SYMBOLS = b"#*$%&|<>"
_STOPS = b".,;:?"


def _table(members: bytes) -> np.ndarray:
    """For each byte whether it is one of ``members``."""
    table = np.zeros(256, dtype=np.int64)
    table[list(members)] = 1
    return table


_CLASSES = {
    "symbols": _table(SYMBOLS),
    "upper": _table(bytes(range(65, 91))),
    "digits": _table(b"0123456789"),
    "stops": _table(_STOPS),
    "exclamations": _table(b"!"),
    "heads": 1 - _table(bytes(range(0x80, 0xC0))),  # a byte that begins a code point
}


def _rows_of(lengths: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(lengths)), lengths)


def _repeated_words(codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Per text, the words in windows that occur twice or more in it.

    Windows meet by a 64-bit hash; those with a partner are compared word by word.
    """
    n = len(codes)
    if n < WINDOW:
        return np.zeros(len(lengths), dtype=np.int64)
    row = _rows_of(lengths)
    first = np.flatnonzero(row[: n - WINDOW + 1] == row[WINDOW - 1 :])
    key = row[first].astype(np.uint64) + np.uint64(1)
    for k in range(WINDOW):
        key = (key ^ (key >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        key += codes[first + k].astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    first = first[pd.Series(key).duplicated(keep=False).to_numpy()]
    if len(first):
        parts = np.stack([row[first], *(codes[first + k] for k in range(WINDOW))], axis=1)
        _, which, count = np.unique(parts, axis=0, return_inverse=True, return_counts=True)
        first = first[count[which.ravel()] > 1]
    cover = np.zeros(n + 1, dtype=np.int64)
    np.add.at(cover, first, 1)
    np.add.at(cover, first + WINDOW, -1)
    return sums(np.cumsum(cover[:-1]) > 0, lengths)


def statistics(column: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The base counts and the feature matrix of a column of texts."""
    column = pc.fill_null(column.cast(pa.string()), "")
    data, sizes = text_bytes(column)
    counted = {name: sums(table[data], sizes) for name, table in _CLASSES.items()}

    split = pc.ascii_split_whitespace(column)
    words = pc.list_flatten(split)
    real = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    lengths = sums(real, pc.list_value_length(split).to_numpy().astype(np.int64))
    words = words.filter(pa.array(real)).dictionary_encode()
    codes = words.indices.to_numpy().astype(np.int64)
    entry = words.dictionary
    chars = pc.utf8_length(entry).to_numpy().astype(np.int64)
    bare = pc.invert(pc.match_substring_regex(entry, r"[A-Za-z0-9\x{80}-\x{10ffff}]"))
    bare = bare.to_numpy(zero_copy_only=False)

    lines_split = pc.split_pattern(column, "\n")
    lines = pc.list_flatten(lines_split)
    row = _rows_of(pc.list_value_length(lines_split).to_numpy())
    filled = pc.greater(pc.binary_length(pc.ascii_trim_whitespace(lines)), 0)
    filled = filled.to_numpy(zero_copy_only=False)
    row = row[filled]
    line = lines.filter(pa.array(filled)).dictionary_encode()
    key = row * np.int64(max(1, len(line.dictionary))) + line.indices.to_numpy()
    again = pd.Series(key).duplicated().to_numpy()
    n = len(column)

    counts = {
        "n_words": lengths,
        "word_chars": sums(chars[codes], lengths),
        "n_symbols": counted["symbols"],
        "n_dup_lines": np.bincount(row[again], minlength=n).astype(np.int64),
        "n_repeat_words": _repeated_words(codes, lengths),
    }
    per_word = 1 / np.maximum(lengths, 1)
    per_char = 1 / np.maximum(counted["heads"], 1)
    per_line = 1 / np.maximum(np.bincount(row, minlength=n), 1)
    features = [
        np.log1p(lengths),
        counts["word_chars"] * per_word,
        counts["n_symbols"] * per_word,
        counts["n_dup_lines"] * per_line,
        counts["n_repeat_words"] * per_word,
        counted["upper"] * per_char,
        counted["digits"] * per_char,
        counted["stops"] * per_word,
        counted["exclamations"] * per_word,
        lengths * per_line,
        (sizes - counted["heads"]) * per_char,
        sums(chars[codes] == 1, lengths) * per_word,
        sums(bare[codes], lengths) * per_word,
    ]
    return counts, np.stack(features, axis=1).astype(float)


def base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    """The fixed part of the rule: too short, or too much of it repeated."""
    n = counts["n_words"]
    return (n < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * n)


def fit_model(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> boosting.Trees:
    """Trees fitted on at most ``sample`` labelled documents."""
    spark = docs.sparkSession
    ship(spark)
    known = (
        with_columns(labels, doc_id, label)
        .toDF("_id", "_label")
        .where("_id IS NOT NULL AND _label IS NOT NULL")
        .groupBy("_id")
        .agg(F.min("_label").cast("int").alias("_label"))
    )
    parts = [
        known.where(F.col("_label") == k).orderBy(F.xxhash64("_id"), "_id").limit(sample // 2)
        for k in (0, 1)
    ]
    # At most `sample` rows of two numbers: small enough to send to every task.
    chosen = F.broadcast(parts[0].unionByName(parts[1]))
    found = with_columns(docs, doc_id, text).toDF("_id", "_text").join(chosen, "_id")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "_text"):
            _, x = statistics(batch.column("_text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_label"), pa.array(list(x), pa.list_(pa.float64()))],
                ["_id", "_label", "_x"],
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = (
        found.mapInArrow(measure, f"_id {kind}, _label int, _x array<double>")
        .groupBy("_id")  # an id that occurs often is one example
        .agg(F.min(F.struct("_label", "_x")).alias("_row"))
        .orderBy("_id")
        .select("_row.*")
        .collect()
    )
    x = np.array([r["_x"] for r in rows], dtype=float).reshape(len(rows), len(FEATURES))
    y = np.array([r["_label"] for r in rows], dtype=float)
    return boosting.fit(x, y, list(FEATURES.values()))


def judge(
    docs: DataFrame,
    model: boosting.Trees,
    threshold: float = THRESHOLD,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: id, base counts, base verdict, probability of good quality, verdict."""
    ship(docs.sparkSession)
    names = [doc_id, *COUNTS, "base_failed", "score", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text):
            counts, x = statistics(batch.column(text))
            failed, score = base_failed(counts), model.probability(x)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(doc_id),
                    *[pa.array(counts[c], pa.int64()) for c in COUNTS],
                    pa.array(failed),
                    pa.array(score),
                    pa.array(~failed & (score >= threshold)),
                ],
                names,
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    schema = ", ".join(
        [f"`{doc_id}` {kind}", *[f"{c} bigint" for c in COUNTS],
         "base_failed boolean", "score double", "kept boolean"]
    )
    return with_columns(docs, doc_id, text).mapInArrow(run, schema)


def keep_good(
    docs: DataFrame, model: boosting.Trees, threshold: float = THRESHOLD, text: str = "text"
) -> DataFrame:
    """The rows of ``docs``, all columns, whose text passes the rules."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text):
            counts, x = statistics(batch.column(text))
            good = ~base_failed(counts) & (model.probability(x) >= threshold)
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
