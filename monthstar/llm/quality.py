"""Quality scores of documents: gradient-boosted trees over statistics of the text.

Statistics are cut into histogram bins; each tree of fixed depth is grown level by
level from sums over the bins. The trained trees are flattened into arrays, a level's
nodes side by side, and documents go down all of them together in numpy.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthstar.llm.tables import SLICE_ROWS, kind_of, mapped

#: Labelled rows that are learned from at most, the first by a hash of the id.
TRAIN_ROWS = 20_000
#: Trees, their depth, step, bins of a statistic, and the weight that holds leaves back.
TREES, DEPTH, STEP, BINS, HOLD = 80, 4, 0.15, 48, 5.0
#: Score from which a document counts as good.
GOOD = 0.7

_SIGNS = b"!|#*$%&.,:;?-=\"'()[]{}<>/\\_@+~^`"
#: Names of the statistics, in the order of ``statistics``.
NAMES = (
    "bytes", "words", "lines", "upper", "lower", "digits", "white", "beyond_ascii", "signs",
    *(f"sign_{chr(s)}" for s in _SIGNS[:12]),
    "word_bytes", "word_spread", "upper_words", "digit_words", "long_words", "distinct_words", "top_word", "top_three",
    "sign_ended", "sign_kinds", "distinct_lines", "line_words", "short_lines", "sentence_words",
)


def statistics(text: bytes | None) -> list[float]:
    """Statistics of a whole text (UTF-8); all zero for one that is null or empty."""
    if not text:
        return [0.0] * len(NAMES)
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n = len(text)
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    w, k = max(1, len(words)), max(1, len(lines))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    common = Counter(words).most_common(3)
    ends = Counter(word[-1] for word in words)
    signs = sum(int(count[s]) for s in _SIGNS)
    sentences = max(1, int(count[ord(".")]))
    return [
        np.log1p(n),
        np.log1p(len(words)),
        np.log1p(len(lines)),
        count[65:91].sum() / n,
        count[97:123].sum() / n,
        count[48:58].sum() / n,
        (count[32] + count[9:14].sum()) / n,
        count[128:].sum() / n,
        signs / n,
        *(count[s] / w for s in _SIGNS[:12]),
        sizes.mean() if len(words) else 0.0,
        sizes.std() if len(words) else 0.0,
        sum(map(bytes.isupper, words)) / w,
        sum(map(bytes.isdigit, words)) / w,
        float((sizes > 12).sum()) / w,
        len(set(words)) / w,
        common[0][1] / w if common else 0.0,
        sum(c for _, c in common) / w,
        sum(c for end, c in ends.items() if end in _SIGNS) / w,
        sum(1 for end, c in ends.items() if end in _SIGNS and c > 0.05 * w),
        len(set(lines)) / k,
        len(words) / k,
        sum(len(line) < 30 for line in lines) / k,
        len(words) / sentences,
    ]


class Trees:
    """Flattened trees: ``feature`` and ``cut`` by tree and inner node, ``value`` by tree and leaf."""

    def __init__(self, start: float, feature: np.ndarray, cut: np.ndarray, value: np.ndarray):
        self.start, self.feature, self.cut, self.value = start, feature, cut, value

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each row."""
        total = np.full(len(rows), self.start)
        every = np.arange(len(rows))
        for feature, cut, value in zip(self.feature, self.cut, self.value):
            node = np.zeros(len(rows), dtype=np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (rows[every, feature[node]] > cut[node])
            total += value[node - (2**DEPTH - 1)]
        return 1.0 / (1.0 + np.exp(-total))


def fit(rows: np.ndarray, labels: np.ndarray) -> Trees:
    """Trees that lower the logistic loss; without both labels the share of label 1 is all there is."""
    inner = 2**DEPTH - 1
    share = (labels.sum() + 1.0) / (len(labels) + 2.0)
    start = float(np.log(share / (1 - share)))
    if len(set(labels.tolist())) < 2:
        none = np.zeros((0, inner))
        return Trees(start, none.astype(np.int64), none, np.zeros((0, inner + 1)))
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in rows.T]
    binned = np.stack([np.searchsorted(c, column, side="left") for c, column in zip(cuts, rows.T)], axis=1)
    n, width = binned.shape
    total = np.full(n, start)
    features, thresholds, values = [], [], []
    for _ in range(TREES):
        p = 1.0 / (1.0 + np.exp(-total))
        slope, bend = labels - p, p * (1 - p)
        node = np.zeros(n, dtype=np.int64)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(DEPTH):
            first, nodes = 2**level - 1, 2**level
            gain, chosen = np.zeros(nodes), np.full((nodes, 2), -1)
            for f in range(width):
                place = (node - first) * BINS + binned[:, f]
                g = np.bincount(place, slope, nodes * BINS).reshape(nodes, BINS).cumsum(axis=1)
                h = np.bincount(place, bend, nodes * BINS).reshape(nodes, BINS).cumsum(axis=1)
                all_g, all_h = g[:, -1:], h[:, -1:]
                better = g**2 / (h + HOLD) + (all_g - g) ** 2 / (all_h - h + HOLD) - all_g**2 / (all_h + HOLD)
                better = better[:, : len(cuts[f])]
                if not better.shape[1]:
                    continue
                at = better.argmax(axis=1)
                top = better[np.arange(nodes), at]
                wins = top > gain + 1e-9
                gain[wins] = top[wins]
                chosen[wins] = np.stack([np.full(nodes, f), at], axis=1)[wins]
            for k, (f, b) in enumerate(chosen):
                if f >= 0:
                    feature[first + k], cut[first + k] = f, cuts[f][b]
            node = 2 * node + 1 + (rows[np.arange(n), feature[node]] > cut[node])
        leaf = node - inner
        g, h = np.bincount(leaf, slope, inner + 1), np.bincount(leaf, bend, inner + 1)
        value = STEP * g / (h + HOLD)
        total += value[leaf]
        features.append(feature)
        thresholds.append(cut)
        values.append(value)
    return Trees(start, np.array(features), np.array(thresholds), np.array(values))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    may_learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    rows: int = TRAIN_ROWS,
) -> Trees:
    """Trees learned from at most ``rows`` labelled documents that ``may_learn`` admits.

    The chosen labels are bounded by ``rows`` and are broadcast; the statistics
    of their documents are all that the driver gets, one row for each label: of
    documents that share an id the one whose statistics are smallest. Null labels
    teach nothing.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & may_learn)
    chosen = (
        known.groupBy(id_col).agg(F.min(label_col).alias("label"))
        .orderBy(F.xxhash64(id_col), id_col).limit(rows)
    )
    wanted = docs.select(id_col, text_col).join(F.broadcast(chosen), id_col).select(
        F.col(id_col).alias("id"), "label", text_col
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(t) for t in batch.column(2).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.float64()))], names=["id", "label", "row"]
            )

    schema = f"id {kind_of(wanted, 'id')}, label {kind_of(chosen, 'label')}, row array<double>"
    got = (
        wanted.transform(mapped, run, schema)
        .groupBy("id").agg(F.min("label").alias("label"), F.min("row").alias("row")).collect()
    )
    table = np.array(sorted([*r["row"], float(r["label"])] for r in got)).reshape(-1, len(NAMES) + 1)
    return fit(table[:, :-1], table[:, -1])


def scores(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, score)`` of every row, from the whole text alone.

    Null and empty texts have statistics of zero and are scored by them. Repeated
    rows and null ids keep one result row each; other columns are not read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                found = [statistics(t) for t in part.column(1).cast(pa.binary()).to_pylist()]
                score = trees.score(np.array(found))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score)], names=[id_col, "score"])

    return docs.select(id_col, text_col).transform(
        mapped,
        run, f"`{id_col}` {kind_of(docs, id_col)}, score double"
    )
