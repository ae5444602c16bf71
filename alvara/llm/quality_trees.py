"""Quality scores by histogram gradient-boosted trees over document statistics.

One pass turns every text into a short row of statistics (numpy on its bytes, and counts
of its words and lines). The labelled rows, at most ``SAMPLE`` of them by a hash, are cut
into bins and train trees of one depth on the logistic loss: gradients are summed for each
node, feature and bin, and a split's gain comes from those sums alone. The trees are
flattened into three arrays; a batch of rows walks all trees level by level.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, table, tidy

#: Labelled rows that train the trees, at most; everything is scored.
SAMPLE = 20_000
TREES, DEPTH, BINS = 80, 4, 64
RATE, RIDGE, LEAST_WEIGHT = 0.15, 1.0, 2.0
CUT = 0.3
FOLDS = 5
_PARTS = 1 << 31

NAMES = (
    "bytes", "words", "lines", "word_bytes", "longest_word", "upper", "digits", "symbols", "marks", "stops",
    "brackets", "beyond_ascii", "controls", "distinct_words", "commonest_word", "same_as_before", "short_words",
    "repeated_pairs", "repeated_lines", "commonest_line", "words_a_line", "longest_line", "distinct_bytes", "entropy",
)


def _bytes_of(characters: str) -> list[int]:
    return list(characters.encode())


_UPPER, _DIGITS = list(range(65, 91)), list(range(48, 58))
_LETTERS = _UPPER + list(range(97, 123)) + list(range(128, 256))


def statistics(text: bytes) -> list[float]:
    """The numbers of ``NAMES`` for a UTF-8 text; an empty text has zeros."""
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256).astype(float)
    words = text.split()
    n, size = len(words), len(text)
    if not n:
        return [np.log1p(size), *[0.0] * (len(NAMES) - 1)]
    seen = Counter(words)
    lines = [line for line in text.split(b"\n") if line.strip()]
    lengths = np.fromiter(map(len, words), np.int64, n)
    pairs = len(set(zip(words, words[1:])))
    same = sum(map(bytes.__eq__, words, words[1:]))
    kinds = Counter(lines)
    letters = max(1.0, count[_LETTERS].sum())
    used = count[count > 0] / size
    return [
        np.log1p(size), np.log1p(n), np.log1p(len(lines)), float(lengths.mean()), float(np.log1p(lengths.max())),
        count[_UPPER].sum() / letters, count[_DIGITS].sum() / size, count[_bytes_of("#*$%&|<>@^~_=+\\")].sum() / n,
        count[_bytes_of("!?")].sum() / n, count[_bytes_of(".,;:")].sum() / n, count[_bytes_of("()[]{}")].sum() / n,
        count[128:].sum() / size, count[:9].sum() / size, len(seen) / n, max(seen.values()) / n,
        same / n, float((lengths <= 2).mean()), 1 - pairs / max(1, n - 1), 1 - len(kinds) / len(lines),
        max(kinds.values()) / len(lines), np.log1p(n / len(lines)), float(np.log1p(max(map(len, lines)))),
        float((count > 0).sum()), float(-(used * np.log2(used)).sum()),
    ]


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [statistics(text.as_py() or b"") for text in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "stats"])


@dataclass(frozen=True)
class Trees:
    """``feature`` and ``above`` by tree and inner node, ``value`` by tree and leaf."""

    feature: np.ndarray
    above: np.ndarray
    value: np.ndarray
    start: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The chance of label 1 of each row of ``x``."""
        rows, total = np.arange(len(x)), np.full(len(x), self.start)
        depth = self.value.shape[1].bit_length() - 1
        for feature, above, value in zip(self.feature, self.above, self.value):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > above[at])
            total += value[at - len(feature)]
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def edges(x: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    """For each feature the rising bounds of its bins: quantiles of what occurs."""
    steps = np.arange(1, bins) / bins
    return [np.unique(np.quantile(column, steps, method="lower")) for column in x.T]


def _split(g: np.ndarray, h: np.ndarray, whole: tuple[float, float]) -> np.ndarray:
    """The gain of a cut behind each bin, from sums of gradients and weights by bin."""
    left_g, left_h = g.cumsum(-1), h.cumsum(-1)
    right_g, right_h = whole[0] - left_g, whole[1] - left_h
    gain = left_g ** 2 / (left_h + RIDGE) + right_g ** 2 / (right_h + RIDGE) - whole[0] ** 2 / (whole[1] + RIDGE)
    return np.where((left_h < LEAST_WEIGHT) | (right_h < LEAST_WEIGHT), -np.inf, gain)


def train(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> Trees:
    """Boosted trees; deterministic. Ties go to the first feature and the lowest bin."""
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start, inner = float(np.log(share / (1 - share))), 2 ** depth - 1
    bounds = edges(x)
    binned = np.stack([np.searchsorted(b, column, "left") for b, column in zip(bounds, x.T)])
    feature = np.zeros((trees, inner), np.int64)
    above = np.full((trees, inner), np.inf)
    value = np.zeros((trees, inner + 1))
    total = np.full(len(y), start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, nodes = 2 ** level - 1, 2 ** level
            place = (at - first) * BINS
            sums = [
                [np.bincount(place + b, weight, nodes * BINS).reshape(nodes, BINS) for weight in (g, h)]
                for b in binned]
            for node in range(nodes):
                whole = (sums[0][0][node].sum(), sums[0][1][node].sum())
                gains = np.stack([_split(a[node], b[node], whole) for a, b in sums])
                f, cut = np.unravel_index(gains.argmax(), gains.shape)
                if gains[f, cut] > 1e-9 and cut < len(bounds[f]):
                    feature[t, first + node], above[t, first + node] = f, bounds[f][cut]
            f = feature[t, at]
            at = 2 * at + 1 + (x[np.arange(len(y)), f] > above[t, at])
        leaf = at - inner
        value[t] = -rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + RIDGE)
        total = total + value[t][leaf]
    return Trees(feature, above, value, start)


def held_out(doc_id: Column) -> Column:
    """A fifth of the ids, whose labels are never learned from; null: not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def learn(stats: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees | None:
    """Trees from ``stats`` (doc_id, stats) and ``labels`` (doc_id, quality); None without labels.

    Labels other than 0 and 1 take no part; a doc_id that is repeated in either table
    counts once for each distinct statistics and label. If there are more than ``sample``
    rows, a cut by the hash of the id, at a share that their number gives, comes first, so
    that no task offers ``sample`` rows of its own.
    """
    known = tidy(labels, doc_id="long", quality="int").where("quality in (0, 1) and doc_id is not null").distinct()
    rows = stats.join(known.where(~held_out(F.col("doc_id"))), "doc_id").select("doc_id", "quality", "stats").distinct()
    rows = materialise(rows.withColumn("at", F.pmod(F.xxhash64("doc_id"), F.lit(_PARTS))), "labelled")
    share = 1.2 * sample / max(1, rows.count())
    rows = rows.where(F.col("at") < F.lit(math.ceil(share * _PARTS)))
    rows = rows.orderBy("at", "doc_id", "quality", "stats").limit(sample).collect()
    if not rows:
        return None
    return train(np.array([r["stats"] for r in rows]), np.array([r["quality"] for r in rows], float))


def _scores(trees: Trees | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy()
            x = flat.reshape(batch.num_rows, len(NAMES))
            found = trees.scores(x) if trees else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["doc_id", "score"])
    return run


def quality_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, cut: float = CUT) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs`` (doc_id, text).

    Only statistics of the text enter a score. Null texts count as empty; empty ones are
    scored like all. Texts are read whole, whatever their length. Repeated rows and null
    ids each give a row; further columns are ignored; an empty table gives an empty result;
    without any label the score is 0.5.
    """
    texts = tidy(docs, doc_id="long", text="string").select("doc_id", F.encode("text", "UTF-8").alias("text"))
    stats = materialise(texts.mapInArrow(_statistics, "doc_id long, stats array<double>"), "document_statistics")
    scored = stats.mapInArrow(_scores(learn(stats, labels, sample)), "doc_id long, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= cut).cast("int").alias("predicted"))


def op12_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))
