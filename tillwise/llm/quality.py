"""Quality rules: base rules, and an isolation forest on rule statistics.

Every whole text is described by a few rule statistics. The base rules reject short and repetitive texts. An isolation
forest, random splits fitted on labelled good texts, gives every text an average path length: texts that few random
splits isolate are unlike good prose. The threshold is calibrated from labelled rows: the path length that parts good
from bad ones at the least cost.

Null and empty texts have no words and fail the base rules. Without labelled rows there is no forest, and the base rules
alone decide. Equal texts get equal verdicts, so repeated rows stay or go together.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import quoted, with_results

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
#: The forest is fitted, and the threshold calibrated, on at most so many labelled texts (those with the smallest hash
#: of their id). The bound keeps what reaches the driver small; all texts are scored.
SAMPLE_ROWS = 6_000
TREES = 100
TREE_ROWS = 256
#: A good text that is lost costs as much as so many bad ones that are kept.
CLEAN_WEIGHT = 10.0
SEED = 17

UPPER = bytes(range(65, 91))

BASE = {"n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(), "n_dup_lines": pa.int64(), "n_repeat_words": pa.int64()}
FEATURES = (
    "symbols_per_word", "repeat_share", "dup_line_share", "upper_share", "letter_share", "mark_share", "distinct_share", "top_word_share",
)


def repeated_words(words: list) -> int:
    """Words that lie in a window of three words found twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    found = Counter(windows)
    covered, reach = 0, 0
    for i, window in enumerate(windows):
        if found[window] > 1:
            covered += i + 3 - max(i, reach)
            reach = i + 3
    return covered


def describe(text: str | None) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """The base statistics and the features of one whole text."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    words = raw.split()  # at ASCII white space
    n = len(words)
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    dup_lines = len(lines) - len(set(lines))
    repeated = repeated_words(words)
    base = (n, chars, symbols, dup_lines, repeated)
    if not n:
        return base, (0.0,) * len(FEATURES)
    counts = Counter(words)
    upper = len(raw) - len(raw.translate(None, UPPER))
    marks = sum(map(text.count, "!?.,;:|-_/"))
    features = (
        math.sqrt(symbols / n), math.sqrt(repeated / n), math.sqrt(dup_lines / len(lines)), math.sqrt(upper / chars),
        min(chars / n, 40.0), math.sqrt(marks / n), math.log(len(counts)) / math.log(n + 1), math.sqrt(max(counts.values()) / n),
    )
    return base, features


@dataclass
class Forest:
    """Random splits: node i of a tree splits `feature[i]` at `value[i]`; its children are 2i+1 and 2i+2."""

    feature: np.ndarray
    value: np.ndarray
    length: np.ndarray

    @staticmethod
    def expected(n: float) -> float:
        """Mean path length of a failed search among n rows."""
        return 0.0 if n <= 1 else 1.0 if n <= 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n

    @classmethod
    def fit(cls, rows: np.ndarray, low: np.ndarray, high: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = SEED) -> Forest:
        """Split the box from `low` to `high` at random until each part holds one row, or none.

        The box is that of all labelled texts, the rows are good ones: parts without good rows end early.
        """
        random = np.random.default_rng(seed)
        depth = max(1, math.ceil(math.log2(max(2, min(tree_rows, len(rows))))))
        size = 2 ** (depth + 1) - 1
        feature = np.full((trees, size), -1, dtype=np.int16)
        value = np.zeros((trees, size))
        length = np.zeros((trees, size))
        for t in range(trees):
            chosen = rows[random.choice(len(rows), min(tree_rows, len(rows)), replace=False)]
            todo = [(0, 0, chosen, low, high)]
            while todo:
                node, level, here, least, most = todo.pop()
                wide = np.flatnonzero(most > least)
                if level == depth or len(here) <= 1 or not len(wide):
                    length[t, node] = level + cls.expected(len(here))
                    continue
                f = int(random.choice(wide))
                v = random.uniform(least[f], most[f])
                feature[t, node], value[t, node] = f, v
                left = here[:, f] < v
                below, above = most.copy(), least.copy()
                below[f] = above[f] = v
                todo += [(2 * node + 1, level + 1, here[left], least, below), (2 * node + 2, level + 1, here[~left], above, most)]
        return cls(feature, value, length)

    def path_length(self, rows: np.ndarray) -> np.ndarray:
        """Average over the trees."""
        total = np.zeros(len(rows))
        for feature, value, length in zip(self.feature, self.value, self.length, strict=True):
            node = np.zeros(len(rows), dtype=np.int64)
            inner = feature[node] >= 0
            while inner.any():
                f = feature[node]
                right = rows[np.arange(len(rows)), np.maximum(f, 0)] >= value[node]
                node = np.where(inner, 2 * node + 1 + right, node)
                inner = feature[node] >= 0
            total += length[node]
        return total / max(1, len(self.feature))


@dataclass
class Detector:
    """A forest, and the least path length of a text to keep."""

    forest: Forest
    least: float

    @classmethod
    def fit(cls, rows: np.ndarray, good: np.ndarray, clean_weight: float = CLEAN_WEIGHT) -> Detector | None:
        """Half of the good rows (every other one) grow the trees; all rows calibrate the threshold.

        The threshold is the lowest that costs least, a lost good text costing as much as `clean_weight` kept bad ones.
        """
        if good.sum() < 2:
            return None
        forest = Forest.fit(rows[good][::2], rows.min(0), rows.max(0))
        lengths = forest.path_length(rows)
        order = np.argsort(lengths, kind="stable")
        lengths, good = lengths[order], good[order]
        # cost[i]: all rows before the i-th are rejected; only places between different lengths can be cut
        cost = np.concatenate([[0.0], np.cumsum(np.where(good, clean_weight, -1.0))])
        places = np.flatnonzero(np.concatenate([[True], np.diff(lengths) > 0, [False]]))
        best = int(places[np.argmin(cost[places])])
        return cls(forest, 0.0 if best == 0 else float((lengths[best - 1] + lengths[best]) / 2))

    def keeps(self, rows: np.ndarray) -> np.ndarray:
        return self.forest.path_length(rows) >= self.least if len(rows) else np.zeros(0, dtype=bool)


def fit_detector(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, text: str = "text", key: str = "doc_id") -> Detector | None:
    """A detector fitted on at most `sample_rows` labelled texts; None if there are none.

    Repeated labels of one id count as one, the lowest. The texts are described where they lie; the driver gets numbers.
    """
    chosen = (
        labels.filter(F.col("quality").isNotNull() & F.col(quoted(key)).isNotNull())
        .groupBy(F.col(quoted(key)).alias("labelled_id"))
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("labelled_id"), "labelled_id")
        .limit(sample_rows)
    )
    texts = docs.select(F.col(quoted(key)).alias("labelled_id"), F.col(quoted(text)).alias("text")).join(
        F.broadcast(chosen), "labelled_id"  # at most `sample_rows` pairs of numbers
    )

    def run(found):
        described = [describe(x) for x in found]
        return [pa.array([x[0] for x in described], pa.list_(pa.int64())), [str(x[1])[1:-1] for x in described]]

    rows = with_results(texts, "text", {"base": pa.list_(pa.int64()), "features": pa.string()}, run)
    rows = rows.filter("base[0] >= 50 AND 100 * base[4] <= 50 * base[0]").groupBy("labelled_id").agg(F.min("quality"), F.min("features"))
    found = sorted((i, quality, tuple(map(float, x.split(",")))) for i, quality, x in rows.collect())
    if not found:
        return None
    return Detector.fit(np.array([x[2] for x in found]), np.array([x[1] > 0 for x in found]))


def judge(docs: DataFrame, detector: Detector | None, text: str = "text") -> DataFrame:
    """Add the base statistics, `base_failed`, the average path length and `kept` to every row."""

    def run(texts):
        described = [describe(x) for x in texts]
        base = np.array([x[0] for x in described], dtype=np.int64).reshape(-1, len(BASE))
        failed = (base[:, 0] < 50) | (100 * base[:, 4] > 50 * base[:, 0])
        kept = ~failed
        length = np.full(len(texts), np.nan)
        if detector is not None and kept.any():
            length[kept] = detector.forest.path_length(np.array([x[1] for x in described])[kept])
            kept = kept & ~(length < detector.least)
        return [*base.T, failed, pa.array(length, from_pandas=True), kept]

    added = BASE | {"base_failed": pa.bool_(), "path_length": pa.float64(), "kept": pa.bool_()}
    return with_results(docs, text, added, run)


def keep_good(docs: DataFrame, detector: Detector | None, text: str = "text") -> DataFrame:
    """The rows whose text is kept, with their own columns only."""
    names = docs.columns
    renamed = [f"c{i}" for i in range(len(names))]  # own columns may be called like the added ones
    fed = docs.toDF(*renamed).withColumn("judged", F.col(renamed[names.index(text)]))
    return judge(fed, detector, "judged").filter("kept").select(*renamed).toDF(*names)
