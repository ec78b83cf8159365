"""Quality classifier: histogram gradient-boosted trees over statistics of whole documents."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.session import materialise

#: Most labelled rows that are fitted on; beyond it, those in a fixed share of the hashes of identifiers.
TRAIN_ROWS = 50_000

FEATURES = (
    "log_chars log_words word_length distinct_words top_word top_pair distinct_lines line_words upper digits punctuation "
    "symbols spaces letters entropy short_words long_words all_caps symbol_ends comma_rate stop_rate capital_words"
).split()


def statistics(text: str) -> list[float]:
    """The :data:`FEATURES` of a whole text; an empty one has zeros throughout."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    n, chars = len(words), len(text)
    counts = Counter(words)
    pairs = Counter(zip(words, words[1:], strict=False))
    lines = [line for line in text.split("\n") if line.strip()]
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.bincount(np.minimum(points, 0x2FF), minlength=0x300)
    shares = codes[codes > 0] / chars
    digits = int(codes[48:58].sum())
    marks = int(codes[[33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63]].sum())
    symbols = int(codes[33:48].sum() + codes[58:65].sum() + codes[91:97].sum() + codes[123:127].sum()) - marks
    letters = int(codes[65:91].sum() + codes[97:123].sum() + codes[0xC0:].sum())
    lengths = np.fromiter(map(len, words), np.int64, n)
    ends = Counter(w[-1] for w in words)
    return [
        math.log1p(chars),
        math.log1p(n),
        float(lengths.mean()),
        len(counts) / n,
        max(counts.values()) / n,
        max(pairs.values(), default=0) / n,
        len(set(lines)) / len(lines),
        math.log1p(n / len(lines)),
        sum(1 for c in text if c.isupper()) / chars,
        digits / chars,
        marks / chars,
        symbols / chars,
        int(codes[[9, 10, 13, 32]].sum()) / chars,
        letters / chars,
        float(-(shares * np.log2(shares)).sum()),
        float((lengths <= 2).mean()),
        float((lengths > 20).mean()),
        sum(w.isupper() for w in words) / n,
        sum(v for c, v in ends.items() if not c.isalnum() and c not in ".,;:?") / n,
        ends[","] / n,
        ends["."] / n,
        sum(w[0].isupper() for w in words) / n,
    ]


def document_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, features`` of every row of ``docs``, a null text as the empty one."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(t or "") for t in batch[1].to_pylist()]
            features = pa.array(rows, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch[0], features], names=["doc_id", "features"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(compute, "doc_id long, features array<double>")


@dataclass(frozen=True)
class Trees:
    """Boosted trees as flat arrays: node ``i`` goes to ``left[i]`` if its feature is at most ``cut[i]``, else
    to ``left[i] + 1``; a leaf has ``feature`` -1 and a ``value``. ``roots`` are the trees' first nodes."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray

    def margins(self, x: np.ndarray) -> np.ndarray:
        """All rows go down a tree together, one level a step."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            while (inner := self.feature[node] >= 0).any():
                go = x[rows, np.maximum(self.feature[node], 0)] > self.cut[node]
                node = np.where(inner, self.left[node] + go, node)
            total += self.value[node]
        return total

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(x), -500, 500)))


@dataclass
class Growing:
    feature: list = field(default_factory=list)
    cut: list = field(default_factory=list)
    left: list = field(default_factory=list)
    value: list = field(default_factory=list)

    def add(self) -> int:
        for column, empty in ((self.feature, -1), (self.cut, 0.0), (self.left, 0), (self.value, 0.0)):
            column.append(empty)
        return len(self.feature) - 1


def fit(
    x: np.ndarray,
    y: np.ndarray,
    rounds: int = 80,
    depth: int = 5,
    rate: float = 0.15,
    bins: int = 64,
    least: int = 10,
    ridge: float = 1.0,
) -> Trees:
    """Boost logistic loss. Features are cut into ``bins`` at quantiles once; a node's split is the best
    gain over cumulative sums of its histograms of gradients and curvatures. Without rows, or with one
    class, there are no trees and the score is the share of ones (half without rows), smoothed."""
    prior = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(prior / (1 - prior)))
    grown, roots = Growing(), []
    if len(set(y.tolist())) > 1:
        cuts = [np.unique(np.quantile(f, np.linspace(0, 1, bins + 1)[1:-1])) for f in x.T]
        binned = np.stack([np.searchsorted(c, f, side="left") for c, f in zip(cuts, x.T, strict=True)], 1)
        n_features = x.shape[1]
        places = binned + bins * np.arange(n_features)
        margin = np.full(len(y), base)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-margin))
            gradient, curve = y - p, p * (1 - p)
            roots.append(grown.add())
            open_nodes = [(roots[-1], np.arange(len(y)), 0)]
            while open_nodes:
                node, rows, level = open_nodes.pop()
                g, h = gradient[rows].sum(), curve[rows].sum()
                split = None
                if level < depth and len(rows) >= 2 * least:
                    at = places[rows].ravel()
                    sums = [
                        np.bincount(at, np.repeat(w, n_features) if w is not None else None, n_features * bins)
                        .reshape(n_features, bins)
                        .cumsum(1)[:, :-1]
                        for w in (gradient[rows], curve[rows], None)
                    ]
                    gl, hl, nl = sums
                    gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g**2 / (h + ridge)
                    gain[(nl < least) | (len(rows) - nl < least)] = -1
                    best = int(gain.argmax())
                    if gain.flat[best] > 1e-6:
                        split = divmod(best, bins - 1)
                if split is None:
                    grown.value[node] = rate * g / (h + ridge)
                    margin[rows] += grown.value[node]
                    continue
                f, b = split
                right = binned[rows, f] > b
                left_node = grown.add()
                grown.add()
                grown.feature[node], grown.cut[node], grown.left[node] = f, float(cuts[f][b]), left_node
                open_nodes += [(left_node, rows[~right], level + 1), (left_node + 1, rows[right], level + 1)]
    return Trees(
        base,
        np.array(roots, int),
        np.array(grown.feature, int),
        np.array(grown.cut, float),
        np.array(grown.left, int),
        np.array(grown.value, float),
    )


def held_out(doc_id: str = "doc_id"):
    """Rows kept from training: crc32 of the identifier as text is a multiple of 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(statistics_of: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Trees:
    """Fit on labelled rows that are not held out, at most ``train_rows`` of them, those of a fixed range of hashes."""
    known = labels.where(F.col("quality").isin(0, 1)).select("doc_id", "quality")
    usable = statistics_of.join(known, "doc_id").where(~held_out())
    # a share of the hashes that leaves about as many rows as are wanted, so no task sends many
    share = min(1.0, train_rows / max(1, usable.count()))
    rows = (
        usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) < int(share * (1 << 32)))
        .select("doc_id", "features", "quality")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality", "features")
        .limit(train_rows)
        .select("features", "quality")
        .toArrow()
    )
    x = np.array(rows["features"].to_pylist(), float).reshape(-1, len(FEATURES))
    return fit(x, rows["quality"].to_numpy().astype(float))


def scored(statistics_of: DataFrame, trees: Trees) -> DataFrame:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch[1].to_pylist(), float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch[0], pa.array(trees.scores(x))], names=["doc_id", "score"])

    return statistics_of.select("doc_id", "features").mapInArrow(score, "doc_id long, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs`` (``doc_id, text``).

    Only statistics of the text are inputs of a score. Labels other than 0 and 1 and labels of unknown
    documents are ignored; repeated labels count as often as they come. A null ``doc_id`` is scored, but
    never trained on. An empty table gives no rows.
    """
    known = materialise(document_statistics(docs), "statistics")
    return scored(known, train(known, labels)).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, with all their columns.

    Statistics are made once: rows are staged with them, as one column, and filtered from there.
    """

    columns = docs.columns

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = dict(zip(columns, batch[0].flatten(), strict=True))
            features = pa.array([statistics(t or "") for t in doc["text"].to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch[0], doc["doc_id"].cast(pa.int64()), features], names=["doc", "doc_id", "features"])

    row = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"))
    schema = f"doc {row.schema['doc'].dataType.simpleString()}, doc_id long, features array<double>"
    known = materialise(row.mapInArrow(add, schema), "statistics")
    trees = train(known.select("doc_id", "features"), labels)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch[1].to_pylist(), float).reshape(-1, len(FEATURES))
            yield batch.filter(pa.array(trees.scores(x) >= threshold))

    return known.select("doc", "features").mapInArrow(keep, known.select("doc", "features").schema).select("doc.*")


def held_out_in_python(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return quality_scores(docs, labels)
