"""Text quality by a generalised additive model with pairwise interactions.

The score is the logistic of an intercept plus one lookup table per feature and per chosen
pair of features. Tables are learned by cyclic boosting: features take turns, and each
turn adds a shallow tree over that feature's bins, shrunk by the learning rate. Then the pairs
whose quadrants explain most of what is left take turns in the same way. Scoring
finds each value's bin and adds table entries, for whole batches at once.

The tables are fitted by the driver on a bounded, hash-ordered sample of the labelled rows'
features; texts never leave the tasks.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.llm.batches import TEXT_ROWS, map_batches, utf8
from gridlake.llm.rules import label_per_document
from gridlake.llm.sampling import hash_bound, mark

#: The most labelled rows that are fitted.
SAMPLE = 20_000
CYCLES, PAIR_CYCLES, RATE, PAIRS = 80, 40, 0.15, 6
BINS, COARSE, LEAST, RIDGE = 32, 8, 10, 1.0
ACCEPT = 0.3
FOLDS, HELD_OUT = 5, 0

FEATURES = (
    "log_words", "mean_word", "distinct_words", "top_word", "adjacent_equal", "short_words",
    "symbols", "pipes", "exclamations", "capitals", "digits", "full_stops", "commas",
    "other_marks", "non_ascii", "blank_share", "words_per_line", "repeated_lines",
    "words_per_stop", "log_longest_word",
)

_GROUPS = {
    "symbols": b"#*$%&<>",
    "pipes": b"|",
    "exclamations": b"!",
    "capitals": bytes(range(65, 91)),
    "digits": b"0123456789",
    "full_stops": b".?",
    "commas": b",;:",
    "other_marks": b"\"'()[]{}/\\@^_`~+=-",
}


def text_features(text: bytes) -> list[float]:
    """The features of a UTF-8 text, in the order of FEATURES. All are 0 without words."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    n = len(words)
    codes = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    letters = sum(map(len, words))
    lines = [line for line in text.split(b"\n") if line.strip()]
    counts = Counter(words)
    equal = sum(map(bytes.__eq__, words, words[1:]))
    share = {name: int(codes[list(group)].sum()) / letters for name, group in _GROUPS.items()}
    stops = int(codes[list(b".?!")].sum())
    return [
        float(np.log1p(n)),
        letters / n,
        len(counts) / n**0.9,
        max(counts.values()) / n,
        equal / n,
        sum(len(word) <= 2 for word in words) / n,
        *share.values(),
        int(codes[128:].sum()) / letters,
        (len(text) - letters) / len(text),
        n / len(lines),
        1 - len(set(lines)) / len(lines),
        n / (stops + 1),
        float(np.log1p(max(map(len, words)))),
    ]


def _featured(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows = [text_features(text) for text in utf8(batch, "text")]
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array(rows, pa.list_(pa.float32()))], ["doc_id", "features"]
    )


# --- the model ----------------------------------------------------------------


def _gain(gradient, weight):
    return gradient**2 / (weight + RIDGE)


def _best_cut(gradient: np.ndarray, weight: np.ndarray, count: np.ndarray) -> tuple[float, int]:
    """The gain of the best cut of ordered bins, and the first bin right of it; 0 if none."""
    g, w, c = (np.cumsum(x)[:-1] for x in (gradient, weight, count))
    if not len(g):
        return 0.0, 0
    rest_g, rest_w, rest_c = gradient.sum() - g, weight.sum() - w, count.sum() - c
    gain = _gain(g, w) + _gain(rest_g, rest_w) - _gain(gradient.sum(), weight.sum())
    gain = np.where((c >= LEAST) & (rest_c >= LEAST), gain, 0.0)
    best = int(np.argmax(gain))
    return (float(gain[best]), best + 1) if gain[best] > 0 else (0.0, 0)


def _leaves(bounds: list[int], gradient: np.ndarray, weight: np.ndarray) -> np.ndarray:
    table = np.zeros(len(gradient))
    for start, end in zip(bounds, bounds[1:], strict=False):
        table[start:end] = gradient[start:end].sum() / (weight[start:end].sum() + RIDGE)
    return table


def _tree(gradient: np.ndarray, weight: np.ndarray, count: np.ndarray) -> np.ndarray:
    """A tree of depth two over ordered bins, as one value per bin."""
    _, middle = _best_cut(gradient, weight, count)
    bounds = [0, len(gradient)]
    if middle:
        cuts = [middle]
        for start, end in ((0, middle), (middle, len(gradient))):
            _, cut = _best_cut(gradient[start:end], weight[start:end], count[start:end])
            cuts += [start + cut] if cut else []
        bounds = [0, *sorted(cuts), len(gradient)]
    return _leaves(bounds, gradient, weight)


def _pair_tree(gradient: np.ndarray, weight: np.ndarray, count: np.ndarray) -> tuple[float, np.ndarray]:
    """The better of cutting rows then columns, or columns then rows: gain and values."""
    best = (0.0, np.zeros_like(gradient))
    for turned in (False, True):
        g, w, c = (x.T if turned else x for x in (gradient, weight, count))
        _, middle = _best_cut(g.sum(1), w.sum(1), c.sum(1))
        if not middle:
            continue
        table, gain = np.zeros_like(g), -_gain(g.sum(), w.sum())
        for part in (slice(0, middle), slice(middle, None)):
            sums = [x[part].sum(0) for x in (g, w, c)]
            _, cut = _best_cut(*sums)
            bounds = [0, cut, len(sums[0])] if cut else [0, len(sums[0])]
            table[part] = _leaves(bounds, sums[0], sums[1])
            gain += sum(
                _gain(sums[0][a:b].sum(), sums[1][a:b].sum())
                for a, b in zip(bounds, bounds[1:], strict=False)
            )
        if gain > best[0]:
            best = (float(gain), table.T if turned else table)
    return best


@dataclass
class AdditiveModel:
    """Bin edges and lookup tables; a few thousand numbers."""

    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def score(self, values: np.ndarray) -> np.ndarray:
        """The probability of label 1 for each row of features."""
        total = np.full(len(values), self.intercept)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edges, values[:, j], side="right")]
        for (i, j), table in self.pairs.items():
            rows = np.searchsorted(self.coarse[i], values[:, i], side="right")
            total += table[rows, np.searchsorted(self.coarse[j], values[:, j], side="right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1]))


def fit(values: np.ndarray, labels: np.ndarray) -> AdditiveModel:
    """Learn the tables. With no rows the score is 0.5, with one label it is close to it."""
    n = len(labels)
    share = (labels.sum() + 1) / (n + 2)
    model = AdditiveModel(intercept=float(np.log(share / (1 - share))))
    if n == 0 or labels.min() == labels.max():
        return model
    features = range(values.shape[1])
    model.edges = [_edges(values[:, j], BINS) for j in features]
    model.coarse = [_edges(values[:, j], COARSE) for j in features]
    fine = [np.searchsorted(model.edges[j], values[:, j], side="right") for j in features]
    rough = [np.searchsorted(model.coarse[j], values[:, j], side="right") for j in features]
    model.tables = [np.zeros(len(edges) + 1) for edges in model.edges]
    total = np.full(n, model.intercept)

    def residual() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return labels - p, p * (1 - p)

    def sums(bins: np.ndarray, size: int) -> list[np.ndarray]:
        gradient, weight = residual()
        return [np.bincount(bins, x, size) for x in (gradient, weight, np.ones(n))]

    for _ in range(CYCLES):
        for j in features:
            step = RATE * _tree(*sums(fine[j], len(model.tables[j])))
            model.tables[j] += step
            total += step[fine[j]]

    def cells(i: int, j: int) -> tuple[np.ndarray, tuple[int, int]]:
        shape = (len(model.coarse[i]) + 1, len(model.coarse[j]) + 1)
        return rough[i] * shape[1] + rough[j], shape

    def pair_tree(i: int, j: int) -> tuple[float, np.ndarray]:
        bins, shape = cells(i, j)
        return _pair_tree(*(x.reshape(shape) for x in sums(bins, shape[0] * shape[1])))

    gains = {(i, j): pair_tree(i, j)[0] for i in features for j in features if i < j}
    chosen = sorted((pair for pair, gain in gains.items() if gain > 0), key=gains.get)[-PAIRS:]
    for _ in range(PAIR_CYCLES):
        for i, j in chosen:
            step = RATE * pair_tree(i, j)[1]
            model.pairs[i, j] = model.pairs.get((i, j), 0.0) + step
            total += step[rough[i], rough[j]]
    return model


# --- on tables ----------------------------------------------------------------


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> AdditiveModel:
    """Fit on at most ``sample`` labelled rows outside of the held-out fold.

    Rows are chosen by a hash of their id, without reading a text, so the choice is the same
    for any partitioning; the features of their texts alone are computed and reach the
    driver. Labels with a null id or label are left out.
    """
    marked = label_per_document(labels)
    narrow = documents.select("doc_id", "text").filter(fold(F.col("doc_id")) != HELD_OUT)
    known = narrow.select("doc_id").join(marked, F.col("doc_id") == F.col("label_id"))
    bound = hash_bound(known.select("doc_id"), sample)
    chosen = marked.filter(mark(F.col("label_id")) <= F.lit(bound - 1))
    texts = narrow.filter(mark(F.col("doc_id")) <= F.lit(bound - 1)).join(
        chosen, F.col("doc_id") == F.col("label_id")
    )
    kind = dict(narrow.dtypes)["doc_id"]
    featured = map_batches(
        texts.select("doc_id", "text", F.col("label").cast("double").alias("label")),
        _labelled,
        f"doc_id {kind}, features array<float>, label double",
    )
    rows = sorted((row["doc_id"], row["features"], row["label"]) for row in featured.collect())
    values = np.array([row[1] for row in rows], np.float32).reshape(-1, len(FEATURES))
    return fit(values, np.array([row[2] for row in rows], float))


def _labelled(batch: pa.RecordBatch) -> pa.RecordBatch:
    own = _featured(batch)
    return pa.RecordBatch.from_arrays(
        [*own.columns, batch.column("label")], ["doc_id", "features", "label"]
    )


def score_quality(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``documents``: doc_id, held_out, score, predicted.

    Null, empty and blank texts have all features 0 and get the score the model has for
    them. A null id is in no fold (held_out is false) and has no label. Repeated rows get
    equal scores.
    """
    model = train(documents, labels, sample)

    def scored(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = _scores(model, utf8(batch, "text"))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"]
        )

    texts = documents.select("doc_id", "text")
    kind = dict(texts.dtypes)["doc_id"]
    return map_batches(texts, scored, f"doc_id {kind}, score double").select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
    )


def _scores(model: AdditiveModel, texts: list[bytes]) -> np.ndarray:
    rows = [text_features(text) for text in texts]
    return model.score(np.array(rows, np.float32).reshape(-1, len(FEATURES)))


def accepted(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``documents`` the classifier accepts, with all their columns.

    The same scores as ``score_quality``, computed next to the text, so no text is shuffled.
    """
    model = train(documents, labels, sample)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        found = []
        for start in range(0, len(texts), TEXT_ROWS):
            part = texts.iloc[start : start + TEXT_ROWS]
            found.append(_scores(model, [(t or "").encode(errors="surrogatepass") for t in part]))
        return pd.Series(np.concatenate(found) if found else np.zeros(0))

    return documents.filter(score(F.col("text")) >= ACCEPT)
