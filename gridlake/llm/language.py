"""Language identification by averaged hashed subword embeddings.

A text's subwords are the runs of 2, 3 and 4 bytes of its lower-cased letters, with one
blank between words. Each is hashed to a row of an embedding table; the average of the rows
goes through a linear softmax. Both are learned by stochastic gradient descent in numpy, on a
bounded sample of texts. Since everything is linear before the softmax, a learned model
is one row of language scores per bucket, and prediction adds up rows.

Scores are calibrated by a temperature on texts that were not fitted, and a cutoff
chosen there rejects predictions that are too uncertain (column ``accepted``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.llm.batches import map_batches
from gridlake.llm.sampling import sampled

#: The most texts that are learned from; a quarter of them only calibrates.
SAMPLE = 3_000
BUCKET_BITS, ORDERS, WIDTH = 14, (2, 3, 4), 16
EPOCHS, BATCH, RATE = 6, 32, 0.5
#: The share of errors among accepted predictions aimed at.
ERROR = 0.01
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
#: Bytes of text hashed at once.
CHUNK = 1 << 20
_FACTOR = np.uint32(2654435761)
BUCKETS = 1 << BUCKET_BITS


def letters_of(text: str | None) -> bytes:
    """Lower-cased words of letters with a blank around each; empty without a letter.

    Only characters that are no letters are taken out, so no part of a text is left aside.
    """
    if not text:
        return b""
    lowered = text.lower()
    if not lowered.isascii():
        others = {ord(c): " " for c in set(lowered) if not c.isalpha()}
        lowered = lowered.translate(others)
        words = lowered.encode(errors="replace").split()
    else:
        words = lowered.encode().translate(_ONLY_LETTERS).split()
    return b" " + b" ".join(words) + b" " if words else b""


_ONLY_LETTERS = bytes(c if chr(c).isalpha() and c < 128 else 32 for c in range(256))


def subwords(letters: bytes) -> Iterator[np.ndarray]:
    """The buckets of all subwords, in parts of bounded size, each with all orders."""
    longest = max(ORDERS)
    for start in range(0, len(letters), CHUNK):
        part = np.frombuffer(letters[start : start + CHUNK + longest - 1], np.uint8).astype(np.uint32)
        first = min(CHUNK, len(letters) - start)
        code, parts = part, []
        for order in range(2, longest + 1):
            # the bytes of the run as one number; of each order by another multiplier
            code = (code[:-1] << np.uint32(8)) | part[order - 1 :]
            if order in ORDERS:
                mixed = (code[:first] + np.uint32(order)) * _FACTOR
                parts.append(mixed >> np.uint32(32 - BUCKET_BITS))
        yield np.concatenate(parts)


def counts_of(letters: bytes) -> np.ndarray:
    total = np.zeros(BUCKETS, np.int64)
    for buckets in subwords(letters):
        total += np.bincount(buckets, minlength=BUCKETS)
    return total


# --- the model ----------------------------------------------------------------


@dataclass
class LanguageModel:
    """``table[bucket]`` has each language's score; ``temperature`` and ``cutoff`` calibrate."""

    languages: list[str] = field(default_factory=list)
    table: np.ndarray | None = None
    bias: np.ndarray | None = None
    temperature: float = 1.0
    cutoff: float = 0.0

    def scores(self, letters: bytes) -> np.ndarray:
        total, n = np.zeros(len(self.languages)), 0
        for buckets in subwords(letters):
            n += len(buckets)
            total += np.bincount(buckets, minlength=BUCKETS) @ self.table
        return total / max(n, 1) + self.bias

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, calibrated probability, and whether it is certain enough."""
        letters = letters_of(text)
        if not letters or not self.languages:
            return UNKNOWN, 0.0, False
        chances = _softmax(self.scores(letters) / self.temperature)
        best = int(np.argmax(chances))
        score = min(1.0, float(chances[best]))
        return self.languages[best], score, score >= self.cutoff


def _softmax(scores: np.ndarray) -> np.ndarray:
    powers = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return powers / powers.sum(axis=-1, keepdims=True)


def _averaged(rows: list[tuple[np.ndarray, np.ndarray]], table: np.ndarray) -> np.ndarray:
    return np.array([(n[:, None] * table[ids]).sum(0) / n.sum() for ids, n in rows])


def learn(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[str], seed: int = 7) -> LanguageModel:
    """Stochastic gradient descent on (bucket ids, counts) and languages, then calibration.

    Of the rows in the given order, each fourth is kept for calibration.
    """
    languages = sorted(set(labels))
    if not languages:
        return LanguageModel()
    target = np.array([languages.index(label) for label in labels])
    spare = np.arange(len(rows)) % 4 == 3
    fitted = np.flatnonzero(~spare)
    generator = np.random.default_rng(seed)
    table = generator.normal(0, 1 / WIDTH, (BUCKETS, WIDTH))
    output, bias = np.zeros((WIDTH, len(languages))), np.zeros(len(languages))
    output += generator.normal(0, 1, output.shape)
    steps = EPOCHS * max(1, -(-len(fitted) // BATCH))
    done = 0
    for _ in range(EPOCHS):
        order = generator.permutation(fitted)
        for start in range(0, len(order), BATCH):
            chosen = order[start : start + BATCH]
            rate = RATE * (1 - done / steps)
            done += 1
            hidden = _averaged([rows[i] for i in chosen], table)
            error = _softmax(hidden @ output + bias)
            error[np.arange(len(chosen)), target[chosen]] -= 1
            back = error @ output.T
            output -= rate * hidden.T @ error / len(chosen)
            bias -= rate * error.mean(0)
            for step, i in zip(back, chosen, strict=True):
                ids, n = rows[i]
                table[ids] -= rate * (n / n.sum())[:, None] * step * WIDTH
    model = LanguageModel(languages, (table @ output).astype(np.float64), bias)
    _calibrate(model, [rows[i] for i in np.flatnonzero(spare)], target[spare])
    return model


def _calibrate(model: LanguageModel, rows: list, target: np.ndarray) -> None:
    """The temperature of least log loss, and the least cutoff that keeps errors under ERROR."""
    if not rows:
        return
    scores = _averaged(rows, model.table) + model.bias
    places = np.arange(len(target))

    def loss(temperature: float) -> float:
        return -float(np.log(_softmax(scores / temperature)[places, target] + 1e-12).mean())

    model.temperature = min(np.geomspace(0.5, 10, 40).tolist(), key=loss)
    chances = _softmax(scores / model.temperature)
    top, wrong = chances.max(1), chances.argmax(1) != target
    order = np.argsort(-top, kind="stable")
    errors = np.cumsum(wrong[order]) / np.arange(1, len(order) + 1)
    safe = np.flatnonzero(errors <= ERROR)
    model.cutoff = float(top[order][safe[-1]]) if len(safe) else 1.0


# --- on tables ----------------------------------------------------------------


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def _counted(batch: pa.RecordBatch) -> pa.RecordBatch:
    ids, counts = [], []
    for text in batch.column("text").to_pylist():
        n = counts_of(letters_of(text))
        own = np.flatnonzero(n)
        ids.append(own.astype(np.int32))
        counts.append(n[own].astype(np.float32))
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id"), batch.column("lang"),
            pa.array(ids, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.float32())),
        ],
        ["doc_id", "lang", "ids", "counts"],
    )


def train(documents: DataFrame, sample: int = SAMPLE) -> LanguageModel:
    """Learn from at most ``sample`` texts with a language, outside of the held-out fold.

    Ids are chosen first, by a hash, without reading a text. The chosen texts are counted by
    tasks; only their bucket counts reach the driver, at most BUCKETS per text.
    """
    narrow = documents.select("doc_id", "lang", "text")
    known = narrow.filter(F.col("lang").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT))
    kind = dict(narrow.dtypes)["doc_id"]
    counted = map_batches(
        sampled(known, "doc_id", sample),
        _counted,
        f"doc_id {kind}, lang string, ids array<int>, counts array<float>",
    )
    rows = counted.toArrow().sort_by([("doc_id", "ascending"), ("lang", "ascending")])
    if not rows.num_rows:
        return LanguageModel()
    rows = rows.combine_chunks()
    ids, counts = (rows.column(c).chunk(0) for c in ("ids", "counts"))
    ends = ids.offsets.to_numpy()
    flat, weights = ids.values.to_numpy(), counts.values.to_numpy()
    spans = list(zip(ends, ends[1:], rows.column("lang").to_pylist(), strict=False))
    found = [((flat[a:b], weights[a:b].astype(float)), lang) for a, b, lang in spans if a < b]
    return learn([row for row, _ in found], [lang for _, lang in found])


def identify(documents: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``documents``: doc_id, held_out, lang_pred, score, accepted.

    A null text, or one without a letter, is ``und`` with score 0 and not accepted; so is
    every text if no row has a language. A null id is in no fold (held_out is false) and is
    not learned from. Repeated rows get equal results. Only the text enters a prediction.
    """
    model = train(documents, sample)

    def predicted(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [model.predict(text) for text in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([row[0] for row in rows], pa.string()),
                pa.array([row[1] for row in rows], pa.float64()),
                pa.array([row[2] for row in rows], pa.bool_()),
            ],
            ["doc_id", "lang_pred", "score", "accepted"],
        )

    kind = dict(documents.dtypes)["doc_id"]
    return map_batches(
        documents.select("doc_id", "text"),
        predicted,
        f"doc_id {kind}, lang_pred string, score double, accepted boolean",
    ).select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
        "accepted",
    )
