"""Ranked lexical search with hashed max-sketches.

A term's impact in a text depends on the text alone; its weight on the corpus. A text's
sketch has a fixed number of cells, each the greatest impact of the terms hashed to it, so
the weighted cells of a query's terms add up to no less than its score. Cells above zero are
stored; a batch of sketches and a block of queries meet in one sparse product.

1. Count what the weights need, then store a sketch per text.
2. Rounds: take the next candidates of each query in descending bound, as far as their bound
   reaches the query's current tenth score, and score them exactly by their whole texts.
   Rounds grow and the last one takes all that is left, so nothing is cut off.

Equal texts have equal scores, so a text is scored once, and of its rows only the first
``top`` by id can be in a result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from gridlake.llm.batches import map_batches, map_partitions, utf8
from gridlake.sources.tables import materialized

TOP = 10
#: Cells of a sketch, and the step impacts are rounded up to (the largest is below 10**6).
CELLS, STEP = 1 << 16, 16
#: Sketches whose bounds are computed at once.
GROUP = 64
#: Candidates per query up to each round; None takes all that can still win.
ROUNDS = (32, 256, None)
#: Queries looked up at once: with ROUNDS this bounds the candidates that are broadcast.
BLOCK = 256
_WORD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    """Runs of digits, letters and non-ASCII characters of a UTF-8 text, A-Z lower-cased."""
    return text.translate(_WORD).split()


@dataclass
class Corpus:
    """Texts with a term, their terms with repeats, and the texts that hold a query's term."""

    texts: int
    terms: int
    holding: dict[bytes, int] = field(default_factory=dict)

    def weight(self, term: bytes) -> int:
        return math.floor(1000 * math.log((2 * self.texts + 2) / (2 * self.holding.get(term, 0) + 1)))

    def length(self, n: int) -> int:
        return 25 + 75 * n * self.texts // self.terms


def _impact(tf: Any, length: int) -> Any:
    return 1_000_000_000 * tf // (1000 * tf + 8 * length)


def _cells(terms: Sequence[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh32_intdigest, terms), np.int64, len(terms)) % CELLS


def sketch(counts: Counter[bytes], corpus: Corpus) -> tuple[np.ndarray, np.ndarray]:
    """The cells above zero and the greatest rounded-up impact of each."""
    tf = np.fromiter(counts.values(), np.int64, len(counts))
    impacts = -(-_impact(tf, corpus.length(int(tf.sum()))) // STEP)
    order = np.argsort(impacts, kind="stable")
    cells, last = np.unique(_cells(list(counts))[order][::-1], return_index=True)
    return cells.astype(np.uint16), impacts[order][::-1][last].astype(np.uint16)


def score(query: Counter[bytes], counts: Counter[bytes], corpus: Corpus) -> int:
    length = corpus.length(counts.total())
    return sum(
        n * corpus.weight(term) * _impact(counts[term], length)
        for term, n in query.items()
        if term in counts
    )


@dataclass
class Lookups:
    """Per cell, the queries that look it up with their weights there."""

    queries: int
    start: np.ndarray
    query: np.ndarray
    weight: np.ndarray

    @classmethod
    def of(cls, queries: Sequence[Counter[bytes]], corpus: Corpus) -> Lookups:
        cell, query, weight = [], [], []
        for i, terms in enumerate(queries):
            cell += _cells(list(terms)).tolist()
            query += [i] * len(terms)
            weight += [n * corpus.weight(term) * STEP for term, n in terms.items()]
        order = np.argsort(np.array(cell, np.int64), kind="stable")
        start = np.concatenate([[0], np.cumsum(np.bincount(np.array(cell, np.int64), minlength=CELLS))])
        return cls(len(queries), start, np.array(query, np.int64)[order], np.array(weight, float)[order])

    def bounds(self, sketches: Sequence[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """A row per query, a column per sketch: sums of whole numbers, exact in doubles."""
        cells = np.concatenate([x for x, _ in sketches]).astype(np.int64)
        impacts = np.concatenate([x for _, x in sketches]).astype(float)
        owner = np.repeat(np.arange(len(sketches)), [len(x) for x, _ in sketches])
        fan = self.start[cells + 1] - self.start[cells]
        begin = np.repeat(self.start[cells] - np.cumsum(fan) + fan, fan)
        entry = begin + np.arange(len(begin))
        place = self.query[entry] * len(sketches) + np.repeat(owner, fan)
        values = self.weight[entry] * np.repeat(impacts, fan)
        return np.bincount(place, values, self.queries * len(sketches)).reshape(self.queries, -1)


# --- on tables ----------------------------------------------------------------


def measure(documents: DataFrame, vocabulary: frozenset[bytes]) -> Corpus:
    """The counts over all texts; what comes back is one row per term of ``vocabulary``."""
    order = sorted(vocabulary)
    number = {term: i for i, term in enumerate(order)}

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[int] = Counter()
        for batch in batches:
            for text in utf8(batch, "text"):
                terms = terms_of(text)
                found[-1] += bool(terms)
                found[-2] += len(terms)
                found.update(number[term] for term in vocabulary.intersection(terms))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())],
            ["term", "n"],
        )

    rows = map_partitions(documents.select("text"), counted, "term long, n long")
    sums = {row["term"]: row["n"] for row in rows.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    texts, terms = sums.pop(-1, 0), sums.pop(-2, 0)
    return Corpus(texts, terms, {order[i]: n for i, n in sums.items()})


def sketches(texts: DataFrame, corpus: Corpus) -> DataFrame:
    """(body, cells, impacts) of each text with a term, stored; an index for any queries."""

    def folded(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, cells, impacts = [], [], []
        for i, text in enumerate(utf8(batch, "text")):
            if counts := Counter(terms_of(text)):
                own.append(i)
                for column, values in zip((cells, impacts), sketch(counts, corpus), strict=True):
                    column.append(values.tobytes())
        return pa.RecordBatch.from_arrays(
            [
                batch.column("body").take(pa.array(own, pa.int64())),
                pa.array(cells, pa.binary()),
                pa.array(impacts, pa.binary()),
            ],
            ["body", "cells", "impacts"],
        )

    folded_texts = map_batches(texts, folded, "body string, cells binary, impacts binary")
    return materialized(folded_texts, "sketches")


def _top(bounds: np.ndarray, n: int) -> np.ndarray:
    """Per row, the places of its n greatest values."""
    if bounds.shape[1] <= n:
        return np.tile(np.arange(bounds.shape[1]), (len(bounds), 1))
    return np.argpartition(-bounds, n - 1, axis=1)[:, :n]


Lookup = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _candidates(table: Lookups, least: np.ndarray, limit: int | None) -> Lookup:
    """Candidates (query, body, bound) of a partition, bound at least ``least``.

    With a limit, only the partition's greatest of each query.
    """

    def rows(bounds: np.ndarray, bodies: np.ndarray) -> pa.RecordBatch:
        query, place = np.nonzero(bounds > 0)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(query, pa.int32()),
                pa.array(bodies[query, place], pa.string()),
                pa.array(bounds[query, place].astype(np.int64), pa.int64()),
            ],
            ["query", "body", "bound"],
        )

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, names = np.zeros((table.queries, 0)), np.zeros((table.queries, 0), object)
        seen: set[str] = set()  # as many as the partition has texts
        for batch in batches:
            bodies = batch.column("body").to_pylist()
            fresh = [i for i, body in enumerate(bodies) if not (body in seen or seen.add(body))]
            if not fresh:
                continue
            stored = (batch.column(c).take(pa.array(fresh)).to_pylist() for c in ("cells", "impacts"))
            pairs = zip(*([np.frombuffer(x, np.uint16) for x in column] for column in stored), strict=True)
            bounds = table.bounds(list(pairs))
            bounds[bounds < least[:, None]] = 0
            wide = np.broadcast_to(np.array([bodies[i] for i in fresh], object), bounds.shape)
            if limit is None:
                yield rows(bounds, wide)
                continue
            best, names = np.hstack([best, bounds]), np.hstack([names, wide])
            chosen = _top(best, limit)
            best, names = (np.take_along_axis(x, chosen, axis=1) for x in (best, names))
        yield rows(best, names)

    return candidates


def _scored(
    texts: DataFrame, holders: DataFrame, pairs: DataFrame, queries: Sequence[Counter[bytes]], corpus: Corpus, few: bool
) -> DataFrame:
    """(query, body, score) of stored pairs (query, body), from one row of each text; stored.

    ``few`` pairs, no more than BLOCK times the round's limit, are sent to where the texts are.
    """
    wanted = (
        pairs.groupBy("body")
        .agg(F.collect_list("query").alias("queries"))
        .join(holders.filter("nth = 1"), "body")
        .select(F.col("body").alias("wanted"), F.col("doc_id").alias("holder"), "queries")
    )
    side = F.broadcast(wanted) if few else wanted
    same = (F.col("body") == F.col("wanted")) & F.col("doc_id").eqNullSafe(F.col("holder"))

    def exact(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        columns = (batch.column("body").to_pylist(), utf8(batch, "text"), batch.column("queries").to_pylist())
        for body, text, asked in zip(*columns, strict=True):
            counts = Counter(terms_of(text))
            rows += [(i, body, score(queries[i], counts, corpus)) for i in asked]
        query, body, points = zip(*rows, strict=True) if rows else ([], [], [])
        return pa.RecordBatch.from_arrays(
            [pa.array(query, pa.int32()), pa.array(body, pa.string()), pa.array(points, pa.int64())],
            ["query", "body", "score"],
        )

    picked = texts.join(side, same).select("body", "text", "queries")
    found = map_batches(picked, exact, "query int, body string, score long")
    return materialized(found.filter("score > 0").distinct(), "scored")


def _ranked(scored: DataFrame, holders: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(
        F.desc("score"), F.col("doc_id").asc_nulls_last(), "body", "nth"
    )
    ranked = scored.join(holders, "body").withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= top)


def _blocks(items: Iterator[Row], size: int) -> Iterator[list[Row]]:
    block: list[Row] = []
    for row in items:
        block.append(row)
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block


def search(
    documents: DataFrame, items: DataFrame, top: int = TOP, doc_id: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """item_id, rank, doc_id, score: each query's ``top`` rows of ``documents``, score above 0.

    Null and empty texts, and those without a term, are found by no query and find nothing; an
    empty table gives no rows. Each row counts and ranks by itself, repeated rows too; equal
    scores go by id, null ids last, then by text. A repeated query row is a query of
    its own. Other columns are not looked at. Queries are read block by block, and
    every block is looked up in all sketches.
    """
    spark = documents.sparkSession
    texts = documents.filter(F.col(text).isNotNull()).select(
        F.col(doc_id).alias("doc_id"), F.sha2(F.col(text), 256).alias("body"), F.col(text).alias("text")
    )
    first = Window.partitionBy("body").orderBy(F.col("doc_id").asc_nulls_last())
    holders = materialized(
        texts.select("doc_id", "body").withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= top),
        "holders",
    )
    item_kind = items.schema[item].dataType.simpleString()
    asked = items.select(F.col(item).alias("item_id"), F.encode(F.coalesce(F.col(item_text), F.lit("")), "UTF-8").alias("text"))
    index = None
    results = []
    for block in _blocks(asked.toLocalIterator(), BLOCK):
        queries = [Counter(terms_of(bytes(row["text"]))) for row in block]
        corpus = measure(texts, frozenset().union(*queries))
        if not corpus.texts:
            break
        if index is None:
            index = sketches(texts, corpus)
        found = _search_block(index, texts, holders, queries, corpus, top)
        names = spark.createDataFrame([(i, row["item_id"]) for i, row in enumerate(block)], f"query int, item_id {item_kind}")
        results.append(
            materialized(
                found.join(F.broadcast(names), "query").select(
                    "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"
                ),
                "ranked",
            )
        )
    if not results:
        kind = documents.schema[doc_id].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {item_kind}, rank int, doc_id {kind}, score long")
    union = results[0]
    for result in results[1:]:
        union = union.unionByName(result)
    return union


def _search_block(
    index: DataFrame, texts: DataFrame, holders: DataFrame, queries: Sequence[Counter[bytes]], corpus: Corpus, top: int
) -> DataFrame:
    """(query, rank, doc_id, score, ..) of the block's queries."""
    table = Lookups.of(queries, corpus)
    least = np.ones(len(queries), np.int64)
    scored = done = None
    for limit in ROUNDS:
        reach = _candidates(table, least, limit)
        pairs = map_partitions(index, reach, "query int, body string, bound long", GROUP).distinct()
        if limit is not None:
            order = Window.partitionBy("query").orderBy(F.desc("bound"), "body")
            pairs = pairs.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= limit)
        pairs = materialized(pairs.select("query", "body"), "candidates")
        new = pairs if done is None else pairs.join(done, ["query", "body"], "left_anti")
        fresh = _scored(texts, holders, new, queries, corpus, limit is not None)
        scored = fresh if scored is None else scored.unionByName(fresh)
        if limit is None or pairs.groupBy("query").count().filter(F.col("count") >= limit).isEmpty():
            break  # no query has a candidate left
        done = pairs  # a longer list in descending bound begins with these
        for row in _ranked(scored, holders, top).filter(F.col("rank") == top).collect():
            least[row["query"]] = row["score"]
    return _ranked(scored, holders, top)
