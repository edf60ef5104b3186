"""Near-duplicate groups by SimHash and multi-index hashing.

A fingerprint is cut into segments. If two fingerprints differ in at most four bits, then
in one of the segments they differ in no more bits than that segment's radius (else the
differences would add up to more). So each fingerprint enumerates, per segment, the small
Hamming ball around its value, meets the table of all segment values in an equi-join, and
the complete distance decides.

Equal fingerprints are one row before the join, so copies never form pairs. Of two values
that differ in one bit, only the one with the bit unset looks for the other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.llm.batches import map_batches, utf8
from gridlake.llm.components import components
from gridlake.llm.names import unused
from gridlake.sources.tables import materialized

SHINGLE, SEED, DISTANCE = 4, 42, 4
#: (first bit, bits, radius). Differences outside all balls would be 2 + 2 + 1 > DISTANCE.
SEGMENTS = ((0, 22, 1), (22, 22, 1), (44, 20, 0))
#: Shingles held at once.
CHUNK = 1 << 16
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_LANES = np.arange(8) * 256


def _shingles(words: list[bytes]) -> Iterator[bytes]:
    if len(words) < SHINGLE:
        return iter([b" ".join(words)])
    return map(b" ".join, zip(*[words[i:] for i in range(SHINGLE)], strict=False))


def fingerprint(text: bytes) -> int:
    """The SimHash of a UTF-8 text as a signed 64-bit number; 0 without words."""
    words = text.lower().split()  # of bytes: A-Z, and ASCII white space
    if not words:
        return 0
    total = max(1, len(words) - SHINGLE + 1)
    hashes = map(xxhash.xxh64_intdigest, _shingles(words), repeat(SEED))
    counts = np.zeros(64, np.int64)
    for start in range(0, total, CHUNK):
        part = np.fromiter(hashes, np.uint64, min(CHUNK, total - start))
        lanes = part.astype("<u8").view(np.uint8).reshape(-1, 8) + _LANES
        counts += (np.bincount(lanes.ravel(), minlength=2048).reshape(8, 256) @ _BITS).ravel()
    return int(np.packbits(2 * counts > total, bitorder="little").view("<i8")[0])


def _fingerprints(batch: pa.RecordBatch) -> pa.RecordBatch:
    marks = [fingerprint(text) for text in utf8(batch, "text")]
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), batch.column("body"), pa.array(marks, pa.int64())],
        ["doc_id", "body", "mark"],
    )


def fingerprints(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, body, mark) of each row; ``body`` is a hash of the text."""
    narrow = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.xxhash64(F.col(text)).alias("body"),
        F.col(text).alias("text"),
    )
    return map_batches(narrow, _fingerprints, "doc_id long, body long, mark long")


def _segment(mark: Column, first: int, bits: int) -> Column:
    return F.shiftrightunsigned(mark, first).bitwiseAND(F.lit((1 << bits) - 1))


def _table(mark: Column) -> Column:
    return F.array(
        *[
            F.struct(F.lit(i).alias("segment"), _segment(mark, first, bits).alias("value"))
            for i, (first, bits, _) in enumerate(SEGMENTS)
        ]
    )


def _ball(mark: Column) -> Column:
    """The values to look up: each segment's own, and with one more bit set."""
    parts = []
    for i, (first, bits, radius) in enumerate(SEGMENTS):
        value = _segment(mark, first, bits)
        flips = [value.bitwiseOR(F.lit(1 << j)) for j in range(bits)] if radius else []
        entries = [
            F.when((v != value), F.struct(F.lit(i).alias("segment"), v.alias("value"), F.lit(1).alias("apart")))
            for v in flips
        ]
        own = F.struct(F.lit(i).alias("segment"), value.alias("value"), F.lit(0).alias("apart"))
        parts += [own, *entries]
    return F.array_compact(F.array(*parts))


def links(marks: DataFrame) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints, column ``mark``, within DISTANCE bits.

    A pair may come up once per segment that finds it.
    """
    table = marks.select(F.col("mark").alias("b"), F.inline(_table(F.col("mark"))))
    looked_up = marks.select(F.col("mark").alias("a"), F.inline(_ball(F.col("mark"))))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE
    once = (F.col("apart") == 1) | (F.col("a") < F.col("b"))
    return (
        looked_up.join(table, ["segment", "value"])
        .filter(near & once & (F.col("a") != F.col("b")))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    )


def near_duplicates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``documents``: doc_id, body, fingerprint, component_id, n_links, root.

    ``component_id`` is the least id reachable over links of at most DISTANCE bits,
    ``n_links`` the number of other fingerprints linked to the row's own, ``root`` the least
    fingerprint of the group and ``body`` a hash of the row's text. Null, empty and
    blank texts have fingerprint zero, which links like any other. Repeated rows get
    equal results. A null id is never the least; a group of only null ids has a null id.
    """
    marked = materialized(fingerprints(documents, doc_id, text), "marks")
    classes = materialized(
        marked.groupBy("mark").agg(F.min("doc_id").alias("least")), "classes"
    )
    pairs = materialized(links(classes.select("mark")).distinct(), "links")
    roots = components(pairs)
    degrees = (
        pairs.select(F.explode(F.array("a", "b")).alias("node"))
        .groupBy("node")
        .agg(F.count("*").alias("degree"))
    )
    grouped = roots.select("node", "root").unionByName(
        roots.select(F.col("root").alias("node"), "root").distinct()
    )
    linked = classes.join(grouped, F.col("mark") == F.col("node"))
    least = linked.groupBy("root").agg(F.min("least").alias("component"))
    named = (
        linked.join(least, "root")
        .join(degrees.withColumnRenamed("node", "mark"), "mark")
        .select("mark", "component", "degree", "root")
    )
    # stored, so that the join below has two plain sides and adaptive execution can split
    # a fingerprint that very many rows share
    names = materialized(
        classes.join(named, "mark", "left").select(
            "mark",
            F.coalesce("component", "least").alias("component_id"),
            F.coalesce("degree", F.lit(0)).alias("n_links"),
            F.coalesce("root", "mark").alias("root"),
        ),
        "names",
    )
    return marked.join(names, "mark").select(
        "doc_id",
        "body",
        F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint"),
        "component_id",
        "n_links",
        "root",
    )


def one_per_group(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` that stay: one of each group, the one with its least id.

    Among rows with a group's least id, or in a group without ids, any one of equal rows is
    kept; if their texts differ, that with the least text hash.
    """
    groups = materialized(near_duplicates(documents), "groups")
    least = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    stay = materialized(
        least.groupBy("root").agg(F.min(F.struct("doc_id", "body")).alias("row"), F.count("*").alias("n")),
        "stay",
    )
    row_id, body, root = unused(documents, "row_id", "body", "root")
    kept = stay.select(
        F.col("row.doc_id").alias(row_id), F.col("row.body").alias(body), F.col("root").alias(root)
    )
    chosen = documents.join(
        kept,
        documents["doc_id"].eqNullSafe(F.col(row_id))
        & (F.xxhash64(documents["text"]) == F.col(body)),
    )
    if not stay.filter("n > 1").isEmpty():  # repeated rows: one of them
        chosen = chosen.dropDuplicates([root])
    return chosen.select(*documents.columns)
