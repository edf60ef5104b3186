"""Removal of long byte strings that a corpus has already had.

A byte goes if a string of SPAN bytes around it also starts earlier: in a document before
(by id) or before in the same one. Which strings are equal is read off a suffix order built
blockwise (``suffixes``), one bucket of suffixes at a time:

1. A suffix's bucket is the least hash among the GRAM-byte runs of its first SPAN bytes.
   Equal strings meet in one bucket, and neighbouring suffixes mostly share theirs, so what
   is moved is pieces: the bytes of a run of suffixes with one bucket.
2. Buckets with a single piece hold no repeat. Of equal pieces (by 128 hash bits) only the
   earliest goes on; all others lie wholly in a copy and are removed.
3. Tasks take whole buckets, some BLOCK bytes at a time, put their suffixes in order and find
   those with an earlier equal. A bucket of more than BUCKET_PIECES different pieces, such as
   the edge of a passage that very many texts share, is not brought together: its suffixes
   are buckets of their own, and an aggregate finds the earliest of each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import cache
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.llm.batches import map_partitions, utf8
from gridlake.llm.suffixes import SPAN, _dense, later_copies
from gridlake.sources.tables import materialized

GRAM = 32
#: Suffixes of a piece at most: so many share the run with the least hash.
WIDTH = SPAN - GRAM + 1
#: Suffixes cut at once, and the bits that number them.
CHUNK, _BITS = 1 << 20, 20
#: Bytes of texts hashed together, unless one has more: texts are short, and a call of numpy takes as long as some KB.
JOINED = 1 << 17
#: Bytes of pieces sorted together, unless one bucket has more: sorting takes some fifty times as many.
BLOCK = 1 << 20
BUCKET_PIECES = 20_000
#: Bytes of a batch of rows in the stored steps. Both Spark and Python hold some batches of each task at once.
BATCH_BYTES = 4 << 20
_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)
_WORD = 8


# --- pieces of texts ----------------------------------------------------------


@cache
def _powers(base: int) -> np.ndarray:
    powers = np.full(CHUNK + SPAN, base, np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each GRAM-byte run."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(np.add(data, 1, dtype=np.uint64) * _powers(_BASE)[:n], out=sums[1:])
    x = sums[GRAM:] - sums[:-GRAM]
    x *= _powers(pow(_BASE, -1, 1 << 64))[: n - GRAM + 1]
    for _ in range(2):
        x ^= x >> np.uint64(32)
        x *= _MIX
    x ^= x >> np.uint64(32)
    return x


def _window_least(values: np.ndarray, width: int) -> np.ndarray:
    least, reach = values, 1
    while reach * 2 <= width:
        least, reach = np.minimum(least[:-reach], least[reach:]), reach * 2
    rest = width - reach
    return np.minimum(least[:-rest], least[rest:]) if rest else least


def _piece_hashes(data: bytes, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each piece: its words in turn, the last one as it ends."""
    words = np.ndarray((len(data) - _WORD + 1,), "<u8", data, strides=(1,))
    last = n + (SPAN - 1 - _WORD)
    x = n.astype(np.uint64) * np.uint64(_BASE)
    for at in range(0, WIDTH + SPAN - 1, _WORD):
        x ^= words[first + np.minimum(at, last)]
        x *= _MIX
        x ^= x >> np.uint64(32)
    return x.view(np.int64)


def _slices(texts: Sequence[bytes]) -> Iterator[list[tuple[int, int, bytes]]]:
    """Slices (text, first byte, bytes) of at most CHUNK suffixes, some JOINED bytes of them at a time."""
    held: list[tuple[int, int, bytes]] = []
    size = 0
    for i, text in enumerate(texts):
        for at in range(0, len(text) - SPAN + 1, CHUNK - WIDTH):
            own = text[at : at + CHUNK - WIDTH + SPAN - 1]
            if held and size + len(own) > min(JOINED, CHUNK):
                yield held
                held, size = [], 0
            held.append((i, at, own))
            size += len(own)
    if held:
        yield held


class Pieces(NamedTuple):
    """Pieces of some texts, in the texts' order and that of each text."""

    text: np.ndarray
    bucket: np.ndarray
    #: A hash of the piece's bytes, if asked for.
    key: np.ndarray
    #: First suffix and number of suffixes.
    start: np.ndarray
    n: np.ndarray


def cut(texts: Sequence[bytes], keyed: bool = False) -> Pieces:
    """The pieces of each text.

    A suffix's run is the one with the least hash, the leftmost of equal ones. A piece ends
    where the run changes. Texts are joined to be hashed; no suffix that counts reaches into
    the next one, and a hash does not depend on where its run stands.
    """
    found = []
    for held in _slices(texts):
        data = b"".join(own for _, _, own in held)
        text, at, sizes = np.array([(i, at, len(own)) for i, at, own in held]).T
        hashes = _gram_hashes(np.frombuffer(data, np.uint8))
        order = hashes >> np.uint64(_BITS) << np.uint64(_BITS)
        order |= np.arange(len(hashes), dtype=np.uint64)
        suffixes = sizes - (SPAN - 1)
        ends, begins = np.cumsum(suffixes), np.cumsum(sizes) - sizes
        places = np.arange(ends[-1]) + np.repeat(begins - ends + suffixes, suffixes)
        run = _window_least(order, WIDTH)[places] & np.uint64(CHUNK - 1)
        begin = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
        n, first = np.diff(np.append(begin, len(run))), places[begin]
        part = np.searchsorted(ends, begin, side="right")
        key = _piece_hashes(data, first, n) if keyed else np.zeros(len(n), np.int64)
        bucket = hashes[run[begin].astype(np.int64)].view(np.int64)
        found.append((text[part], bucket, key, first - begins[part] + at[part], n))
    if not found:
        return Pieces(*(np.zeros(0, np.int64) for _ in Pieces._fields))
    return Pieces(*(np.concatenate(column) for column in zip(*found, strict=True)))


def pieces_of(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket, first suffix and number of suffixes of each piece, in text order."""
    own = cut([text])
    return own.bucket, own.start, own.n


def own_repeats(texts: Sequence[bytes]) -> list[list[tuple[int, int]]]:
    """Per text, begin and end of the pieces that it had before."""
    found: list[list[tuple[int, int]]] = [[] for _ in texts]
    all_pieces = cut(texts)
    order = np.argsort(all_pieces.bucket, kind="stable")  # of one bucket the texts ascend
    new = _dense(order, [all_pieces.bucket, all_pieces.text])
    # a text that has a bucket once does not repeat its piece
    often = np.sort(order[~(new & np.append(new[1:], True))])
    seen = set()
    for i, start, n in zip(*(c[often].tolist() for c in (all_pieces.text, all_pieces.start, all_pieces.n)), strict=True):
        stop = start + n + SPAN - 1
        own = i, xxhash.xxh3_128_intdigest(texts[i][start:stop])
        if own in seen:
            found[i].append((start, stop))
        seen.add(own)
    return found


# --- tables -------------------------------------------------------------------

_ROW = "doc_id {0}, body long"
_SHIFT = 7  # a piece's first suffix and its number of suffixes, below 128, as one number


@contextmanager
def _held(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting for what is run inside."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as stored. Its shuffle files go when that has ended, and its batches are small."""
    spark = df.sparkSession
    freed = _held(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    with freed, _held(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES)):
        return materialized(df, name)


def _take(batch: pa.RecordBatch, index: Sequence[int] | np.ndarray) -> list[pa.Array]:
    rows = pa.array(index, pa.int64())
    return [batch.column(name).take(rows) for name in ("doc_id", "body")]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of each text, each one the first time the text has it."""
    for batch in batches:
        own = cut(utf8(batch, "text"), keyed=True)
        order = np.argsort(own.key, kind="stable")  # of one key the texts ascend
        first = np.sort(order[_dense(order, [own.key, own.bucket, own.text])])
        own = Pieces(*(column[first] for column in own))
        columns = own.bucket, own.key, own.start << _SHIFT | own.n
        yield pa.RecordBatch.from_arrays(
            [*_take(batch, own.text), *[pa.array(c, pa.int64()) for c in columns]],
            ["doc_id", "body", "bucket", "piece", "place"],
        )


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The buckets of each batch with their pieces."""
    for batch in batches:
        buckets, counts = np.unique(cut(utf8(batch, "text")).bucket, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(buckets), pa.array(counts)], ["bucket", "pieces"])


def _same(left: str, right: str) -> Column:
    a, b = (lambda c, t=t: F.col(f"{t}.{c}") for t in (left, right))
    return a("doc_id").eqNullSafe(b("doc_id")) & (a("body") == b("body"))


def _pieces(texts: DataFrame, kind: str) -> DataFrame:
    """Pieces whose bucket has more than one: doc_id, body, bucket, piece, place."""
    schema = f"{_ROW.format(kind)}, bucket long, piece long, place long"
    counted = map_partitions(texts, _counted, "bucket long, pieces long").groupBy("bucket")
    often = counted.agg(F.sum("pieces").alias("pieces")).filter("pieces > 1")
    shared = _stored(often.select("bucket"), "buckets")
    return _stored(map_partitions(texts, _cut, schema).join(shared, "bucket"), "pieces")


def _wanted(texts: DataFrame, places: DataFrame) -> DataFrame:
    """The texts that ``places`` has pieces of, with them."""
    grouped = places.groupBy("doc_id", "body").agg(F.collect_list(F.struct("bucket", "place")).alias("wanted"))
    return texts.alias("t").join(grouped.alias("w"), _same("t", "w")).select("t.doc_id", "t.body", "text", "wanted")


def _fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted pieces."""
    for batch in batches:
        index, rows = [], []
        for i, (text, wanted) in enumerate(zip(utf8(batch, "text"), batch.column("wanted").to_pylist(), strict=True)):
            for piece in wanted:
                start, n = piece["place"] >> _SHIFT, piece["place"] & (1 << _SHIFT) - 1
                index.append(i)
                rows.append((piece["bucket"], start, text[start : start + n + SPAN - 1]))
        buckets, starts, data = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [
                *_take(batch, index),
                pa.array(buckets, pa.int64()),
                pa.array(starts, pa.int64()),
                pa.array(data, pa.binary()),
            ],
            ["doc_id", "body", "bucket", "start", "data"],
        )


def _runs(later: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each run of true values; a run ends where a piece (``first``) begins."""
    begin = later & (first | ~np.concatenate([[False], later[:-1]]))
    end = later & np.concatenate([first[1:] | ~later[1:], [True]])
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def _sorted_block(rows: pa.Table) -> pa.RecordBatch:
    """(doc_id, body, start, stop) of the bytes of these pieces that came earlier."""
    data = rows.column("data").to_pylist()
    owners = list(zip(rows.column("doc_id").to_pylist(), rows.column("body").to_pylist(), strict=True))
    order = sorted(set(owners), key=lambda owner: (owner[0] is not None, *owner))
    rank = {owner: i for i, owner in enumerate(order)}
    owner = np.array([rank[o] for o in owners], np.int64)
    start = rows.column("start").to_numpy()
    sizes = np.array([len(x) for x in data], np.int64)
    suffixes = sizes - SPAN + 1
    ends = np.cumsum(suffixes)
    local = np.arange(ends[-1]) - np.repeat(ends - suffixes, suffixes)
    places = np.repeat(np.cumsum(sizes) - sizes, suffixes) + local
    begins = np.repeat(start, suffixes) + local
    later = later_copies(b"".join(data), places, np.repeat(owner, suffixes), begins)
    a, b = _runs(later, local == 0)
    piece = pa.array(np.searchsorted(ends, a, side="right"))
    return pa.RecordBatch.from_arrays(
        [
            rows.column("doc_id").take(piece).combine_chunks(),
            rows.column("body").take(piece).combine_chunks(),
            pa.array(begins[a]),
            pa.array(begins[b - 1] + SPAN),
        ],
        ["doc_id", "body", "start", "stop"],
    )


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in slices of one bucket each; a bucket may take several."""
    for batch in batches:
        buckets = batch.column("bucket").to_numpy()
        edges = [0, *np.flatnonzero(buckets[1:] != buckets[:-1]) + 1, batch.num_rows]
        for begin, end in zip(edges, edges[1:], strict=False):
            yield batch.slice(begin, end - begin)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole buckets, some BLOCK bytes at a time, of rows that come ordered by bucket."""
    held: list[pa.RecordBatch] = []
    size, last = 0, None
    for part in _by_bucket(batches):
        bucket = part.column("bucket")[0]
        if size >= BLOCK and bucket != last:
            yield _sorted_block(pa.Table.from_batches(held))
            held, size = [], 0
        held.append(part)
        size, last = size + part.column("data").nbytes, bucket
    if held:
        yield _sorted_block(pa.Table.from_batches(held))


def _single_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The suffixes of fetched pieces by two hashes of their SPAN bytes."""
    for batch in batches:
        index, rows = [], []
        columns = (batch.column(name).to_pylist() for name in ("start", "data"))
        for i, (start, data) in enumerate(zip(*columns, strict=True)):
            for at in range(len(data) - SPAN + 1):
                digest = xxhash.xxh3_128_intdigest(data[at : at + SPAN])
                index.append(i)
                rows.append(((digest >> 64) - (1 << 63), (digest & (1 << 64) - 1) - (1 << 63), start + at))
        columns = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [*_take(batch, index), *[pa.array(c, pa.int64()) for c in columns]],
            ["doc_id", "body", "high", "low", "start"],
        )


def _later(rows: DataFrame, key: list[str], place: str) -> DataFrame:
    """Rows that are not the earliest of their key, by id (null first), body and place."""
    first = rows.groupBy(*key).agg(F.min(F.struct("doc_id", "body", place)).alias("first"))
    return _not_first(rows, first, key, place)


def _not_first(rows: DataFrame, first: DataFrame, key: list[str], place: str) -> DataFrame:
    own = F.struct("doc_id", "body", place)
    return rows.join(first.select(*key, "first"), key).filter(~own.eqNullSafe(F.col("first")))


def _span(start: Column, n: Column) -> list[Column]:
    return [F.col("doc_id"), F.col("body"), start.alias("start"), (start + n + (SPAN - 1)).alias("stop")]


def repeated_spans(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, body, start, stop), stored: byte ranges that other rows have had earlier.

    Ranges may overlap. What a text repeats of itself piece by piece is not listed here.
    """
    kind = documents.schema[doc_id].dataType.simpleString()
    texts = _narrow(documents, doc_id, text).filter(F.octet_length("text") >= SPAN)
    pieces = _pieces(texts, kind)
    key = ["bucket", "piece"]
    first = _stored(
        pieces.groupBy(*key).agg(F.min(F.struct("doc_id", "body", "place")).alias("first")), "first_pieces"
    )
    start, n = F.shiftright("place", _SHIFT), F.col("place").bitwiseAND((1 << _SHIFT) - 1)
    spans = _stored(_not_first(pieces, first, key, "place").select(*_span(start, n)), "spans")
    sizes = _stored(first.groupBy("bucket").count().filter("count > 1"), "sizes")
    met = _stored(first.join(sizes, "bucket").select("bucket", "first.*", "count"), "met")
    fetched = f"{_ROW.format(kind)}, bucket long, start long, data binary"
    small = met.filter(F.col("count") <= BUCKET_PIECES)
    grouped = map_partitions(_wanted(texts, small), _fetched, fetched).repartition("bucket")
    sorted_spans = map_partitions(
        grouped.sortWithinPartitions("bucket"), _blocks, f"{_ROW.format(kind)}, start long, stop long", 5000
    )
    spans = spans.unionByName(_stored(sorted_spans, "spans"))
    large = met.filter(F.col("count") > BUCKET_PIECES)
    if not large.isEmpty():
        single = map_partitions(
            map_partitions(_wanted(texts, large), _fetched, fetched),
            _single_suffixes,
            f"{_ROW.format(kind)}, high long, low long, start long",
        )
        later = _later(_stored(single, "suffixes"), ["high", "low"], "start")
        spans = spans.unionByName(_stored(later.select(*_span(F.col("start"), F.lit(1))), "spans"))
    return spans


def _narrow(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    return documents.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("body"), F.col(text).alias("text")
    )


def kept_bytes(
    text: bytes, spans: list[dict[str, Any]], own: list[tuple[int, int]] | None = None
) -> tuple[bytes, int]:
    """What is left of a text without the spans and its own repeated pieces, and the runs removed.

    ``own`` gives the latter, as ``own_repeats`` has found them for many texts at once.
    """
    cuts = [(span["start"], span["stop"]) for span in spans]
    cuts += own_repeats([text])[0] if own is None else own
    kept, runs, reach = [], 0, None
    for start, stop in sorted(cuts):
        if reach is None or start > reach:
            kept.append(text[reach or 0 : start])
            runs, reach = runs + 1, stop
        else:
            reach = max(reach, stop)
    kept.append(text[reach or 0 :])
    return b"".join(kept), runs


def without_repeats(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``documents``: doc_id, body, n_bytes, n_removed, n_spans, kept, kept_sha256.

    ``kept`` is the bytes that stay, which need not be valid UTF-8: matches are of bytes.
    Null texts are empty; texts under SPAN bytes lose nothing. A null id comes before all
    others. Rows with one id and one text are one document and get equal results; rows with
    one id and different texts are documents ordered by the texts' hash. An empty table
    gives no rows; other columns are not looked at.
    """
    kind = documents.schema[doc_id].dataType.simpleString()
    spans = repeated_spans(documents, doc_id, text)
    per_text = _stored(
        spans.groupBy("doc_id", "body").agg(F.collect_set(F.struct("start", "stop")).alias("spans")), "removed"
    )
    texts = _narrow(documents, doc_id, text).alias("t")
    joined = texts.join(per_text.alias("s"), _same("t", "s"), "left").select("t.doc_id", "t.body", "text", "spans")

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            texts = utf8(batch, "text")
            for data, cuts, own in zip(texts, batch.column("spans").to_pylist(), own_repeats(texts), strict=True):
                kept, runs = kept_bytes(data, cuts or [], own)
                rows.append((len(data), len(data) - len(kept), runs, kept, hashlib.sha256(kept).hexdigest()))
            names = ("n_bytes", "n_removed", "n_spans", "kept", "kept_sha256")
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string())
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("body"), *columns], ["doc_id", "body", *names]
            )

    schema = f"{_ROW.format(kind)}, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"
    return map_partitions(joined, cleaned, schema)
