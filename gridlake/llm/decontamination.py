"""Words of a corpus that also stand in a benchmark, found by winnowing.

A benchmark window is ``window`` consecutive words of an item, or all words of a shorter
item. Of each window the least hash among its ``gram``-word runs is its fingerprint. A
text that holds the window has the same runs in it, hence the same least hash, so no
shared window can be missed. Fingerprints only choose where to look: a hit counts if the
words themselves are equal.

1. Each text's distinct fingerprints meet those of the benchmark (semi join).
2. In the texts that share one, the windows with a shared fingerprint are compared
   word by word, and overlapping hits are merged into spans.

Rows are told apart by id and a hash of the text, so repeated ids do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions.frames import evaluated_once
from gridlake.llm.names import unused
from gridlake.llm.words import alnum_words, hashes, windowed
from gridlake.sources.tables import materialized

WINDOW, GRAM = 13, 8


def _least(*values: Column) -> Column:
    return F.least(*values) if len(values) > 1 else values[0]


def _fingerprints(df: DataFrame, span: int, gram: int, name: str) -> DataFrame:
    """Adds, for each run of ``span`` words, its least hash of ``gram`` words.

    Needs the columns ``words`` and ``hashed``; element i belongs to the run from word i.
    """
    gram = min(gram, span)
    kept = tuple(df.columns)
    runs = evaluated_once(
        df, windowed(F.col("hashed"), gram, F.xxhash64, "bigint").alias("runs"), keep=kept
    )
    return evaluated_once(
        runs, windowed(F.col("runs"), span - gram + 1, _least, "bigint").alias(name), keep=kept
    )


def _places(marks: str) -> Column:
    """The positions whose fingerprint is among the column ``shared``."""
    at = F.transform(marks, lambda mark, i: F.when(F.array_contains("shared", mark), i))
    return F.array_compact(at)


def _at(places: str, n: int) -> Column:
    """The ``n`` words from each of the places on, where the text has as many."""

    def window(start: Column) -> Column:
        words = F.concat_ws(" ", *[F.get("words", start + j) for j in range(n)])
        return F.struct(start.alias("start"), F.lit(n).alias("n"), words.alias("win"))

    fits = F.filter(places, lambda start: start + n <= F.size("words"))
    return F.transform(fits, window)


def _joined(size: int) -> Column:
    """The ``size`` words from each position on, as text."""
    return windowed(F.col("words"), size, lambda *w: F.concat_ws(" ", *w), "string")


def _shortest(items: DataFrame, window: int) -> int | None:
    """The words of the shortest item that is no full window: one number."""
    size = F.size("words")
    return items.agg(F.min(F.when((size > 0) & (size < window), size))).first()[0]


def benchmark_windows(
    benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM, item: str = "item_id",
    text: str = "text",
) -> tuple[DataFrame, int | None]:
    """Each item's windows (item, win, n, mark) and the length of the shortest short item.

    ``win`` is the words, ``n`` their number, ``mark`` the fingerprint. A null item id
    counts as one item with an empty name. Short items share one span, that of the
    shortest of them: any text with the whole item has the item's first words.
    """
    items = benchmark.select(
        F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"),
        alnum_words(F.col(text)).alias("words"),
    )
    shortest = _shortest(items, window)
    split = evaluated_once(items, F.col("words"), keep=("item",))
    split = evaluated_once(split, hashes(F.col("words")).alias("hashed"), keep=("item", "words"))
    full = _fingerprints(split, window, gram, "marks").select(
        "item", F.inline(F.arrays_zip(_joined(window).alias("win"), F.col("marks").alias("mark")))
    )
    windows = full.select("item", "win", F.lit(window).alias("n"), "mark")
    if shortest is not None:
        short = _fingerprints(
            split.filter(F.size("words").between(1, window - 1)), shortest, gram, "marks"
        )
        windows = windows.unionByName(
            short.select(
                "item",
                F.concat_ws(" ", "words").alias("win"),
                F.size("words").alias("n"),
                F.get("marks", F.lit(0)).alias("mark"),
            )
        )
    return materialized(windows.distinct(), "windows"), shortest


def _marked(docs: DataFrame, window: int, gram: int, shortest: int | None) -> DataFrame:
    """Adds ``marks`` (by window start) and ``short`` (the same for short items)."""
    kept = tuple(docs.columns)
    split = evaluated_once(docs, alnum_words(F.col("text")).alias("words"), keep=kept)
    split = evaluated_once(split, hashes(F.col("words")).alias("hashed"), keep=(*kept, "words"))
    marked = _fingerprints(split, window, gram, "marks")
    if shortest is None:
        return marked.withColumn("short", F.array().cast("array<bigint>"))
    return _fingerprints(marked, shortest, gram, "short")


def _same(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["body"] == right["body"])


def _covered(spans: Column) -> Column:
    """The words in the union of sorted (start, n) spans."""
    zero = F.struct(F.lit(0).alias("total"), F.lit(0).alias("reach"))
    return F.aggregate(
        spans,
        zero,
        lambda acc, s: F.struct(
            (acc["total"] + F.greatest(F.lit(0), s["start"] + s["n"] - F.greatest(acc["reach"], s["start"]))).alias("total"),
            F.greatest(acc["reach"], s["start"] + s["n"]).alias("reach"),
        ),
        lambda acc: acc["total"],
    )


def contamination(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM,
    doc_id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """One row per row of ``documents``.

    doc_id, body (a hash of the text), n_words, n_hit, n_items, items_sha256, contaminated.
    ``n_hit`` counts words inside an occurrence of a window; ``contaminated`` asks for a
    hit in at least one word of twenty. Null or empty texts have no words and no hits;
    equal rows get equal results, one each; an empty benchmark contaminates nothing;
    other columns of the inputs are not looked at.
    """
    docs = documents.select(
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(F.col(text)).alias("body"),
        F.col(text).alias("text"),
    )
    windows, shortest = benchmark_windows(benchmark, window, gram, item, item_text)
    narrow = materialized(
        evaluated_once(
            _marked(docs, window, gram, shortest),
            F.size("words").cast("long").alias("n_words"),
            F.array_distinct(F.concat("marks", "short")).alias("found"),
            keep=("doc_id", "body"),
        ),
        "fingerprints",
    )
    # 1. texts that share a fingerprint, with the shared ones
    shared = materialized(
        narrow.select("doc_id", "body", F.explode("found").alias("mark"))
        .join(windows.select("mark").distinct(), "mark", "left_semi")
        .groupBy("doc_id", "body")
        .agg(F.collect_set("mark").alias("shared")),
        "shared",
    )
    # 2. the words themselves; the stored marks have a measured size, which decides how the
    # texts meet them
    suspects = docs.join(shared, _same(docs, shared)).select(
        docs["doc_id"], docs["body"], docs["text"], "shared"
    )
    marked = _marked(suspects, window, gram, shortest)
    located = evaluated_once(
        marked, _places("marks").alias("at"), _places("short").alias("short_at"),
        keep=("doc_id", "body", "words"),
    )
    lengths = {window: "at"}
    if shortest is not None:
        lengths |= {n: "short_at" for n in range(shortest, window)}
    candidates = evaluated_once(
        located,
        F.concat(*[_at(at, n) for n, at in lengths.items()]).alias("candidates"),
        keep=("doc_id", "body"),
    ).select("doc_id", "body", F.inline("candidates"))
    hits = candidates.join(windows.select("item", "win", "n"), ["win", "n"])
    # equal windows are equal words, so a copy of a row adds nothing to the sets
    found = (
        hits.groupBy("doc_id", "body")
        .agg(
            F.collect_set(F.struct("start", "n")).alias("spans"),
            F.sort_array(F.collect_set("item")).alias("items"),
        )
        .select(
            F.col("doc_id").alias("hit_id"),
            F.col("body").alias("hit_body"),
            _covered(F.sort_array("spans")).cast("long").alias("hit"),
            F.size("items").cast("long").alias("items"),
            F.sha2(F.array_join("items", ","), 256).alias("digest"),
        )
    )
    hit = F.coalesce("hit", F.lit(0).cast("long"))
    judged = narrow.join(
        found,
        narrow["doc_id"].eqNullSafe(found["hit_id"]) & (narrow["body"] == found["hit_body"]),
        "left",
    )
    return judged.select(
        "doc_id",
        "body",
        "n_words",
        hit.alias("n_hit"),
        F.coalesce("items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        ((hit > 0) & (20 * hit >= F.col("n_words"))).alias("contaminated"),
    )


def uncontaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents`` that are not contaminated, with all their columns."""
    row_id, body = unused(documents, "row_id", "body")
    found = materialized(
        contamination(documents, benchmark)
        .filter("contaminated")
        .select(F.col("doc_id").alias(row_id), F.col("body").alias(body))
        .distinct(),
        "contaminated",
    )
    same = documents["doc_id"].eqNullSafe(F.col(row_id)) & (
        F.xxhash64(documents["text"]) == F.col(body)
    )
    return documents.join(found, same, "left_anti")
