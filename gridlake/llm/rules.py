"""Quality rules whose cutoffs are chosen under a bound on wrongly rejected good texts.

Base rules have fixed cutoffs. Each further rule rejects a text whose ratio is above a
cutoff, and the cutoff comes from labelled texts: per stratum (language) and candidate
cutoff, ``k`` of ``n`` good texts that pass the base would be rejected. If the true share
were above ``alpha``, so few would be seen with probability P(Binomial(n, alpha) <= k)
at most. Cutoffs whose value is at most ``delta`` divided by the number of all tests
(Bonferroni over rules, strata and cutoffs) are safe, and the one that gains most is used. A
rule gets ``ALPHA / rules``, so per stratum all rules together reject at most a share
``ALPHA`` of good texts, in every stratum at once with probability ``1 - DELTA``. Where
no cutoff is safe, for instance with few labels, the rule rejects nothing.

Everything runs as native expressions. Per text only numbers are stored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions.frames import evaluated_once
from gridlake.llm.words import BLANKS, blank_words, hashes, windowed
from gridlake.sources.tables import materialized

SYMBOLS = "#*$%&|<>"
#: Languages with cutoffs of their own; all others share one stratum.
STRATA = ("de", "en", "es", "fr")
OTHER = "other"
ALPHA, DELTA = 0.02, 0.05
REPEAT = 8
MIN_WORDS, MAX_REPEAT = 20, 30
#: Ratio columns of the selected rules; each has the cutoffs (1 to CUTOFFS) / SCALE.
RULES = ("symbols", "shouting", "dup_lines")
CUTOFFS, SCALE = 20, 40
#: Terms of the binomial tail that are added one by one; a geometric bound covers the rest.
TERMS = 512


def _repeated_words(runs: str) -> Column:
    """The words in runs that stand in the text at least twice.

    Runs are sorted by hash, so equal ones are neighbours: n log n for any text. Hashes
    have 64 bits; unequal runs of one text with equal hashes are not told apart.
    """
    pairs = F.array_sort(F.transform(runs, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))

    def places(ordered: Column) -> Column:
        twice = F.transform(
            ordered,
            lambda s, i: F.when(
                (s["h"] == F.get(ordered, i + 1)["h"])
                | ((i > 0) & (s["h"] == F.get(ordered, F.greatest(i - 1, F.lit(0)))["h"])),
                s["at"],
            ),
        )
        return F.array_sort(F.array_compact(twice))

    def covered(at: Column) -> Column:
        return F.aggregate(
            F.transform(
                at, lambda p, i: F.least(F.lit(REPEAT), F.coalesce(F.get(at, i + 1) - p, F.lit(REPEAT)))
            ),
            F.lit(0),
            lambda total, n: total + n,
        )

    # a lambda's argument is computed once, however often its body uses it
    at = F.transform(F.array(pairs), places)
    return F.element_at(F.transform(at, covered), 1)


def text_counts(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", keep=()) -> DataFrame:
    """Per row: doc_id, ``keep``, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_shouted.

    ``n_shouted`` counts A-Z and exclamation marks. Null counts as an empty text.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    blank = F.translate(body, " " + BLANKS, "")
    with_word = F.filter(
        F.split(body, "\n"), lambda line: F.length(F.translate(line, " " + BLANKS, "")) > 0
    )
    kept = ("doc_id", *keep, "word_chars", "n_symbols", "n_shouted", "n_dup_lines")
    counted = evaluated_once(
        documents.select(F.col(doc_id).alias("doc_id"), *keep, body.alias("body")).select(
            "doc_id", *keep, F.col("body").alias(text)
        ),
        F.length(blank).alias("word_chars"),
        (F.length(F.col(text)) - F.length(F.translate(F.col(text), SYMBOLS, ""))).alias("n_symbols"),
        F.length(F.regexp_replace(F.col(text), "[^A-Z!]+", "")).alias("n_shouted"),
        with_word.alias("lines"),
        blank_words(F.col(text)).alias("words"),
        keep=("doc_id", *keep),
    )
    counted = evaluated_once(
        counted,
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.size("words").alias("n_words"),
        hashes(F.col("words")).alias("hashed"),
        keep=tuple(c for c in kept if c != "n_dup_lines"),
    )
    runs = evaluated_once(
        counted,
        windowed(F.col("hashed"), REPEAT, F.xxhash64, "bigint").alias("runs"),
        keep=(*kept, "n_words"),
    )
    repeated = F.when(F.size(F.array_distinct("runs")) < F.size("runs"), _repeated_words("runs"))
    numbers = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_shouted")
    return runs.select(
        "doc_id",
        *keep,
        *[F.col(c).cast("long") for c in numbers],
        F.coalesce(repeated, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words")
    )


def _steps() -> dict[str, Column]:
    """Each rule's ratio in whole steps of 1 / SCALE, rounded up: above cutoff c if > c."""

    def steps(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, F.ceil(SCALE * part / whole)).otherwise(0).cast("int")

    return {
        "symbols": steps(F.col("n_symbols"), F.col("word_chars")),
        "shouting": steps(F.col("n_shouted"), F.col("word_chars")),
        "dup_lines": steps(F.col("n_dup_lines"), F.col("n_words") / 10),
    }


def _log_gamma(x: Column) -> Column:
    """ln gamma(x) for x > 0: Stirling's series at x + 8, then the recurrence."""
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    stirling = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series
    return stirling - sum((F.log(x + i) for i in range(1, 8)), F.log(x))


def binomial_tail(k: Column, n: Column, share: float) -> Column:
    """P(Binomial(n, share) <= k); for k above the mean, 1.

    Below the mean the terms fall faster than a geometric series from k down. TERMS of
    them are added; what is left is bounded by that series, so the value is never too small.
    """
    k, n = k.cast("double"), n.cast("double")
    first = F.exp(
        _log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1)
        + k * math.log(share) + (n - k) * math.log1p(-share)
    )
    odds = (1 - share) / share
    zero = F.struct(first.alias("term"), F.lit(0.0).alias("total"))
    total = F.aggregate(
        F.sequence(F.lit(0), F.lit(TERMS - 1)),
        zero,
        lambda acc, i: F.struct(
            (acc["term"] * F.greatest(k - i, F.lit(0.0)) / (n - k + i + 1) * odds).alias("term"),
            (acc["total"] + acc["term"]).alias("total"),
        ),
        lambda acc: acc["total"]
        + acc["term"] / F.greatest(1 - (k * odds) / (n - k + 1), F.lit(1e-9)),
    )
    return F.when(k >= n * share, F.lit(1.0)).otherwise(F.least(total, F.lit(1.0)))


def stratum(lang: Column) -> Column:
    return F.when(lang.isin(*STRATA), lang).otherwise(F.lit(OTHER))


def label_per_document(labels: DataFrame, label: str = "quality", doc_id: str = "doc_id") -> DataFrame:
    """One label per id: 1 if at least half of its non-null labels are 1. Null ids have none."""
    return (
        labels.select(F.col(doc_id).alias("label_id"), F.col(label).cast("double").alias("label"))
        .dropna()
        .groupBy("label_id")
        .agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    )


def select_cutoffs(labelled: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The safe cutoff of each rule that gains most, one row per stratum that has one.

    ``labelled`` has stratum, label and the steps of each rule. The gain is bad texts less
    good texts rejected; of equal gains the higher cutoff is taken, and without a gain
    there is none. All cutoffs are tested together, so choosing among them is allowed.
    """
    tests = len(RULES) * (len(STRATA) + 1) * CUTOFFS
    cells = [(rule, c) for rule in RULES for c in range(1, CUTOFFS + 1)]
    good = F.col("label") == 1
    counts = labelled.groupBy("stratum").agg(
        F.count_if(good).alias("n"),
        *[F.count_if(good & (F.col(rule) > c)).alias(f"good_{rule}_{c}") for rule, c in cells],
        *[F.count_if(~good & (F.col(rule) > c)).alias(f"bad_{rule}_{c}") for rule, c in cells],
    )
    table = F.array(
        *[
            F.struct(
                F.lit(rule).alias("rule"),
                F.lit(c).alias("cutoff"),
                F.col(f"good_{rule}_{c}").alias("k"),
                (F.col(f"bad_{rule}_{c}") - F.col(f"good_{rule}_{c}")).alias("gain"),
            )
            for rule, c in cells
        ]
    )
    safe = (
        counts.select("stratum", "n", F.inline(table))
        .withColumn("p", binomial_tail(F.col("k"), F.col("n"), alpha / len(RULES)))
        .filter((F.col("p") <= delta / tests) & (F.col("gain") > 0))
    )
    best = F.struct("gain", "cutoff")
    return safe.groupBy("stratum").agg(
        *[
            F.max(F.when(F.col("rule") == rule, best))["cutoff"].alias(f"cut_{rule}")
            for rule in RULES
        ]
    )


def quality_rules(
    documents: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA
) -> DataFrame:
    """One row per row of ``documents``: its counts, base_failed, the failed rules and kept.

    Null and empty texts have no words and fail the base. Documents without a language
    are in the stratum of other languages. Labels with a null id or label are left out;
    without labels only the base rules reject. Repeated rows get equal results.
    """
    # tables of documents may have columns named like the counts
    plain = documents.select("doc_id", "text", stratum(F.col("lang")).alias("stratum"))
    counts = materialized(text_counts(plain, keep=("stratum",)), "counts").withColumns(
        {"base_failed": base_failed(), **_steps()}
    )
    labelled = counts.filter(~F.col("base_failed")).join(
        label_per_document(labels), F.col("doc_id") == F.col("label_id")
    )
    cutoffs = materialized(select_cutoffs(labelled, alpha, delta), "cutoffs")
    # at most len(STRATA) + 1 rows
    judged = counts.join(F.broadcast(cutoffs), "stratum", "left")
    failed = F.array_compact(
        F.array(*[F.when(F.col(rule) > F.col(f"cut_{rule}"), F.lit(rule)) for rule in RULES])
    )
    return judged.select(
        "doc_id",
        *[f"{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        "base_failed",
        F.array_join(failed, ",").alias("failed_rules"),
        (~F.col("base_failed") & (F.size(failed) == 0)).alias("kept"),
    )
