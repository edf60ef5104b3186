"""Secrets in texts: fixed patterns, and tokens that pass a battery of randomness tests.

Candidates are long parts of runs of letters, digits and base64 signs whose encoding can be
told from their characters: what is left of a run outside of the fixed patterns' spans, split at
inner '=', and of that each longest part in one alphabet and each part without any sign. A part
within another that passes isn't reported again. If a token is a key, its characters are drawn uniformly from
the alphabet of its encoding; that is the null hypothesis of three tests:

* chi-squared uniformity of the alphabet's characters,
* runs above and below the middle of the alphabet,
* serial correlation of neighbouring characters.

A token's p-value combines the three (three times the least). Natural words and
identifiers fail; a token whose null hypothesis isn't rejected is reported. Rejections
are the discoveries of a Benjamini-Hochberg procedure at rate ``Q`` over the
candidates of all texts, within bands of token length: long tokens are tested with more
power, so short ones must not set their threshold. Of the tokens dismissed, at most a
share ``Q`` is expected to be random keys. p-values are rounded up to a grid, which keeps them
valid and makes each band's ranks a table of fixed size.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.llm.batches import map_batches, utf8
from gridlake.llm.names import unused
from gridlake.sources.tables import materialized

#: The base patterns, and the least length of what they must catch.
ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE,
)
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24
KINDS = ("assign", "access", "hex", "random")

#: The method's parameters.
MIN_RANDOM = 24
Q = 0.01
#: Upper ends of the bands of token length; the last is open.
BANDS = (32, 48, 64, 128)
#: p-values on a grid of powers of ten, GRID steps each, down to 10 ** -DECADES.
GRID, DECADES = 20, 15
ALPHABETS = (
    ("hex_lower", b"0123456789abcdef"),
    ("hex_upper", b"0123456789ABCDEF"),
    ("base32", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36_lower", b"0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base36_upper", b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base62", b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)


def _class(characters: bytes) -> np.ndarray:
    mask = np.zeros(256, bool)
    mask[list(characters)] = True
    return mask


_MASKS = [(name, _class(letters)) for name, letters in ALPHABETS]
_VALUE = {
    name: np.array([letters.find(bytes([c])) for c in range(256)]) for name, letters in ALPHABETS
}
_HEX = _class(b"0123456789abcdef")
_TOKEN = _class(ALPHABETS[6][1] + b"-_=")
_SIDE = re.compile(rb"[^=]+")
_LONGEST = (re.compile(rb"[A-Za-z0-9+/]+"), re.compile(rb"[A-Za-z0-9_-]+"))
_UNSIGNED = re.compile(rb"[A-Za-z0-9]+")
_WORD = re.compile(rb"[A-Za-z][a-z]*[0-9]?|[A-Z]+")


def _long_runs(codes: np.ndarray, mask: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Start and end of the maximal runs of a character class with ``least`` bytes or more."""
    inside = mask[codes]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= least
    return list(zip(starts[long].tolist(), ends[long].tolist(), strict=True))


# --- the battery --------------------------------------------------------------


def infer_encoding(token: bytes) -> str | None:
    """The first alphabet that has all characters; None for words and for numbers.

    A key has letters and digits; padding signs at the end don't count.
    """
    body = token.rstrip(b"=")
    if body.isalpha() or not re.search(rb"[A-Za-z]", body) or not re.search(rb"[0-9]", body):
        return None
    codes = np.frombuffer(body, np.uint8)
    return next((name for name, mask in _MASKS if mask[codes].all()), None)


def _normal_tail(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def chi_squared_tail(x: float, freedom: int) -> float:
    """P(X > x) of a chi-squared variable, by the Wilson-Hilferty cube root."""
    if x <= 0:
        return 1.0
    spread = 2 / (9 * freedom)
    z = ((x / freedom) ** (1 / 3) - (1 - spread)) / math.sqrt(spread)
    return 0.5 * math.erfc(z / math.sqrt(2))


def randomness(token: bytes) -> tuple[str | None, float]:
    """The encoding and the combined p-value of the three tests; None and 0 for words."""
    encoding = infer_encoding(token)
    if encoding is None:
        return None, 0.0
    body = np.frombuffer(token.rstrip(b"="), np.uint8)
    values = _VALUE[encoding][body]
    n, size = len(values), len(dict(ALPHABETS)[encoding])
    counts = np.bincount(values, minlength=size)
    uniform = chi_squared_tail(float(((counts - n / size) ** 2).sum() * size / n), size - 1)
    high = values >= size // 2
    ups = int(high.sum())
    downs = n - ups
    runs = 0.0
    if ups and downs:
        mean = 2 * ups * downs / n + 1
        spread = (mean - 1) * (mean - 2) / max(n - 1, 1)
        seen = 1 + int((high[1:] != high[:-1]).sum())
        runs = _normal_tail((seen - mean) / math.sqrt(spread)) if spread > 0 else 1.0
    centred = values - values.mean()
    power = float((centred**2).sum())
    serial = 0.0
    if power:
        z = (float((centred[1:] * centred[:-1]).sum()) / power + 1 / n) * math.sqrt(n)
        serial = _normal_tail(z)
    return encoding, min(1.0, 3 * min(uniform, runs, serial))


def grid_step(p: float) -> int:
    """The p-value as a step on the grid, rounded up; step 0 is p = 1."""
    return min(GRID * DECADES, int(-math.log10(max(p, 10.0**-DECADES)) * GRID))


def band(length: int) -> int:
    return sum(length > end for end in BANDS)


# --- scanning -----------------------------------------------------------------


def base_spans(text: bytes, codes: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, kind, end) in bytes of the fixed patterns."""
    spans = []
    lowered = text.lower()
    if any(word in lowered for word in KEYWORDS):
        spans += [
            (m.start(), 0, m.end())
            for m in ASSIGN.finditer(text)
            if m.end(2) - m.start(2) >= MIN_ASSIGN
        ]
    if b"AKIA" in text:
        spans += [
            (m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS
        ]
    spans += [(start, 2, end) for start, end in _long_runs(codes, _HEX, MIN_HEX)]
    return sorted(spans)


def _outside(
    runs: list[tuple[int, int]], spans: list[tuple[int, int, int]], text: bytes
) -> list[tuple[int, int]]:
    """What the base spans leave of the runs, without signs next to a span; in order."""
    left, k = [], 0
    taken: list[list[int]] = []
    for start, _, end in spans:
        if taken and start <= taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], end)
        else:
            taken.append([start, end])
    for start, end in runs:
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        while k < len(taken) and taken[k][0] < end:
            from_, to = taken[k]
            left.append((start, from_ - (from_ > start and text[from_ - 1 : from_] in (b"/", b"_", b"-"))))
            start = to + (text[to : to + 1] in (b"/", b"_", b"-"))
            if to >= end:
                break
            k += 1
        left.append((start, end))
    return [(start, end) for start, end in left if end - start >= MIN_RANDOM]


def _without_words(text: bytes, start: int, end: int) -> tuple[int, int]:
    """A part of a path or name without the words at its ends; empty if it is only words."""
    pieces = [m.span() for m in _UNSIGNED.finditer(text, start, end)]
    kept = [i for i, (s, e) in enumerate(pieces) if not _WORD.fullmatch(text, s, e)]
    if not kept:
        return start, start
    first, last = kept[0], kept[-1]
    inner = (
        pieces[first - 1][1] + 1 if first else start,  # one sign goes with the word
        pieces[last + 1][0] - 1 if last < len(pieces) - 1 else end,
    )
    return inner if inner[1] - inner[0] >= MIN_RANDOM else (start, end)


def parts(text: bytes, start: int, end: int) -> dict[tuple[int, int], list[tuple[int, int]]]:
    """The parts of a run to be tested, each with the parts it lies in."""
    found: dict[tuple[int, int], list[tuple[int, int]]] = {}
    body = start + len(text[start:end].rstrip(b"="))
    for side in _SIDE.finditer(text, start, body):
        if side.end() - side.start() < MIN_RANDOM:
            continue
        for longest in _LONGEST:
            for m in longest.finditer(text, *side.span()):
                if m.end() - m.start() < MIN_RANDOM:
                    continue
                outer = m.span() if m.span() == side.span() else _without_words(text, *m.span())
                if outer[1] - outer[0] < MIN_RANDOM:
                    continue
                found.setdefault(outer, [])
                for piece in _UNSIGNED.finditer(text, *outer):
                    if piece.span() != outer and piece.end() - piece.start() >= MIN_RANDOM:
                        found.setdefault(piece.span(), []).append(outer)
    return found


def candidates(
    text: bytes, codes: np.ndarray, spans: list[tuple[int, int, int]]
) -> list[tuple[int, int, int, int, int, list[tuple[int, int]]]]:
    """Tokens outside of the base spans that may be keys: (start, end, encoding index, band,
    grid step, outer); outer has (band, grid step) of the tokens that hold this one."""
    found = []
    names = [name for name, _ in ALPHABETS]
    for start, end in _outside(_long_runs(codes, _TOKEN, MIN_RANDOM), spans, text):
        body = start + len(text[start:end].rstrip(b"="))
        own = parts(text, start, end)
        tested = {}
        for s, e in own:
            encoding, p = randomness(text[s:e])
            if encoding is not None:
                tested[s, e] = names.index(encoding), band(e - s), grid_step(p)
        for (s, e), values in sorted(tested.items()):
            outer = [tested[o][1:] for o in own[s, e] if o in tested]
            found.append((s, end if e == body else e, *values, outer))
    return found


def _in_characters(text: bytes, codes: np.ndarray, places: list[int]) -> dict[int, int]:
    """Byte offsets as code points."""
    if text.isascii():
        return {place: place for place in places}
    heads = np.cumsum((codes & 0xC0) != 0x80)
    return {place: int(heads[place - 1]) if place else 0 for place in places}


_SPAN = "array<struct<start:int,kind:int,end:int>>"
_FOUND = "array<struct<start:int,end:int,encoding:int,band:int,step:int,outer:array<struct<band:int,step:int>>>>"
_SPAN_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
_FOUND_TYPE = pa.list_(
    pa.struct(
        [
            *[(name, pa.int32()) for name in ("start", "end", "encoding", "band", "step")],
            ("outer", pa.list_(pa.struct([("band", pa.int32()), ("step", pa.int32())]))),
        ]
    )
)


def scan(text: bytes) -> tuple[list[dict], list[dict]]:
    """Base spans and candidate tokens of one text, in code points."""
    codes = np.frombuffer(text, np.uint8)
    spans = base_spans(text, codes)
    tokens = candidates(text, codes, spans)
    if not spans and not tokens:
        return [], []
    at = _in_characters(
        text, codes, [x for s, _, e in spans for x in (s, e)] + [x for t in tokens for x in t[:2]]
    )
    return (
        [{"start": at[s], "kind": kind, "end": at[e]} for s, kind, e in spans],
        [
            {
                "start": at[s], "end": at[e], "encoding": encoding, "band": size, "step": step,
                "outer": [{"band": b, "step": x} for b, x in outer],
            }
            for s, e, encoding, size, step, outer in tokens
        ],
    )


def _scanned(batch: pa.RecordBatch) -> pa.RecordBatch:
    found = [scan(text) for text in utf8(batch, "text")]
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id"),
            batch.column("body"),
            pa.array([spans for spans, _ in found], _SPAN_TYPE),
            pa.array([tokens for _, tokens in found], _FOUND_TYPE),
        ],
        ["doc_id", "body", "base", "tokens"],
    )


# --- false discoveries --------------------------------------------------------


def thresholds(counts: dict[tuple[int, int], int], q: float = Q) -> list[int]:
    """Per band, the least grid step that is rejected by Benjamini-Hochberg.

    ``counts`` has the number of tokens per (band, step). A p-value is at most
    10 ** (-step / GRID). Without a rejection the step is beyond the grid.
    """
    result = []
    for size in range(len(BANDS) + 1):
        own = {step: n for (b, step), n in counts.items() if b == size}
        total, rank, least = sum(own.values()), 0, GRID * DECADES + 1
        for step in sorted(own, reverse=True):
            rank += own[step]
            if 10 ** (-step / GRID) <= q * rank / total:
                least = step
        result.append(least)
    return result


def _spans_text(spans: str) -> Column:
    ordered = F.array_sort(spans)
    kinds = F.array(*[F.lit(kind) for kind in KINDS])
    named = F.transform(
        ordered,
        lambda s: F.concat_ws(
            ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
        ),
    )
    return F.array_join(named, ",")


def find_secrets(documents: DataFrame, q: float = Q, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``documents``: doc_id, body (a hash of the text), base, found.

    ``base`` and ``found`` are arrays of (start, kind, end) in code points, end exclusive;
    kind is an index of KINDS. ``found`` also has the tokens that pass the battery, which lie
    outside of the base spans and not within another token that passes. Null and empty texts have none; repeated rows get equal results but
    count repeatedly among the candidates. Only spans are stored, no texts.
    """
    narrow = documents.select(
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(F.col(text)).alias("body"),
        F.col(text).alias("text"),
    )
    kind = dict(narrow.dtypes)["doc_id"]
    scanned = materialized(
        map_batches(narrow, _scanned, f"doc_id {kind}, body long, base {_SPAN}, tokens {_FOUND}"),
        "spans",
    )
    token = scanned.select(F.explode("tokens").alias("t"))
    rows = token.groupBy("t.band", "t.step").count().collect()  # at most bands * grid rows
    least = thresholds({(r["band"], r["step"]): r["count"] for r in rows}, q)
    limits = F.array(*[F.lit(step) for step in least])

    def passes(token: Column) -> Column:
        return token["step"] < F.get(limits, token["band"])

    passed = F.filter("tokens", lambda t: passes(t) & ~F.exists(t["outer"], passes))
    random = F.transform(
        passed,
        lambda t: F.struct(
            t["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"), t["end"].alias("end")
        ),
    )
    return scanned.select("doc_id", "body", "base", F.concat("base", random).alias("found"))


def report(found: DataFrame) -> DataFrame:
    """Counts and digests of ``find_secrets``."""

    def count(name: str) -> Column:
        own = F.filter("base", lambda s: s["kind"] == KINDS.index(name))
        return F.size(own).cast("long").alias(f"n_{name}")

    return found.select(
        "doc_id",
        *[count(name) for name in ("assign", "access", "hex")],
        F.sha2(_spans_text("base"), 256).alias("base_sha256"),
        _spans_text("found").alias("spans"),
    )


def redact(documents: DataFrame, q: float = Q, mark: str = "[SECRET]") -> DataFrame:
    """``documents`` with each secret in ``text`` replaced; n_chars follows the text.

    All columns and rows stay. Overlapping spans are replaced as one. Spans come
    from the row's own text, so repeated ids get their own spans.
    """
    row_id, body, spans = unused(documents, "row_id", "body", "spans")
    found = (
        find_secrets(documents, q)
        .filter(F.size("found") > 0)
        .dropDuplicates(["doc_id", "body"])
        .select(
            F.col("doc_id").alias(row_id),
            F.col("body").alias(body),
            F.array_sort("found").alias(spans),
        )
    )
    joined = documents.join(
        found,
        documents["doc_id"].eqNullSafe(F.col(row_id))
        & (F.xxhash64(documents["text"]) == F.col(body)),
        "left",
    )
    whole, has = F.col("text"), F.col(spans).isNotNull()
    zero = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def part(start: Column, end: Column) -> Column:
        return F.substring(whole, start + 1, end - start)

    def cut(acc: Column, span: Column) -> Column:
        """The text up to the span's end; a span that overlaps the last one adds no mark."""
        before = F.concat(acc["out"], part(acc["at"], span["start"]), F.lit(mark))
        return F.struct(
            F.when(span["start"] >= acc["at"], before).otherwise(acc["out"]).alias("out"),
            F.greatest(acc["at"], span["end"]).alias("at"),
        )

    clean = F.aggregate(
        spans, zero, cut, lambda acc: F.concat(acc["out"], part(acc["at"], F.length(whole)))
    )
    changed = joined.withColumn("text", F.when(has, clean).otherwise(whole))
    if "n_chars" in documents.columns:
        length = F.length("text").cast(dict(documents.dtypes)["n_chars"])
        changed = changed.withColumn("n_chars", F.when(has, length).otherwise(F.col("n_chars")))
    return changed.select(*documents.columns)
