"""Personal data by bootstrapped contextual extraction.

Four base kinds have patterns of their own; what they match are the seeds. The words to the left of a seed (one, two or
three of them) are lexical patterns. A pattern is worth as much as the part of its occurrences *in the whole corpus* that
is followed by a trusted instance, so common words are worth nothing and cues like ``call me at`` are worth a lot. An
instance (a token with a digit, a number in groups, a name or a handle, by its value) is worth what its patterns make
likely, on average over all its occurrences. Spark scores patterns and instances in turn over their graph, and instances
believed in one round admit new patterns in the next; occurrences of believed instances that stand behind a believed
pattern, and that no base pattern found, become spans of kind ``context``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablespoon.llm.spans import Span, ascii_lower
from tablespoon.llm.words import NON_SPACE, blocks, hash_spans, lower_ascii, mix64, word_spans
from tablespoon.session import stored

#: Base kinds in their order, their patterns and bounds.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS = (16, 19), (8, 15)
CONTEXT = "context"

LEFT_WORDS = 3  # longest pattern
LEAST_SEEDS = 5  # different seed or believed values that a pattern must have preceded
LEAST_WORTH = 0.5  # of a pattern, and
LEAST_BELIEF = 0.9  # of a new instance
ROUNDS = 3

_LOCAL_CHAR = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = re.compile(r"[0-9]+")
_REST = re.compile(r"[^\x20\x09-\x0D]*")
#: Candidates of several tokens, or without a digit: numbers in groups, names, handles.
_GROUPS = re.compile(r"(?<![^\x20\x09-\x0D\"'\[{<:,;])\+?\(?[0-9]{1,5}\)?(?:[\x20./-]{1,2}\(?[0-9]{2,5}\)?)+(?![^\x20\x09-\x0D.,:;!?\]}>\"')])")
_GROUP_DIGITS = (7, 19)
_UPPER = r"[A-Z\xC0-\xD6\xD8-\xDE]"
_NAME = re.compile(rf"(?<![^\x20\x09-\x0D\"'(\[]){_UPPER}[^\W\d_]+(?:[\x20'-](?:{_UPPER}\.|{_UPPER}[^\W\d_]+))+")
_HANDLE = re.compile(r"(?<![^\x20\x09-\x0D\"'(\[])@?[A-Za-z]+(?:_[A-Za-z]+)+|(?<![^\x20\x09-\x0D\"'(\[])@[A-Za-z]+")
_SPACE = " \t\n\x0b\x0c\r"
_EDGE = ".,;:!?()[]{}<>\"'"
_U = np.uint64


def emails(text: str) -> list[tuple[int, int]]:
    """Every ``@`` is looked at once: the local part is what stands before it, back to the last match at most."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL_CHAR:
            begin -= 1
        domain = DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            out.append((begin, domain.end()))
        free = domain.end() if domain else max(free, at + 1)
        at = text.find("@", max(at + 1, free))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if i % 2 == 0 else (2 * n if n < 5 else 2 * n - 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """Base spans by kind, then start."""
    out: list[Span] = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= CARD_DIGITS[0]:
            digits = _digits(m.group())
            if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if PHONE_DIGITS[0] <= len(_digits(m.group())) <= PHONE_DIGITS[1]:
                out.append(("phone", *m.span()))
    return out


def _shapes(text: str) -> list[tuple[int, int]]:
    """Numbers in groups, names of two words or more, and handles, in this order."""
    out = []
    for m in _GROUPS.finditer(text):
        if _GROUP_DIGITS[0] <= len(_digits(m.group())) <= _GROUP_DIGITS[1] and not m.group().isdigit():
            out.append(m.span())
    for m in _NAME.finditer(text):
        a, b = m.span()
        before = text[:a].rstrip(_SPACE)[-1:] if a < 64 else text[a - 64 : a].rstrip(_SPACE)[-1:]
        if (not before or before in ".!?") and m.group().count(" ") >= 2:
            a += m.group().index(" ") + 1  # a sentence begins with a capital anyway
        out.append((a, b))
    if "_" in text or "@" in text:
        out += [m.span() for m in _HANDLE.finditer(text)]
    return out


def _candidates(text: str, base: list[Span]) -> list[tuple[int, int, bool]]:
    """(start, end, seed): base spans, then shapes and trimmed tokens with a digit that touch none of those before."""
    taken = sorted((a, b) for _, a, b in base)
    out = [(a, b, True) for a, b in taken]

    def free(spans: list[tuple[int, int]], held: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """Of ``spans`` those that overlap neither ``held`` nor one another; all are looked at once, in order."""
        kept, at, last = [], 0, 0
        for a, b in sorted(spans):
            while at < len(held) and held[at][1] <= a:
                at += 1
            if a >= last and not any(x < b and y > a for x, y in held[at : at + 2]):
                kept.append((a, b))
                last = b
        return kept

    shapes = free(_shapes(text), taken)
    out += [(a, b, False) for a, b in shapes]
    taken = sorted(taken + shapes)
    at = end = 0
    for m in _DIGITS.finditer(text):
        if m.start() < end:
            continue
        a = m.start()
        while a > end and text[a - 1] not in _SPACE:
            a -= 1
        b = end = _REST.match(text, m.end()).end()
        while a < b and text[a] in _EDGE:
            a += 1
        while b > a and text[b - 1] in _EDGE:
            b -= 1
        while at < len(taken) and taken[at][1] <= a:
            at += 1
        if not any(x < b and y > a for x, y in taken[at : at + 2]) and b > a:
            out.append((a, b, False))
    return out


def _patterns(hashes: np.ndarray, rows: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For n = 1 to LEFT_WORDS: (place of the last word, hash of the n words that end there)."""
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    out, value = [], np.zeros(len(hashes), dtype=_U)
    place = np.arange(len(hashes))
    for n in range(LEFT_WORDS):
        use = place - n >= rows[:-1][row] if len(hashes) else np.zeros(0, dtype=bool)
        moved = np.zeros(len(hashes), dtype=_U)
        if n < len(hashes):
            moved[n:] = hashes[: len(hashes) - n]
        value = mix64(value * _U(0xD6E8FEB86659FD93) + moved + _U(n + 1))
        out.append((place[use], value[use]))
    return out


class _Words:
    """Words of a block, hashed once, and the patterns that end at each."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        lowered = lower_ascii(data)
        self.data, self.bounds = data, bounds
        self.starts, lengths = word_spans(lowered, bounds, NON_SPACE)
        self.ends = self.starts + lengths
        self.rows = np.searchsorted(self.starts, bounds)
        self.values = [np.zeros(len(lengths), dtype=_U) for _ in range(LEFT_WORDS)]
        for n, (place, value) in enumerate(_patterns(hash_spans(lowered, self.starts, lengths), self.rows)):
            self.values[n][place] = value

    def before(self, row: int, starts: list[int]) -> list[list[int]]:
        """Of each start, in code points of the row: hashes of the 1 to LEFT_WORDS words before it.

        A word that touches the start, like an opening mark, is none of them.
        """
        data = self.data[self.bounds[row] : self.bounds[row + 1]]
        at = np.array(starts, dtype=np.int64)
        if len(data) and data.max() >= 0x80:
            at = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))[at]
        at = at + self.bounds[row]
        last = np.searchsorted(self.starts, at) - 1
        touching = (last >= self.rows[row]) & (self.ends[last] >= at)
        last = last - touching
        many = np.minimum(last - self.rows[row] + 1, LEFT_WORDS).tolist()
        columns = [v[np.maximum(last, 0)].view(np.int64).tolist() if len(v) else [] for v in self.values]
        return [[columns[n][i] for n in range(k)] for i, k in enumerate(many)]


def _extract(key: str, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct(
            [("start", pa.int64()), ("end", pa.int64()), ("seed", pa.bool_()), ("value", pa.string()),
             ("patterns", pa.list_(pa.int64()))]
        )
        for block in blocks(batches, text):
            bases, found = [], []
            batch, words = block.rows, _Words(block.data, block.bounds)
            for row, body in enumerate(batch.column(batch.schema.get_field_index(text))):
                body = body.as_py() or ""
                base = base_spans(body)
                bases.append([{"kind": k, "start": a, "end": b} for k, a, b in base])
                candidates = _candidates(body, base)
                left = words.before(row, [a for a, _, _ in candidates]) if candidates else []
                found.append(
                    [
                        {"start": a, "end": b, "seed": seed, "value": ascii_lower(body[a:b]), "patterns": patterns}
                        for (a, b, seed), patterns in zip(candidates, left)
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index(key)),
                    pa.array(bases, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))),
                    pa.array(found, pa.list_(kind)),
                ],
                [key, "base", "candidates"],
            )

    return run


def _occurrences(patterns, text: str):
    """Counts, per task, of how often each pattern stands in the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = patterns.value
        count = np.zeros(len(known), dtype=np.int64)
        for block in blocks(batches, text):
            data = lower_ascii(block.data)
            starts, lengths = word_spans(data, block.bounds, NON_SPACE)
            hashes, rows = hash_spans(data, starts, lengths), np.searchsorted(starts, block.bounds)
            for _, value in _patterns(hashes, rows):
                slot = np.searchsorted(known, value)
                slot[slot == len(known)] = 0
                count += np.bincount(slot[known[slot] == value], minlength=len(known))
        seen = np.flatnonzero(count)
        if len(seen):
            yield pa.RecordBatch.from_pydict(
                {"pattern": pa.array(known[seen].view(np.int64), pa.int64()), "n": pa.array(count[seen], pa.int64())}
            )

    return run


def corpus_counts(docs: DataFrame, patterns: DataFrame, text: str, block: int = 1 << 20) -> DataFrame:
    """(pattern, n) over all texts. Patterns are broadcast sorted, at most ``block`` of them (8 MB) in one pass."""
    spark = docs.sparkSession
    parts = -(-patterns.count() // block)
    counts = [spark.createDataFrame([], "pattern long, n long")]
    for part in range(parts):
        mine = patterns.where(F.pmod(F.xxhash64("pattern"), F.lit(parts)) == part) if parts > 1 else patterns
        known = np.sort(np.array([r.pattern for r in mine.toLocalIterator()], dtype=np.int64).view(_U))
        if len(known):
            counts.append(
                docs.select(text).mapInArrow(_occurrences(spark.sparkContext.broadcast(known), text), "pattern long, n long")
            )
    both = counts[0]
    for one in counts[1:]:
        both = both.unionByName(one)
    return both.groupBy("pattern").agg(F.sum("n").alias("n"))


def score_graph(contexts: DataFrame, count, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """(believed values, worth of believed patterns) by mutual scoring of patterns and instances.

    ``contexts`` has (value, seed, patterns, n): ``n`` occurrences of a value behind nested patterns; ``count`` gives
    (pattern, n) over the corpus for a frame of patterns. In every round the patterns that enough different seeds or believed
    instances follow are admitted anew. A pattern is worth the believed part of its occurrences. An occurrence is worth its
    best pattern, as nested patterns are one piece of evidence, and an instance the mean of all its occurrences, so one that
    mostly stands elsewhere is not believed. All sums are combined before the shuffle.
    """
    spark = contexts.sparkSession
    edges = contexts.select("value", "seed", "n", F.explode("patterns").alias("pattern"))
    edges = stored(edges.groupBy("value", "seed", "pattern").agg(F.sum("n").alias("n")), "edges")
    others = edges.where("NOT seed").select("pattern").distinct()
    seeded = edges.where("seed").groupBy("pattern").agg(F.count("*").alias("seeds")).where(F.col("seeds") > 0)
    seeded = stored(seeded.join(others, "pattern", "left_semi"), "seeded")
    counts = spark.createDataFrame([], "pattern long, n long")
    good = spark.createDataFrame([], "value string")
    belief = spark.createDataFrame([], "value string, belief double")
    worth = spark.createDataFrame([], "pattern long, worth double")
    for _ in range(rounds):
        more = edges.where("NOT seed").join(good, "value", "left_semi").groupBy("pattern").agg(F.count("*").alias("seeds"))
        used = seeded.unionByName(more).groupBy("pattern").agg(F.sum("seeds").alias("seeds")).where(F.col("seeds") >= LEAST_SEEDS)
        used = stored(used.select("pattern"), "patterns")
        fresh = stored(used.join(counts, "pattern", "left_anti"), "fresh")
        if not fresh.isEmpty():
            counts = stored(counts.unionByName(count(fresh)), "occurrences")
        trusted = edges.join(used, "pattern", "left_semi").join(belief, "value", "left")
        weight = F.when(F.col("seed"), 1.0).otherwise(F.coalesce("belief", F.lit(0.0)))
        hits = trusted.groupBy("pattern").agg(F.sum((F.col("n") * weight).cast("decimal(38,9)")).cast("double").alias("hits"))
        worth = hits.join(counts.withColumnRenamed("n", "all"), "pattern").select(
            "pattern", F.least(F.col("hits") / F.col("all"), F.lit(1.0)).alias("worth")
        )
        worth = stored(worth.where(F.col("worth") >= LEAST_WORTH), "worth")
        behind = contexts.where("NOT seed").select("value", "patterns", "n", F.explode("patterns").alias("pattern")).join(worth, "pattern")
        best = behind.groupBy("value", "patterns", "n").agg(F.max("worth").alias("worth"))
        scored = best.groupBy("value").agg(F.sum((F.col("n") * F.col("worth")).cast("decimal(38,9)")).cast("double").alias("score"))
        totals = contexts.where("NOT seed").join(scored, "value", "left_semi").groupBy("value").agg(F.sum("n").alias("total"))
        belief = stored(scored.join(totals, "value").select("value", (F.col("score") / F.col("total")).alias("belief")), "beliefs")
        good = belief.where(F.col("belief") >= LEAST_BELIEF).select("value")
    return good, worth


def find_personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """(key, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_context) of every row.

    Counts and digest are those of the base kinds; ``spans`` has all, the discovered ones (kind ``context``) last. Spans
    are in code points, end exclusive. A null or empty text has none; repeated rows are judged one by one, and count as
    one document's worth of evidence each. An empty table gives no rows.
    """
    kind = dict(docs.dtypes)[key]
    span = "struct<kind:string,start:bigint,end:bigint>"
    found = "struct<start:bigint,end:bigint,seed:boolean,value:string,patterns:array<bigint>>"
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("body"))
    docs_found = stored(
        texts.mapInArrow(_extract("key", "body"), f"key {kind}, base array<{span}>, candidates array<{found}>"), "candidates"
    )
    one = docs_found.select(F.explode("candidates").alias("c")).select("c.value", "c.seed", "c.patterns")
    contexts = stored(one.groupBy("value", "seed", "patterns").agg(F.count("*").alias("n")), "contexts")
    good, worth = score_graph(contexts, lambda patterns: corpus_counts(texts, patterns, "body"), rounds)
    rows = stored(docs_found.withColumn("row", F.monotonically_increasing_id()), "rows")
    # only where an own pattern is believed; other occurrences of the same value stay
    places = (
        rows.select("row", F.explode(F.filter("candidates", lambda c: ~c.seed)).alias("c"))
        .select("row", "c.value", "c.start", "c.end", F.explode("c.patterns").alias("pattern"))
        .join(worth, "pattern", "left_semi")
        .join(good, "value", "left_semi")
        .select("row", "start", "end")
        .distinct()
    )
    new = places.groupBy("row").agg(F.array_sort(F.collect_list(F.struct(F.lit(CONTEXT).alias("kind"), "start", "end"))).alias("more"))
    base = rows.select("row", "key", "base").join(new, "row", "left")
    as_text = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    own = F.transform("base", as_text)
    more = F.coalesce(F.transform("more", as_text), F.array().cast("array<string>"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size("base") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return base.select(
        F.col("key").alias(key),
        *counts,
        F.sha2(F.array_join(own, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(own, more), ",").alias("spans"),
        F.size(more).cast("long").alias("n_context"),
    )
