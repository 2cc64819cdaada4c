"""Phrases of two to four words that stand together more often than their parts suggest, per language.

Words are units of one language: their 64-bit hash holds the language. Units are ranked by frequency and phrases are
counted level by level, a phrase of ``k + 1`` words as the address (rank of its first ``k`` words, rank of its last word):

- The address space is cut into square tiles. A tile that a block of text hits often is counted by ``numpy.bincount`` into
  a dense array that lives as long as the task; all other tiles are sorted coordinate lists with counts.
- Only units that occur often enough are ranked, so a phrase is counted only where its first and its last ``k`` words are
  frequent themselves. Frequent phrases are ranked again and are the rows of the next level's tiles.
- Ranks are given to the ``heads`` most frequent units of a level, which is what tasks receive. Frequent units beyond stand
  in a bitmap of fixed size and are counted by their hashes, so every count is whole at any size of the vocabulary.

Each level is one scan of the text and one sum of partial counts; text is never shuffled.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablespoon.llm.suffix_dedup import _marked, bitmap
from tablespoon.llm.words import blocks, byte_class, hash_spans, lower_ascii, mix64, word_spans
from tablespoon.session import intermediates, stored

LEAST = 30
TOP = 2000
COVER = 80  # percent of a phrase's occurrences that a longer one may hold
HEADS = 1 << 19
FILTER_BITS = 26
TILE_BITS = 10
BATCH_ROWS = 1000
BLOCK_BYTES = 1 << 19  # text handled at once
DENSE = 1 << 12  # hits of a block from which a tile of 2**20 cells is an array
DENSE_TILES = 4  # arrays that a task keeps
WORDS_HELD = 200_000  # counted words that a task gathers before it hands them on
LISTED = 3 << 18  # distinct addresses that a task gathers before it hands them on
SALTS = 64

_WORD = byte_class(b" \t.,;:!?\n\x0b\x0c\r")
_ENDS_PIECE = ~byte_class(b".,;:!?\n\x0b\x0c\r")
_COUNTS = "h long, l long, r long, s long, n long"


def _combined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of the phrase made of two units."""
    return mix64(left * np.uint64(0xD6E8FEB86659FD93) + right)


@dataclass
class Ranks:
    """Frequent units of one level: the heads by rank, and the rest in a bitmap."""

    heads: np.ndarray  # hashes by rank
    ends: np.ndarray  # hash of each head without its first word
    rest: np.ndarray | None = None
    order: np.ndarray = field(init=False)
    sorted: np.ndarray = field(init=False)

    def __post_init__(self):
        self.order = np.argsort(self.heads)
        self.sorted = self.heads[self.order]

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each hash, -1 for others, and whether it may be frequent."""
        if len(self.sorted):
            slot = np.searchsorted(self.sorted, hashes)
            slot[slot == len(self.sorted)] = 0
            rank = np.where(self.sorted[slot] == hashes, self.order[slot], -1)
        else:
            rank = np.full(len(hashes), -1)
        return rank, (rank >= 0) if self.rest is None else (rank >= 0) | _marked(self.rest, hashes)


def _languages(column: pa.Array) -> tuple[np.ndarray, list[str]]:
    names = [x if x is not None else "und" for x in column.to_pylist()]
    salt = {x: xxhash.xxh64_intdigest(x.encode()) for x in set(names)}
    return np.array([salt[x] for x in names], dtype=np.uint64), names


def _units(block, lang: str):
    """(hash, linked to the next word, lower-cased bytes, first byte, length, row) of every word of a block."""
    data = lower_ascii(block.data)
    starts, lengths = word_spans(data, block.bounds, _WORD)
    salts, names = _languages(block.rows.column(block.rows.schema.get_field_index(lang)))
    row = np.searchsorted(block.bounds, starts, side="right") - 1
    hashes = mix64(hash_spans(data, starts, lengths) ^ salts[row])
    piece = np.cumsum(_ENDS_PIECE[data], dtype=np.int64)[starts] if len(starts) else starts
    linked = np.zeros(len(starts), dtype=bool)
    linked[:-1] = (piece[1:] == piece[:-1]) & (row[1:] == row[:-1])
    return hashes, linked, data, starts, lengths, row, names


def _word_counts(text: str, lang: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: list[pa.RecordBatch] = []
        for block in blocks(batches, text, BLOCK_BYTES):
            hashes, _, data, starts, lengths, row, names = _units(block, lang)
            found, first, n = np.unique(hashes, return_index=True, return_counts=True)
            raw = data.tobytes()
            at, size = starts[first].tolist(), lengths[first].tolist()
            columns = [
                pa.array(found.view(np.int64)), pa.array([names[i] for i in row[first]], pa.string()),
                pa.array([raw[a : a + k].decode() for a, k in zip(at, size)], pa.string()), pa.array(n, pa.int64()),
            ]
            known.append(pa.RecordBatch.from_arrays(columns, ["h", "lang", "phrase", "n"]))
            if sum(x.num_rows for x in known) > WORDS_HELD:
                known = [_merged_words(known)]
                if 2 * known[0].num_rows > WORDS_HELD:
                    yield known.pop()
        if known:
            yield _merged_words(known)

    return run


def _merged_words(counted: list[pa.RecordBatch]) -> pa.RecordBatch:
    rows = pa.Table.from_batches(counted).combine_chunks().to_batches()
    if not rows:
        return counted[0]
    rows = rows[0]
    _, first, back = np.unique(rows.column(0).to_numpy(), return_index=True, return_inverse=True)
    n = np.bincount(back, weights=rows.column(3).to_numpy()).astype(np.int64)
    some = rows.take(pa.array(first))
    return some.set_column(3, "n", pa.array(n))


class Tiles:
    """Counts of (row rank, column rank) addresses and, beyond the ranks, of hashes."""

    def __init__(self, rows: Ranks, columns: Ranks):
        self.rows, self.columns = rows, columns
        self.across = (len(columns.heads) >> TILE_BITS) + 1
        self.dense: dict[int, np.ndarray] = {}
        self.listed = [np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)]
        self.pending: list[np.ndarray] = []

    def add(self, row: np.ndarray, column: np.ndarray) -> None:
        tile = (row >> TILE_BITS) * self.across + (column >> TILE_BITS)
        if len(tile):
            found, n = np.unique(tile, return_counts=True)
            hot = found[(n >= DENSE) | np.isin(found, list(self.dense))]
            for one in hot[np.argsort(-n[np.isin(found, hot)], kind="stable")].tolist():
                if one not in self.dense and len(self.dense) == DENSE_TILES:
                    continue
                here = tile == one
                low = (1 << TILE_BITS) - 1
                cell = ((row[here] & low) << TILE_BITS) | (column[here] & low)
                counted = np.bincount(cell, minlength=1 << 2 * TILE_BITS)
                if one in self.dense:
                    self.dense[one] += counted.astype(np.int32)
                else:
                    self.dense[one] = counted.astype(np.int32)
                row, column, tile = row[~here], column[~here], tile[~here]
        self.pending.append((row << 32) | column)

    def compact(self) -> int:
        """Join pending addresses to the sorted list; returns its length."""
        if self.pending:
            keys, n = np.unique(np.concatenate(self.pending), return_counts=True)
            self.pending = []
            both = np.concatenate([self.listed[0], keys])
            order = np.argsort(both, kind="stable")  # two sorted runs
            both, n = both[order], np.concatenate([self.listed[1], n])[order]
            head = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(both) else np.zeros(0, dtype=np.int64)
            self.listed = [both[head], np.add.reduceat(n, head) if len(head) else n]
        return len(self.listed[0])

    def flush(self) -> Iterator[pa.RecordBatch]:
        self.compact()
        keys, n = self.listed
        self.listed = [np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)]
        yield from self._counts(keys >> 32, keys & 0xFFFFFFFF, n)
        for tile, cells in self.dense.items():
            some = np.flatnonzero(cells)
            row = (tile // self.across << TILE_BITS) + (some >> TILE_BITS)
            yield from self._counts(row, (tile % self.across << TILE_BITS) + (some & ((1 << TILE_BITS) - 1)), cells[some])
        self.dense = {}

    def _counts(self, row: np.ndarray, column: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Addresses as one number each, without the hashes that they stand for."""
        for at in range(0, len(row), 1 << 16):
            address = (row[at : at + (1 << 16)] << 32) | column[at : at + (1 << 16)]
            none = np.zeros(len(address), dtype=np.int64)
            yield _count_rows(address, none, none, none, n[at : at + (1 << 16)])


def _count_rows(key, left, right, rest, n) -> pa.RecordBatch:
    columns = [pa.array(x.view(np.int64)) for x in (key, left, right, rest)]
    return pa.RecordBatch.from_arrays([*columns, pa.array(n.astype(np.int64))], ["h", "l", "r", "s", "n"])


def _hashed(levels):
    """Frequent addresses and hashes to phrases: (hash, first words, last word, all but the first word, count)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = levels.value
        for batch in batches:
            key, left, right, rest, n = (batch.column(batch.schema.get_field_index(c)).to_numpy().copy() for c in ("h", "l", "r", "s", "n"))
            left, right, rest = (x.view(np.uint64) for x in (left, right, rest))
            ranked = key >= 0
            row, column = key[ranked] >> 32, key[ranked] & 0xFFFFFFFF
            left[ranked], right[ranked] = ranks[-1].heads[row], ranks[0].heads[column]
            # of a pair the part without the first word is the second word itself
            rest[ranked] = right[ranked] if len(ranks) == 1 else _combined(ranks[-1].ends[row], right[ranked])
            yield _count_rows(_combined(left, right), left, right, rest, n)

    return run


def _phrase_counts(levels, text: str, lang: str):
    """Counts of phrases one word longer than the units of the last of ``levels``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = levels.value
        tiles = Tiles(ranks[-1], ranks[0])
        for block in blocks(batches, text, BLOCK_BYTES):
            word, linked, *_ = _units(block, lang)
            word_rank, frequent = ranks[0].find(word)
            unit, rank, at = word, word_rank, np.flatnonzero(frequent)  # places where a frequent unit begins
            unit, rank = unit[at], rank[at]
            for size, level in enumerate(ranks[1:], start=1):
                next_ = np.flatnonzero((at[1:] == at[:-1] + 1) & linked[at[:-1] + size - 1])
                at, unit = at[next_], _combined(unit[next_], word[at[next_] + size])
                rank, frequent = level.find(unit)
                at, unit, rank = at[frequent], unit[frequent], rank[frequent]
            size = len(ranks)
            next_ = np.flatnonzero((at[1:] == at[:-1] + 1) & linked[at[:-1] + size - 1])
            left, last = rank[next_], at[next_] + size
            ranked = (left >= 0) & (word_rank[last] >= 0)
            tiles.add(left[ranked], word_rank[last[ranked]])
            other = next_[~ranked]
            if len(other):
                yield from _by_hash(unit[other], word[at[other] + size], unit[other + 1])
            if sum(map(len, tiles.pending)) > LISTED // 2 and tiles.compact() > LISTED:
                yield from tiles.flush()
        yield from tiles.flush()

    return run


def _by_hash(left, right, rest) -> Iterator[pa.RecordBatch]:
    """Phrases with a part beyond the ranks; their keys are negative, those of addresses are not."""
    key, first, n = np.unique(_combined(left, right) | np.uint64(1 << 63), return_index=True, return_counts=True)
    yield _count_rows(key, left[first], right[first], rest[first], n)


def _ranks(units: DataFrame, end: str, heads: int, bits: int) -> Ranks:
    """The ``heads`` most frequent rows of ``units`` come to the driver; of the others a bitmap, if there are any."""
    top = units.orderBy(F.desc("n"), "h").limit(heads).select("h", F.col(end).alias("end")).toArrow()
    rest = bitmap(units, bits=bits) if len(top) == heads else None
    return Ranks(*(top[c].to_numpy().view(np.uint64) for c in ("h", "end")), rest)


def _scores(cuts: list[tuple[Column, Column]]) -> Column:
    """The lowest score of a phrase cut after 1, 2, ... words, and its parts' counts; ties go to the first cut."""
    million = F.col("n").cast("decimal(20,0)") * 2_000_000  # exact: whole decimals, divided without a fraction
    scored = [
        F.struct(F.call_function("div", million, (l + r).cast("decimal(28,0)")).alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r"))
        for k, (l, r) in enumerate(cuts, start=1)
    ]
    return F.array_min(F.array(*scored))


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", *, least: int = LEAST, top: int = TOP, cover: int = COVER,
    heads: int = HEADS, bits: int = FILTER_BITS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the ``top`` phrases of every language.

    A phrase has 2 to 4 words of one piece of text and at least ``least`` occurrences ``a``, overlaps included. It is cut
    where ``floor(2000000 * a / (l + r))`` is lowest, ``l`` and ``r`` being the counts of the two parts, and goes if a
    longer phrase that contains it has at least ``cover`` percent of its occurrences. ``n`` counts all words of the language.
    Order: score and ``a`` descending, then the phrase by its bytes.

    Null and empty texts have no words; a null language is ``und``; repeated rows count as often as they stand; an empty
    table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    scan = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    with _small_batches(spark), intermediates(spark, keep=("ranked",)):
        counted = scan.mapInArrow(_word_counts("text", "lang"), "h long, lang string, phrase string, n long")
        words = stored(counted.groupBy("h", "lang", "phrase").agg(F.sum("n").alias("n")), "words")
        totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
        levels = [stored(words.where(F.col("n") >= least), "units")]
        ranks = [_ranks(levels[0], "h", heads, bits)]
        for size in (2, 3, 4):
            known = spark.sparkContext.broadcast(ranks)
            partial = scan.mapInArrow(_phrase_counts(known, "text", "lang"), _COUNTS)
            summed = partial.groupBy("h").agg(F.sum("n").alias("n"), *(F.any_value(c).alias(c) for c in "lrs"))
            frequent = summed.where(F.col("n") >= least).select("h", "l", "r", "s", "n")
            levels.append(stored(frequent.mapInArrow(_hashed(known), _COUNTS), "units"))
            if size < 4:
                ranks.append(_ranks(levels[-1], "s", heads, bits))
        ranked = _best(_judged(levels, cover), totals, top)
        return stored(ranked, "ranked")


@contextlib.contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Texts go to Python workers in batches of ``BATCH_ROWS``; all passes run inside."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _judged(levels: list[DataFrame], cover: int) -> DataFrame:
    """(lang, phrase, n, best) of all phrases that no longer one covers; ``best`` has score and parts."""
    words = levels[0].select("h", "lang", "phrase", "n", F.col("n").alias("n1"))
    out, below = [], words
    for size, level in enumerate(levels[1:], start=2):
        a, b, c = below.alias("a"), words.alias("b"), below.alias("c")
        rows = level.alias("p").join(a, F.col("p.l") == F.col("a.h")).join(b, F.col("p.r") == F.col("b.h"))
        cuts = [(F.col("n1"), F.col("nr"))]
        named = [
            F.col("p.h").alias("h"), F.col("p.n").alias("n"), F.col("a.lang").alias("lang"), F.col("a.n1").alias("n1"),
            F.concat_ws(" ", "a.phrase", "b.phrase").alias("phrase"), F.col("b.n").alias("nr"), F.col("a.n").alias("nl"),
        ]
        if size > 2:
            rows = rows.join(c, F.col("p.s") == F.col("c.h"))
            named.append(F.col("c.n").alias("ns"))
            cuts = [(F.col("n1"), F.col("ns")), (F.col("nl"), F.col("nr"))]
        if size > 3:
            named += [F.col("a.nl").alias("front"), F.col("c.ns").alias("back")]
            cuts.insert(1, (F.col("front"), F.col("back")))
        below = stored(rows.select(*named), "phrases")
        kept = below
        if size < len(levels):
            longer = levels[size]
            inside = longer.select(F.col("l").alias("h"), "n").unionByName(longer.select(F.col("s").alias("h"), "n"))
            most = inside.groupBy("h").agg(F.max("n").alias("most"))
            # what a phrase two words longer covers, one of a word more that lies between covers as well
            kept = below.join(most, "h", "left").where(F.coalesce(F.col("most"), F.lit(0)) * 100 < F.col("n") * cover)
        out.append(kept.select("lang", "phrase", "n", _scores(cuts).alias("best")))
    return out[0].unionByName(out[1]).unionByName(out[2])


def _best(phrases: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    rows = phrases.select(
        "lang", "phrase", F.col("n").alias("a"), "best.l", "best.r", "best.score", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).alias("salt")
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    for part in (["lang", "salt"], ["lang"]):  # a language is ranked in parts first
        place = F.row_number().over(Window.partitionBy(*part).orderBy(*order))
        rows = rows.withColumn("rank", place.cast("long")).where(F.col("rank") <= top)
    return rows.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
