"""Benchmark decontamination with suffix arrays over the training text.

Each task cuts its documents into shards of bounded size and sorts the word suffixes of a shard. Every suffix of every
test item is then found in the array by a binary search that goes one word deeper at a time, all test suffixes at once,
so each ends with its longest verbatim match and all its locations. Text is never shuffled.

Only suffixes that begin with a word of the test set are sorted (no other can match), and only as deep as the longest
item is long, which no match can exceed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablespoon.llm.words import ALNUM, blocks, hashed_words, text_bytes
from tablespoon.session import stored

WINDOW = 13
TEST_BLOCK_BYTES = 16 << 20
_ROW = "__row"

_FOUND = "n_words long, n_hit long, longest long, items array<string>, matches array<struct<item:string,start:long,length:long>>"


@dataclass
class TestSet:
    """Items as word numbers (1 upwards, by ``vocabulary``), each followed by 0."""

    names: list[str]  # distinct ids, sorted
    label: np.ndarray  # of each item: its place in ``names``
    vocabulary: np.ndarray
    text: np.ndarray
    begin: np.ndarray  # of each item in ``text``
    size: np.ndarray  # words of each item

    __test__ = False


def test_set(names: list[str], texts: list[str]) -> TestSet:
    data, bounds = text_bytes(pa.array(texts, type=pa.large_string()))
    words = hashed_words(data, bounds, ALNUM)
    vocabulary = np.unique(words.hashes)
    size = np.diff(words.rows)
    begin = words.rows[:-1] + np.arange(len(names))
    text = np.zeros(len(words.hashes) + len(names) + 1, dtype=np.int64)
    text[np.arange(len(words.hashes)) + np.repeat(np.arange(len(names)), size)] = (
        np.searchsorted(vocabulary, words.hashes) + 1
    )
    distinct = sorted(set(names))
    place = {name: i for i, name in enumerate(distinct)}
    label = np.array([place[name] for name in names], dtype=np.int64)
    return TestSet(distinct, label, vocabulary, text, begin, size)


test_set.__test__ = False


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of all non-zero words, sorted by the ``depth`` words that follow (at least).

    ``text`` ends with a zero; a zero sorts first and ends a comparison. Prefix doubling: the first sort takes as many
    words as fit into 63 bits, later ones only the positions that are still tied.
    """
    where = np.flatnonzero(text)
    bits = max(int(text.max(initial=0)).bit_length(), 1)
    known = max(63 // bits, 1)
    padded = np.concatenate([text, np.zeros(max(known, depth) * 2 + 1, dtype=np.int64)])
    key = np.zeros(len(where), dtype=np.int64)
    for k in range(known):
        key = (key << bits) | padded[where + k]
    order = np.argsort(key, kind="stable")
    found, key = where[order], key[order]
    rank = np.zeros(len(padded), dtype=np.int64)
    heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, dtype=np.int64)
    rank[found] = np.repeat(heads, np.diff(np.append(heads, len(found)))) + 1
    slots = np.arange(len(found))
    while known < depth and len(slots):
        group = rank[found[slots]]
        same = group[1:] == group[:-1]
        tied = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        slots = slots[tied]
        if not len(slots):
            break
        at, group = found[slots], group[tied]
        key = group * (len(padded) + 1) + rank[at + known]
        order = np.argsort(key, kind="stable")
        found[slots], key = at[order], key[order]
        heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        rank[found[slots]] = np.repeat(slots[heads], np.diff(np.append(heads, len(slots)))) + 1
        known *= 2
    return found


def _edge(text: np.ndarray, array: np.ndarray, low: np.ndarray, high: np.ndarray, deep: int, word: np.ndarray, right: bool):
    """First slot in [low, high) whose word at ``deep`` is not below (right: is above) ``word``."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = low < high
        if not open_.any():
            return low
        mid = (low + high) >> 1
        seen = text[array[np.where(open_, mid, 0)] + deep]
        up = open_ & ((seen <= word) if right else (seen < word))
        low = np.where(up, mid + 1, low)
        high = np.where(open_ & ~up, mid, high)


@dataclass
class Located:
    """Where the suffixes of a test set stand in a suffix array; ranges are [first, last) slots."""

    windows: np.ndarray  # distinct (first, last, words) of the windows that occur
    owner: np.ndarray  # (index in ``windows``, label) of every item with that window
    longest: np.ndarray  # of every test suffix: words of its longest match
    depth: np.ndarray  # of every slot: words of the longest match with any test suffix
    ranges: np.ndarray  # (depth, first) of all matched ranges, sorted
    label: np.ndarray  # of each: the first label of the items that have it


def locate(text: np.ndarray, array: np.ndarray, tests: TestSet, window: int) -> Located:
    """Finds all test suffixes at once, one word deeper in each round, so each ends with its longest match.

    Suffixes that agree so far share one range. The ranges of a round are disjoint and lie inside those of the round
    before, so a slot's longest match is the number of ranges around it: no match is spelled out by its places.
    """
    item = np.repeat(np.arange(len(tests.size)), tests.size)
    offset = np.arange(len(item)) - np.repeat(np.cumsum(tests.size) - tests.size, tests.size)
    by_label = np.argsort(tests.label[item], kind="stable")  # the first of equal ranges has the first label
    item, offset = item[by_label], offset[by_label]
    at = tests.begin[item] + offset
    low, high = np.zeros(len(at), dtype=np.int64), np.full(len(at), len(array), dtype=np.int64)
    need = np.minimum(tests.size, window)[item]
    longest = np.zeros(len(at), dtype=np.int64)
    hits, ranges, labels = [np.zeros((0, 4), dtype=np.int64)], [np.zeros((0, 2), dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    change = np.zeros(len(array) + 1, dtype=np.int64)
    active, deep = np.arange(len(at)), 0
    while len(active):
        word = tests.text[at[active] + deep]
        active, word = active[word > 0], word[word > 0]
        first = _edge(text, array, low[active], high[active], deep, word, False)
        last = _edge(text, array, first, high[active], deep, word, True)
        alive = first < last
        active = active[alive]
        low[active], high[active] = first[alive], last[alive]
        deep += 1
        longest[active] = deep
        begin, lead = np.unique(low[active], return_index=True)
        change[begin] += 1
        np.subtract.at(change, high[active[lead]], 1)
        ranges.append(np.stack([np.full(len(begin), deep), begin], axis=1))
        labels.append(tests.label[item[active[lead]]])
        full = active[need[active] == deep]
        full = full[(tests.size[item[full]] >= window) | (offset[full] == 0)]
        hits.append(np.stack([low[full], high[full], need[full], tests.label[item[full]]], axis=1))
    windows, owner = np.unique(np.concatenate(hits), axis=0), np.zeros((0, 2), dtype=np.int64)
    if len(windows):
        fresh = np.concatenate([[True], (windows[1:, :3] != windows[:-1, :3]).any(axis=1)])
        owner = np.stack([np.cumsum(fresh) - 1, windows[:, 3]], axis=1)
        windows = windows[fresh]
    back = np.empty(len(at), dtype=np.int64)
    back[by_label] = longest
    return Located(windows[:, :3], owner, back, np.cumsum(change[:-1]), np.concatenate(ranges), np.concatenate(labels))


def _spread(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All numbers of the ranges [first, last), one after the other."""
    size = last - first
    return np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)


def search_shard(words: np.ndarray, rows: np.ndarray, tests: TestSet, window: int):
    """Of each row: hit words, longest match; then (row, label) of the items and (row, label, first word, length) of matches.

    A text place belongs to one window of ``window`` words and at most one of each smaller size, so places and matches
    grow with the text, however often a window repeats in text and items.
    """
    n = len(rows) - 1
    size = np.diff(rows)
    if len(tests.vocabulary) == 0 or len(words) == 0:
        none = np.zeros(n, dtype=np.int64)
        return none, none, np.zeros((0, 2), dtype=np.int64), np.zeros((0, 4), dtype=np.int64)
    slot = np.searchsorted(tests.vocabulary, words)
    slot[slot == len(tests.vocabulary)] = 0
    number = np.where(tests.vocabulary[slot] == words, slot + 1, 0)
    begin = rows[:-1] + np.arange(n)
    text = np.zeros(len(words) + n + int(tests.size.max()) + 1, dtype=np.int64)
    text[np.arange(len(words)) + np.repeat(np.arange(n), size)] = number
    array = suffix_array(text, int(tests.size.max()))
    found = locate(text, array, tests, window)
    depth = np.zeros(len(text) + 1, dtype=np.int64)
    depth[array] = found.depth
    place_slot = np.zeros(len(text) + 1, dtype=np.int64)
    place_slot[array] = np.arange(len(array))

    many = found.windows[:, 1] - found.windows[:, 0]
    place = array[_spread(found.windows[:, 0], found.windows[:, 1])]
    which = np.repeat(np.arange(len(found.windows)), many)
    length = found.windows[which, 2]
    change = np.bincount(place, minlength=len(text) + 1) - np.bincount(place + length, minlength=len(text) + 1)
    hit = np.concatenate([[0], np.cumsum(np.cumsum(change)[: len(text)] > 0)])
    row = np.searchsorted(begin, place, side="right") - 1
    # rows and items of a window, each once
    pairs = np.unique((which << 32) | row)
    which_row, its_row = pairs >> 32, pairs & 0xFFFFFFFF
    first, last = (np.searchsorted(found.owner[:, 0], which_row, side=s) for s in ("left", "right"))
    owners = np.stack([np.repeat(its_row, last - first), found.owner[_spread(first, last), 1]], axis=1)
    # a match of a window or more is told where it begins: the place before has none that goes as far
    whole = length == window
    starts = place[whole]
    starts = starts[depth[np.maximum(starts - 1, 0)] * (starts > 0) != depth[starts] + 1]
    matches = [_matches(starts, depth[starts], _labels(found, depth[starts], place_slot[starts]), begin)]
    if not whole.all():  # items of fewer words
        short = ~whole
        names = found.owner[np.searchsorted(found.owner[:, 0], which[short]), 1]
        matches.append(_matches(place[short], length[short], names, begin))
    matches = np.unique(np.concatenate(matches), axis=0)
    best = np.zeros(n, dtype=np.int64)
    some = size > 0
    best[some] = np.maximum.reduceat(depth[: len(text)], begin)[some]
    return hit[begin + size] - hit[begin], best, np.unique(owners, axis=0), matches


def _labels(found: Located, depth: np.ndarray, slot: np.ndarray) -> np.ndarray:
    """First label of the range of each slot at its depth."""
    width = np.int64(len(found.depth) + 1)
    keys = found.ranges[:, 0] * width + found.ranges[:, 1]
    return found.label[np.searchsorted(keys, depth * width + slot, side="right") - 1]


def _matches(start: np.ndarray, length: np.ndarray, label: np.ndarray, begin: np.ndarray) -> np.ndarray:
    row = np.searchsorted(begin, start, side="right") - 1
    return np.stack([row, label, start - begin[row], length], axis=1)


def _annotate(tests, text: str, keep: list[str], window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tests.value
        for block in blocks(batches, text):
            words = hashed_words(block.data, block.bounds, ALNUM)
            hit, longest, pairs, matches = search_shard(words.hashes, words.rows, known, window)
            n = block.rows.num_rows
            bounds = np.searchsorted(pairs[:, 0], np.arange(n + 1))
            items = pa.ListArray.from_arrays(
                pa.array(bounds, pa.int32()), pa.array([known.names[i] for i in pairs[:, 1]], pa.string())
            )
            bounds = np.searchsorted(matches[:, 0], np.arange(n + 1))
            found = pa.StructArray.from_arrays(
                [
                    pa.array([known.names[i] for i in matches[:, 1]], pa.string()),
                    pa.array(matches[:, 2], pa.int64()),
                    pa.array(matches[:, 3], pa.int64()),
                ],
                ["item", "start", "length"],
            )
            columns = [block.rows.column(block.rows.schema.get_field_index(c)) for c in keep]
            columns += [
                pa.array(np.diff(words.rows), pa.int64()),
                pa.array(hit, pa.int64()),
                pa.array(longest, pa.int64()),
                items,
                pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), found),
            ]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "n_words", "n_hit", "longest", "items", "matches"])

    return run


def verbatim_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    keep: list[str] | None = None,
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    test_block_bytes: int = TEST_BLOCK_BYTES,
) -> DataFrame:
    """``docs[keep]`` with its verbatim matches of benchmark items.

    Added columns: ``n_words``; ``n_hit`` (words inside an occurrence of a window of an item); ``longest`` (words of the
    longest verbatim match with any item, also where it is shorter than a window); ``items`` (ids of items with such
    windows, as text, sorted as text); ``matches`` (item, first word, length): from each place on that a window begins at,
    the longest match with any item, unless it is the rest of a match from the place before, told with the first of the
    items that have it; and each occurrence of an item of fewer words. They replace columns of ``docs`` with the same name.

    An item of fewer words than ``window`` is one window, an item without words matches nothing. Null texts have no
    words; null item ids are called ``null``; repeated rows are judged one by one; repeated items with one id count
    once. Empty tables give no matches or no rows.

    The test set is broadcast in blocks of at most ``test_block_bytes`` of text (or one item). A larger set takes several
    passes, each with one block in memory; the passes' hits are put together by row.
    """
    own = ["n_words", "n_hit", "longest", "items", "matches", _ROW]
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in own]
    items = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("name"),
        F.coalesce(F.col(item_text), F.lit("")).alias("body"),
    )
    docs = docs.select(*dict.fromkeys([*keep, text]))
    size = items.agg(F.coalesce(F.sum(F.octet_length("body")), F.lit(0)).alias("n")).first().n
    if size <= test_block_bytes:
        rows = items.collect()
        return _judged(docs, [r.name for r in rows], [r.body for r in rows], text, keep, window)
    docs = stored(docs.withColumn(_ROW, F.monotonically_increasing_id()), "decontaminate")
    passes = [
        stored(_judged(docs, names, bodies, text, [*keep, _ROW], window), "decontaminate")
        for names, bodies in _test_blocks(items, test_block_bytes)
    ]
    return _merged(passes, keep)


def _test_blocks(items: DataFrame, test_block_bytes: int) -> Iterator[tuple[list[str], list[str]]]:
    names, bodies, size = [], [], 0
    for row in items.toLocalIterator():
        if size and size + len(row.body.encode()) > test_block_bytes:
            yield names, bodies
            names, bodies, size = [], [], 0
        names.append(row.name)
        bodies.append(row.body)
        size += len(row.body.encode())
    yield names, bodies


def _judged(docs: DataFrame, names: list[str], bodies: list[str], text: str, keep: list[str], window: int) -> DataFrame:
    tests = docs.sparkSession.sparkContext.broadcast(test_set(names, bodies))
    fields = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join([*(f"`{c}` {fields[c]}" for c in keep), _FOUND])
    return docs.mapInArrow(_annotate(tests, text, keep, window), schema)


def _merged(passes: list[DataFrame], keep: list[str]) -> DataFrame:
    """Hits of several passes over the same rows, put together by row number."""
    both = passes[0]
    for one in passes[1:]:
        both = both.unionByName(one)
    merged = both.groupBy(_ROW).agg(
        *(F.any_value(c).alias(c) for c in [*keep, "n_words"]),
        F.max("longest").alias("longest"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.flatten(F.collect_list("matches"))).alias("matches"),
    )
    runs = F.array_sort(F.transform("matches", lambda m: F.struct(m.start.alias("a"), (m.start + m.length).alias("b"))))
    covered = F.aggregate(
        runs,
        F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n")),
        lambda s, r: F.struct(
            F.greatest(s.end, r.b).alias("end"),
            (s.n + F.greatest(r.b - F.greatest(s.end, r.a), F.lit(0).cast("long"))).alias("n"),
        ),
        lambda s: s.n,
    )
    return merged.select(*keep, "n_words", covered.alias("n_hit"), "longest", "items", "matches")


def contaminated(n_hit, n_words):
    """The contamination rule: some hit, and at least one word in twenty hit."""
    return (n_hit > 0) & (n_hit * 20 >= n_words)


def clean_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """Rows of ``docs``, all columns as they are, without the contaminated ones."""
    packed = docs.select(F.struct("*").alias("__doc"), F.col(text).alias("__text"))
    found = verbatim_matches(packed, benchmark, "__text", ["__doc"], **options)
    return found.where(~contaminated(F.col("n_hit"), F.col("n_words"))).select("__doc.*")
