"""Near copies by fast similarity sketches, banding and exact verification.

A sketch has ``coordinates`` bins. In round i every shingle is thrown into one bin by a hash function of its own, with
value (i, hash); a bin keeps its smallest value, and the rounds stop when no bin is empty. From round ``coordinates`` on,
all shingles go to bin i - coordinates, so every bin fills whatever the size of the set. Two sets agree in a bin with the
chance of their Jaccard similarity, and the number of agreeing bins is concentrated as if the bins were independent.

Plan: equal shingle sets become one class (one representative each). Only representatives are sketched and banded. In a
bucket every member is checked against the bucket's leader, first the member most in the middle, then any other; what that
links forms components. Components that still share a bucket are then compared member by member inside blocks, so no pair
that shares a bucket is left unknown, while a large group of near copies needs about as many checks as it has members, and
its pairs are never rows. Checks use full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablespoon.llm.components import connected_components
from tablespoon.llm.words import NON_SPACE, blocks, hashed_words, mix64
from tablespoon.session import intermediates, stored

BANDS, ROWS = 45, 6  # a pair at similarity 0.8 shares no bucket with a chance of (1 - 0.8**6)**45 = 1e-6
FILTER_BITS = 1 << 23
BLOCK_SHINGLES = 1 << 16  # shingles of a block when components are compared
_U = np.uint64
_TURN = _U(0xD6E8FEB86659FD93)


def shingle_sets(hashes: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct ``n``-word shingles of every row and their bounds; a row of fewer words is one shingle."""
    size = np.diff(rows)
    row = np.repeat(np.arange(len(size)), size)
    with np.errstate(over="ignore"):
        value = np.zeros(len(hashes), dtype=_U)
        for k in range(n):
            moved = hashes[k:] if k == 0 else np.concatenate([hashes[k:], np.zeros(min(k, len(hashes)), dtype=_U)])
            inside = np.arange(len(hashes)) + k < rows[1:][row] if len(hashes) else np.zeros(0, dtype=bool)
            value = np.where(inside, mix64(value + moved * _TURN + _U(k)), value)
    whole = np.arange(len(hashes)) + n <= rows[1:][row] if len(hashes) else np.zeros(0, dtype=bool)
    first = np.zeros(len(hashes), dtype=bool)
    short = (size < n) & (size > 0)
    first[rows[:-1][short]] = True
    take = whole | first
    row, value = row[take], value[take]
    order = np.argsort(value)
    narrow = row.astype(np.uint16) if len(size) <= 1 << 16 else row
    order = order[np.argsort(narrow[order], kind="stable")]
    row, value = row[order], value[order]
    fresh = np.ones(len(row), dtype=bool)
    if len(row):
        fresh[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    row, value = row[fresh], value[fresh]
    return value, np.searchsorted(row, np.arange(len(size) + 1))


def sketch(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """Fast similarity sketch of one non-empty set."""
    out = np.full(coordinates, np.iinfo(np.uint64).max, dtype=_U)
    # about coordinates * (ln coordinates + 2) throws fill all bins; later rounds cannot change a filled bin
    step = max(int(coordinates * (np.log(coordinates) + 2) / len(shingles)) + 1, 1)
    begin = 0
    while begin < coordinates and out.max() == np.iinfo(np.uint64).max:
        rounds = np.arange(begin, min(begin + step, coordinates), dtype=_U)
        drawn = mix64(shingles[None, :] ^ (mix64(rounds + _U(1)))[:, None])
        bins = (drawn % _U(coordinates)).astype(np.int64)
        np.minimum.at(out, bins.ravel(), ((rounds << _U(48))[:, None] | (drawn >> _U(16))).ravel())
        begin += step
    empty = np.flatnonzero(out == np.iinfo(np.uint64).max)
    if len(empty):
        rounds = empty.astype(_U) + _U(coordinates)
        drawn = mix64(shingles[None, :] ^ (mix64(rounds + _U(1)))[:, None])
        out[empty] = (rounds << _U(48)) | (drawn >> _U(16)).min(axis=1)
    return out


def band_keys(sketches: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit bucket for each sketch and band."""
    parts = sketches.reshape(len(sketches), bands, rows)
    key = np.broadcast_to(mix64(np.arange(bands, dtype=_U) + _U(77)), parts.shape[:2])
    for k in range(rows):
        key = mix64(key * _TURN + parts[:, :, k])
    return key


def _digests(value: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """Sixteen bytes for each set: two sums of differently mixed shingles."""
    at = bounds[:-1]
    size = np.diff(bounds)
    both = np.zeros((len(size), 2), dtype=_U)
    with np.errstate(over="ignore"):
        for k in (0, 1):
            mixed = np.append(mix64(value ^ _U(k + 1) * _TURN), _U(0))  # an empty set at the end has a place too
            both[:, k] = np.where(size > 0, np.add.reduceat(mixed, at), 0)
    return [x.tobytes() for x in both]


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values.view(np.int64), pa.int64()))


def with_buckets(docs: DataFrame, text: str, key: str, n: int, bands: int, rows: int, least: int) -> DataFrame:
    """``key`` with ``n_shingles``, ``digest`` (null for a text without words) and the buckets of sets of ``least`` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text):
            words = hashed_words(block.data, block.bounds, NON_SPACE)
            value, bounds = shingle_sets(words.hashes, words.rows, n)
            size = np.diff(bounds)
            digests = [d if k else None for d, k in zip(_digests(value, bounds), size)]
            take = np.flatnonzero(size >= least)
            keys = np.zeros((0, bands), dtype=_U)
            if len(take):
                keys = band_keys(np.stack([sketch(value[bounds[i] : bounds[i + 1]], bands * rows) for i in take]), bands, rows)
            ends = np.concatenate([[0], np.cumsum(size >= least)]) * bands
            yield pa.RecordBatch.from_arrays(
                [
                    block.rows.column(block.rows.schema.get_field_index(key)),
                    pa.array(size, pa.int64()),
                    pa.array(digests, pa.binary()),
                    _lists(keys.ravel(), ends),
                ],
                [key, "n_shingles", "digest", "buckets"],
            )

    return _mapped(docs, text, [key], run, "n_shingles long, digest binary, buckets array<long>")


def _mapped(docs: DataFrame, text: str, keep: list[str], run, added: str) -> DataFrame:
    fields = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join([*(f"`{c}` {fields[c]}" for c in keep), added])
    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)


def _filter_bits(keys: DataFrame, key: str) -> np.ndarray:
    """A Bloom filter of fixed size with two bits for each key; what it lets through is checked by a join."""
    bits = [F.pmod(F.xxhash64(F.col(key), F.lit(i)), F.lit(FILTER_BITS)) for i in (1, 2)]
    place = keys.select(F.explode(F.array(*bits)).alias("bit"))
    byte = place.groupBy(F.floor(F.col("bit") / 8).alias("byte")).agg(
        F.bit_or(F.expr("shiftleft(1, cast(bit % 8 AS int))")).alias("bits")
    )
    out = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for row in byte.toLocalIterator():
        out[row.byte] = row.bits
    return out


def _sets(docs: DataFrame, wanted: DataFrame, text: str, key: str, n: int) -> DataFrame:
    """(item, shingles) of the classes in ``wanted`` (item, key, digest), whatever other texts a key has.

    Texts of other keys are passed over where they are read.
    """
    spark = docs.sparkSession
    bits = spark.sparkContext.broadcast(_filter_bits(wanted, key))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = bits.value
        for batch in batches:
            at = [batch.column(i).to_numpy() for i in (1, 2)]
            hit = [(known[x >> 3] >> (x & 7).astype(np.uint8)) & 1 for x in at]
            take = np.flatnonzero(hit[0] & hit[1])
            if not len(take):
                continue
            for block in blocks(iter([batch.take(pa.array(take))]), text):
                words = hashed_words(block.data, block.bounds, NON_SPACE)
                value, bounds = shingle_sets(words.hashes, words.rows, n)
                yield pa.RecordBatch.from_arrays(
                    [block.rows.column(0), pa.array(_digests(value, bounds), pa.binary()), _lists(value, bounds)],
                    [key, "digest", "shingles"],
                )

    bit = [F.pmod(F.xxhash64(F.col(key), F.lit(i)), F.lit(FILTER_BITS)).alias(f"bit{i}") for i in (1, 2)]
    fields = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    rows = docs.select(key, *bit, text).where(F.col(key).isNotNull())
    made = rows.mapInArrow(run, f"`{key}` {fields[key]}, digest binary, shingles array<long>").join(wanted, [key, "digest"])
    return made.groupBy("item").agg(F.any_value("shingles").alias("shingles"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets have 100 * intersection >= percent * union."""
    left = sets.select(F.col("doc").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("doc").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (
        pairs.join(right, "b")
        .join(left, "a")
        .where(both * (100 + percent) >= (F.size("sa") + F.size("sb")) * percent)
        .select("a", "b")
    )


def _candidates(pairs: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs of sizes that allow the similarity."""
    fits = F.least("size_a", "size_b") * 100 >= F.greatest("size_a", "size_b") * percent
    return pairs.where(fits).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_copies(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """(key, n_shingles, component_id, kept) of every row of ``docs``, ``key`` being an integer.

    Shingles are ``words`` whitespace-separated words, A-Z lower-cased; a shorter text is one shingle, a text without
    words (null, empty) has none and is linked with nothing. Texts are linked at ``percent`` of the union of their sets;
    ``component_id`` is the smallest key that links reach. A row without a key gets no component and is not kept; rows
    that share a key are one document for the links, and each gets its class by its own text.
    """
    # a set of fewer than ``least`` shingles can only be linked with an equal one
    least = -(-percent // (100 - percent)) if percent < 100 else 1 << 62
    texts = docs.select(F.col(key).alias("doc"), F.col(text).alias("body"))
    with intermediates(docs.sparkSession, keep=("digests", "by_class")):
        seen = stored(with_buckets(texts, "body", "doc", words, bands, rows, least), "digests")
        classes = seen.where("digest IS NOT NULL AND doc IS NOT NULL").groupBy("digest").agg(
            F.min("doc").alias("rep"), F.any_value("n_shingles").alias("size"), F.any_value("buckets").alias("buckets")
        )
        classes = stored(classes.withColumn("item", F.monotonically_increasing_id()), "classes")
        links = _links(classes, texts, words, percent).unionByName(_of_one_key(seen, classes))
        parts = stored(connected_components(links), "parts").withColumnRenamed("node", "item")
        named = parts.join(classes.select("item", "rep"), "item").groupBy("component").agg(F.min("rep").alias("name"))
        by_class = (
            classes.select("item", "digest", "rep").join(parts, "item", "left").join(named, "component", "left")
            .select("digest", F.coalesce("name", "rep").alias("component"))
        )
        by_class = stored(by_class, "by_class")
    out = seen.select("doc", "n_shingles", "digest").join(by_class, "digest", "left")
    component = F.when(F.col("doc").isNotNull(), F.coalesce("component", "doc"))
    return out.select(
        F.col("doc").alias(key),
        "n_shingles",
        component.alias("component_id"),
        (F.coalesce(component == F.col("doc"), F.lit(False))).alias("kept"),
    )


def _of_one_key(seen: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes of rows that share a key."""
    known = seen.where("digest IS NOT NULL AND doc IS NOT NULL")
    several = stored(known.groupBy("doc").agg(F.count("*").alias("n")).where("n > 1").select("doc"), "several")
    items = known.join(several, "doc").select("doc", "digest").join(classes.select("digest", "item"), "digest")
    first = items.groupBy("doc").agg(F.min("item").alias("a"))
    return items.join(first, "doc").where("a <> item").select("a", F.col("item").alias("b"))


def _links(classes: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Verified pairs of items that connect all classes which share a bucket and are similar enough."""
    member = classes.select(F.col("item").alias("doc"), "size", F.explode("buckets").alias("bucket"))
    shared = member.groupBy("bucket").agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.count("*").alias("many"))
    shared = stored(shared.where("first < last").select("bucket", "many"), "buckets")
    member = stored(member.join(shared, "bucket"), "members")
    # documents in the middle of a group lie in its largest buckets
    involved = stored(member.groupBy("doc").agg(F.sum("many").alias("weight")), "involved")
    wanted = involved.select(F.col("doc").alias("item")).join(classes.select("item", "digest", F.col("rep").alias("doc")), "item")
    sets = stored(_sets(texts, wanted, "body", "doc", words).withColumnRenamed("item", "doc"), "sets")
    member = stored(member.join(involved, "doc").select("bucket", "doc", "size", "weight"), "members")
    links = None
    parts = None
    for order in (F.col("weight"), F.xxhash64("bucket", "doc")):
        placed = _placed(member, parts)
        pairs = _candidates(_with_leaders(placed, order), percent)
        found = stored(_verified(stored(pairs, "tried"), sets, percent), "linked")
        links = found if links is None else links.unionByName(found)
        parts = stored(connected_components(links), "parts").withColumnRenamed("node", "doc")
    return links.unionByName(_between_components(stored(_placed(member, parts), "placed"), sets, percent))


def _placed(member: DataFrame, parts: DataFrame | None) -> DataFrame:
    if parts is None:
        return member.withColumn("component", F.col("doc"))
    return member.join(parts, "doc", "left").withColumn("component", F.coalesce("component", "doc"))


def _with_leaders(placed: DataFrame, order: Column) -> DataFrame:
    """Every member of a bucket with the bucket's leader, the one of largest ``order``, where these are not linked yet."""
    rank = F.struct(order.alias("rank"), "doc", "size", "component")
    leader = placed.groupBy("bucket").agg(F.max(rank).alias("l"))
    leader = leader.select("bucket", F.col("l.doc").alias("a"), F.col("l.size").alias("size_a"), F.col("l.component").alias("its"))
    pairs = placed.join(leader, "bucket").where(F.col("component") != F.col("its"))
    return pairs.select("a", "size_a", F.col("doc").alias("b"), F.col("size").alias("size_b"))


def _between_components(placed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components that share a bucket, all members of one against all of the other, without pair rows.

    The largest component of a bucket is its hub, the others are guests of the hub. So two components that share a bucket
    are hub and guest, or guests of one hub. Members of hub and guests are dealt by hash into blocks of bounded shingle
    counts; a row has two blocks and yields no more links than connect what is near in them.
    """
    per = placed.groupBy("bucket", "component").agg(F.lit(1).alias("one"))
    several = per.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    whole = stored(placed.groupBy("doc", "size", "component").agg(F.lit(1).alias("one")).drop("one"), "whole")
    weight = whole.groupBy("component").agg(F.sum("size").alias("weight"))
    per = per.join(several, "bucket", "left_semi").join(weight, "component").select("bucket", "component", "weight")
    per = stored(per, "open")
    hub = per.groupBy("bucket").agg(F.max(F.struct("weight", "component")).alias("h"))
    hub = hub.select("bucket", F.col("h.component").alias("hub"), F.col("h.weight").alias("hub_weight"))
    visits = per.join(hub, "bucket").where("component <> hub").select("hub", "hub_weight", "component", "weight").distinct()
    visits = stored(visits, "visits")
    parts = lambda c: F.floor(F.col(c) / BLOCK_SHINGLES) + 1
    totals = visits.groupBy("hub").agg(F.max("hub_weight").alias("h"), F.sum("weight").alias("g"))
    totals = stored(totals.select("hub", parts("h").alias("h"), parts("g").alias("g")), "totals")
    block = lambda c: F.pmod(F.xxhash64("doc"), F.col(c)).alias("block")
    content = F.collect_list(F.struct("doc", "component", "shingles")).alias("members")
    at_home = totals.withColumn("component", F.col("hub")).join(whole, "component").select("hub", "doc", "component", block("h"))
    guests = visits.select("hub", "component").join(totals, "hub").join(whole, "component").select("hub", "doc", "component", block("g"))
    hosts = at_home.join(sets, "doc").groupBy("hub", "block").agg(content)
    guests = stored(guests.join(sets, "doc").groupBy("hub", "block").agg(content), "guests")
    left = hosts.select("hub", F.lit(-1).cast("long").alias("lb"), F.col("members").alias("left")).unionByName(
        guests.select("hub", F.col("block").alias("lb"), F.col("members").alias("left"))
    )
    right = guests.select("hub", F.col("block").alias("rb"), F.col("members").alias("right"))
    rows = left.join(right, "hub").where("lb <= rb").select("left", "right")
    return rows.mapInArrow(_compare_blocks(percent), "a long, b long")


def _compare_blocks(percent: int):
    def members(column: pa.Array, at: int):
        found = column.slice(at, 1).flatten()
        shingles = found.field(2)
        bounds = shingles.offsets.to_numpy()
        values = shingles.values.to_numpy()[bounds[0] : bounds[-1]]
        return found.field(0).to_pylist(), found.field(1).to_pylist(), values, bounds - bounds[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                names, groups, values, bounds = members(batch.column(0), at)
                others, other_groups, inner, inner_bounds = members(batch.column(1), at)
                size = np.diff(bounds)
                root = {g: g for g in [*groups, *other_groups]}

                def find(g):
                    while root[g] != g:
                        root[g] = g = root[root[g]]
                    return g

                a, b = [], []
                for i, other in enumerate(others):
                    mine = np.sort(inner[inner_bounds[i] : inner_bounds[i + 1]])
                    slot = np.searchsorted(mine, values)
                    slot[slot == len(mine)] = 0
                    both = np.add.reduceat((mine[slot] == values).astype(np.int64), bounds[:-1])
                    for j in np.flatnonzero(both * (100 + percent) >= (size + len(mine)) * percent).tolist():
                        x, y = find(groups[j]), find(other_groups[i])
                        if x != y:
                            root[x] = y
                            a.append(min(names[j], other))
                            b.append(max(names[j], other))
                yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Rows of ``docs``, all columns as they are, with one row of each group of near copies.

    It is the row whose key names the group; of several such rows the one with the smallest text hash. Rows without words
    are no copies of each other and stay unless their key repeats; rows without a key stay.
    """
    judged = near_copies(docs.select(F.col(key).alias(key), F.col(text).alias(text)), key, text, **options)
    per_key = judged.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__key")).agg(
        F.max("kept").alias("kept"), F.count("*").alias("n")
    )
    per_key = stored(per_key, "per_key")
    # the keys that do not simply stay are the shorter list, so texts meet it without a shuffle while it is small
    leave = stored(per_key.where("n > 1 OR NOT kept").select("__key"), "leave")
    again = stored(per_key.where("n > 1 AND kept").select("__key"), "again")
    rows = docs.select(F.struct("*").alias("__doc"), F.col(key).alias("__key"), F.xxhash64(text).alias("__hash"))
    single = rows.join(leave, "__key", "left_anti").select("__doc")  # rows without a key stay here
    first = rows.join(again, "__key", "left_semi").groupBy("__key").agg(F.min_by("__doc", "__hash").alias("__doc"))
    return single.unionByName(first.select("__doc")).select("__doc.*")
