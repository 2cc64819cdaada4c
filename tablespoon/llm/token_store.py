"""Token files: ids of whole texts in key order, compressed shard by shard with a Re-Pair grammar.

Format: a Parquet table with one row per shard. ``part`` and ``shard`` give its place; ``keys`` and ``ends`` (symbols up to
the end of each document) its documents; ``base``, ``left``, ``right``, ``length`` its rules (little-endian, 16 bits where
all symbols fit, else 32; lengths 32); ``symbols`` the sequence itself; ``n_tokens`` the ids it stands for. Any document can
be decoded alone: no rule crosses a document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablespoon.llm import grammar
from tablespoon.llm.tokenize import TextEncoder
from tablespoon.llm.words import blocks

SHARD_TOKENS = 1 << 19  # a shard closes with the document that reaches this
ROW_GROUP_BYTES = 16 << 20

_SCHEMA = (
    "part int, shard int, keys array<{key}>, ends array<int>, base int, left binary, right binary, length binary, "
    "symbols binary, n_tokens long"
)
_encoders: dict[str, TextEncoder] = {}


def _encoder(vocabulary: str) -> TextEncoder:
    if vocabulary not in _encoders:
        _encoders[vocabulary] = TextEncoder(vocabulary)
    return _encoders[vocabulary]


def _shard_row(schema: pa.Schema, part: int, shard: int, keys: list, ids: np.ndarray, ends: np.ndarray, base: int):
    made = grammar.compress(ids, ends, base)
    values = [
        part, shard, keys, made.ends, base, made.left.tobytes(), made.right.tobytes(),
        made.length.astype(np.uint32).tobytes(), made.symbols.tobytes(), len(ids),
    ]
    return pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(values, schema)], schema=schema)


def _shards(vocabulary: str, key: str, key_type: pa.DataType, text: str, end_id: int, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small, raw = pa.int32(), pa.binary()
        schema = pa.schema(
            [("part", small), ("shard", small), ("keys", pa.list_(key_type)), ("ends", pa.list_(small)), ("base", small),
             ("left", raw), ("right", raw), ("length", raw), ("symbols", raw), ("n_tokens", pa.int64())]
        )
        encoder, part, shard = _encoder(vocabulary), TaskContext.get().partitionId(), 0
        base = max(encoder.size, end_id + 1)
        keys: list = []
        held: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        n = 0

        def closed():
            return _shard_row(schema, part, shard, keys, np.concatenate(held), np.cumsum(np.concatenate(sizes)), base)

        for block in blocks(batches, text):
            ids, ends = encoder.encode(block.data, block.bounds)
            ids = np.insert(ids, ends, end_id)
            ends = ends + np.arange(1, len(ends) + 1)
            names = block.rows.column(block.rows.schema.get_field_index(key)).to_pylist()
            row = 0
            while row < len(ends):
                before = int(ends[row - 1]) if row else 0
                stop = min(int(np.searchsorted(ends, before + shard_tokens - n)) + 1, len(ends))
                keys += names[row:stop]
                held.append(ids[before : ends[stop - 1]])
                sizes.append(np.diff(ends[row:stop], prepend=before))
                n += int(ends[stop - 1]) - before
                row = stop
                if n >= shard_tokens:
                    yield closed()
                    keys, held, sizes, n, shard = [], [], [], 0, shard + 1
        if keys:
            yield closed()

    return run


def write_tokens(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = 2,
    shard_tokens: int = SHARD_TOKENS,
) -> None:
    """Encode ``docs`` in ascending ``key`` order (null first; equal keys by text hash) and write the shards to ``path``.

    Each document is its text's ids and ``end_id``; a null text is empty, so it is ``end_id`` alone. Repeated rows are
    documents of their own. An empty table writes no shard.
    """
    kind = dict(docs.dtypes)[key]
    order = [F.col(key).asc_nulls_first(), F.xxhash64(text)]
    rows = docs.select(key, text).repartitionByRange(*order).sortWithinPartitions(*order).select(key, text)
    run = _shards(vocabulary, key, pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string(), text,
                  end_id, shard_tokens)
    shards = rows.mapInArrow(run, _SCHEMA.format(key=kind))
    shards.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)


def _grammar(row: dict) -> grammar.Grammar:
    kind = np.dtype("<u2") if row["base"] < 1 << 16 else np.dtype("<u4")
    return grammar.Grammar(
        row["base"],
        np.frombuffer(row["left"], kind),
        np.frombuffer(row["right"], kind),
        np.frombuffer(row["length"], "<u4").astype(np.int64),
        np.frombuffer(row["symbols"], kind),
        np.array(row["ends"], dtype=np.int64),
    )


def _decoded(key: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                row = {name: one.column(i)[0].as_py() for i, name in enumerate(one.schema.names) if name != "keys"}
                ids, ends = grammar.decode(_grammar(row))
                raw = ids.astype("<u4").tobytes()
                begins = np.concatenate([[0], ends[:-1]])
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]
                place = np.arange(len(ends))
                columns = {
                    key: one.column(one.schema.get_field_index("keys")).flatten(),
                    "part": pa.array(np.full(len(ends), row["part"]), pa.int32()),
                    "shard": pa.array(np.full(len(ends), row["shard"]), pa.int32()),
                    "place": pa.array(place, pa.int32()),
                    "before": pa.array(begins, pa.int64()),
                    "n_tokens": pa.array(ends - begins, pa.int64()),
                    "ids_crc32": pa.array(crc, pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.ListArray.from_arrays(
                        pa.array(np.append(begins, len(ids)), pa.int32()), pa.array(ids.astype(np.int32), pa.int32())
                    )
                yield pa.RecordBatch.from_pydict(columns)

    return run


def read_tokens(spark: SparkSession, path: str, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Documents of the token files at ``path``: key, ``start`` (ids of all documents before), ``n_tokens``, ``ids_crc32``.

    ``part``, ``shard`` and ``place`` say where a document lies; ``with_ids`` adds the ids themselves.
    """
    shards = spark.read.parquet(path)
    kind = dict(shards.dtypes)["keys"].removeprefix("array<").removesuffix(">")
    schema = f"`{key}` {kind}, part int, shard int, place int, before long, n_tokens long, ids_crc32 long"
    docs = shards.mapInArrow(_decoded(key, with_ids), schema + ", ids array<int>" * with_ids)
    per_shard = shards.select("part", "shard", F.col("n_tokens").alias("n"))
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    per_part = per_shard.groupBy("part").agg(F.sum("n").alias("n")).select("part", F.sum("n").over(ahead).alias("a"))
    base = per_shard.select("part", "shard", F.sum("n").over(within).alias("b")).join(per_part, "part")
    base = base.select("part", "shard", (F.coalesce("a", F.lit(0)) + F.coalesce("b", F.lit(0))).alias("base"))
    out = docs.join(base, ["part", "shard"]).withColumn("start", F.col("base") + F.col("before"))
    return out.select(key, "start", "n_tokens", "ids_crc32", "part", "shard", "place", *["ids"] * with_ids)


def read_document(spark: SparkSession, path: str, key: object, first: int = 0, end: int | None = None) -> list[list[int]]:
    """Ids ``first`` to ``end`` of the documents with this key, one list for each (repeated rows have several).

    A scan of the keys alone finds the shards. Of these, only the symbols that hold the ids asked for are expanded, found by
    the stored lengths of the rules.
    """
    holds = F.exists("keys", lambda k: k.eqNullSafe(F.lit(key)))
    out = []
    for found in spark.read.parquet(path).where(holds).select("part", "shard").orderBy("part", "shard").toLocalIterator():
        row = spark.read.parquet(path).where((F.col("part") == found.part) & (F.col("shard") == found.shard)).first().asDict()
        made = _grammar(row)
        out += [grammar.decode_range(made, i, first, end).tolist() for i, k in enumerate(row["keys"]) if k == key]
    return out
