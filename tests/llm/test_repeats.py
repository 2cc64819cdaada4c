"""Repeated strings, collocations and token alignment against plain Python."""

import hashlib
import random
from collections import Counter, defaultdict

import compare
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from test_operators import ODD

from tablespoon.llm import collocations, queries, suffix_dedup, token_align
from tablespoon.llm.words import hash_spans, text_bytes
from tablespoon.session import LARGE_ROWS, stored

SF = "/root/testdata/sf0.001"
PATHS = tuple(map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model")))


def documents(spark, rows, columns="doc_id long, text string"):
    return spark.createDataFrame(rows, columns).repartition(5)


# --- repeated strings ----------------------------------------------------------------------------------------------


def plain_removal(rows, length):
    """By document id; rows that share an id are equal here."""
    first = {}
    for doc, text in sorted(set(rows), key=lambda r: -1 if r[0] is None else r[0]):
        raw = (text or "").encode()
        for i in range(len(raw) - length + 1):
            first.setdefault(raw[i : i + length], (-1 if doc is None else doc, i))
    out = {}
    for doc, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, dtype=bool)
        for i in range(len(raw) - length + 1):
            if first[raw[i : i + length]] < (-1 if doc is None else doc, i):
                gone[i : i + length] = True
        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out[doc] = (len(raw), int(gone.sum()), runs, bytes(b for b, g in zip(raw, gone) if not g))
    return out


def repeating_texts(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(30)]
    passages = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(4)]
    rows = []
    for doc in range(50):
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(60)))
        if rng.random() < 0.5:
            cut = rng.randrange(len(text) + 1)
            text = text[:cut] + rng.choice(passages) + text
        rows.append((doc, text))
    rows += [(100, rows[3][1]), (101, rows[5][1] + "x"), (104, "é" * 80), (105, "é" * 80 + "字" * 60), (106, "a" * 5000), (107, "ab" * 300)]
    return rows + [(200, None), (201, ""), (100, rows[3][1]), (None, rows[7][1])]


@pytest.mark.parametrize(
    ("length", "options"),
    [(100, {}), (11, dict(largest=3, merge_bytes=2000, shard_bytes=300, bits=10)), (10, dict(largest=50, merge_bytes=500, shard_bytes=100, bits=12))],
)
def test_removed_bytes_equal_plain_strings(spark, length, options):
    rows = repeating_texts(length)
    found = suffix_dedup.remove_repeats(documents(spark, rows), length=length, **options).collect()
    wanted = plain_removal(rows, length)
    assert len(found) == len(rows)
    for r in found:
        assert (r.n_bytes, r.n_removed, len(r.removed), bytes(r.kept_bytes)) == wanted[r.doc_id]


def test_repeats_keep_columns_and_empty_tables(spark):
    docs = documents(spark, [(1, "x" * 30, "mine", 5), (2, "x" * 30, "yours", 6)], "doc_id long, text string, n_removed string, extra int")
    found = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs, length=10).collect()}
    assert (found[1].extra, found[1].n_removed, found[2].n_removed) == (5, 20 + 9, 30)
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_long_rows_are_scanned_in_parts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SLICE", 97)
    rng = random.Random(4)
    text = "".join(rng.choice("abcd") for _ in range(900))
    batch = pa.RecordBatch.from_pydict({"t": pa.array([text + text[100:400]])})
    seen = Counter()
    for _, data, bounds, _ in suffix_dedup._pieces(iter([batch]), "t", 20):
        for h, n in zip(*(x.tolist() for x in suffix_dedup.anchors(data, bounds, 20)[::3])):
            seen[h] += n
    assert sum(seen.values()) == len(text) + 300 - 19


def test_merged_transforms_sort_suffixes():
    rng = random.Random(9)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(4, 40))).encode() for _ in range(60)]
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    bounds = np.cumsum([0, *map(len, texts)])
    starts = np.maximum(np.diff(bounds) - 7, 0)
    found = defaultdict(set)
    for interval, text, place in zip(*(x.tolist() for x in suffix_dedup.repeats(data, bounds, starts, 8, 200))):
        found[interval].add((text, place))
    wanted = defaultdict(set)
    for i, t in enumerate(texts):
        for j in range(len(t) - 7):
            wanted[t[j : j + 8]].add((i, j))
    assert sorted(map(sorted, found.values())) == sorted(sorted(v) for v in wanted.values() if len(v) > 1)


def test_only_shards_of_one_anchor_are_merged(monkeypatch):
    rng = random.Random(5)
    rows = []
    for h in range(40):
        lines = ["".join(rng.choice("ab") for _ in range(6)) for _ in range(30 if h == 7 else 2)]
        rows += [(h, c, 100 * h + c, 0, 5, 3, 1, f"{x[:2]}{h:02}{x[2:]}".encode()) for c, x in enumerate(lines)]
    batch = pa.RecordBatch.from_pydict(dict(zip("h c doc t p n o body".split(), zip(*rows))))
    batch = batch.set_column(7, "body", batch.column("body").cast(pa.binary()))
    merged, seen = suffix_dedup.merged, []
    monkeypatch.setattr(suffix_dedup, "merged", lambda shards, rounds: seen.append(len(shards)) or merged(shards, rounds))
    spans = pa.Table.from_batches(suffix_dedup._merge(6, 1 << 20, 100)(iter([batch])))
    assert seen == [3]  # only the anchor that is larger than a shard
    first, gone = {}, set()
    for _, _, doc, _, p, n, _, body in rows:
        for i in range(n):
            if first.setdefault(body[i : i + 6], doc) != doc:
                gone |= {(doc, x) for x in range(p + i, p + i + 6)}
    assert gone == {(r["doc"], x) for r in spans.to_pylist() for x in range(r["a"], r["b"])}


@pytest.mark.parametrize(("n", "rounds"), [(1, 5), (40, 1), (3000, 7), (3000, 50)])
def test_suffixes_are_ordered_to_the_depth(n, rounds):
    rng = np.random.default_rng(n + rounds)
    data = np.concatenate([np.tile(rng.integers(97, 99, n), 3), rng.integers(97, 99, n)]).astype(np.uint8)
    bounds = np.array([0, 2 * n, 2 * n, 4 * n])
    symbol, before, begin = suffix_dedup._symbols(data, bounds)
    order, parted = suffix_dedup.ordered(symbol, before, rounds)
    assert sorted(order.tolist()) == list(range(len(before)))
    after = np.empty_like(before)
    after[before] = np.arange(len(before))
    keys, at = [symbol], after
    for _ in range(rounds - 1):
        keys, at = [*keys, symbol[at]], after[at]
    keys = np.stack(keys, axis=1)[order].tolist()
    assert keys == sorted(keys)
    assert parted.tolist() == [True, *(a != b for a, b in zip(keys, keys[1:]))]


def test_hashes_of_spans_by_prefix_sums():
    rng = np.random.default_rng(8)
    data = rng.integers(0, 256, 100_000).astype(np.uint8)
    starts = np.sort(rng.integers(0, 99_000, 500))
    lengths = np.arange(1, 501)
    assert np.array_equal(suffix_dedup.span_hashes(suffix_dedup.prefix_sums(data), starts, lengths), hash_spans(data, starts, lengths))


# --- collocations --------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("heads", [1 << 19, 40])
def test_phrases_equal_the_statement_with_few_ranks(spark, heads):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = collocations.collocations(docs, heads=heads, bits=10)
    assert compare.differences(found, compare.connect(SF), queries.ORACLE["op12_collocations"]) == []


def test_phrases_of_odd_rows(spark, monkeypatch):
    rows = [(t, None) for t in ODD] + [("a b. a b\tA b c", "x")] * 20 + [("b c, " * 40, "x"), ("a b", None)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    found = collocations.collocations(docs, least=30, cover=101).collect()
    assert [(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n) for r in found if r.lang == "x"] == [
        ("x", 1, "a b", 60, 60, 100, 220), ("x", 2, "b c", 60, 100, 60, 220)
    ]
    assert [r for r in found if r.lang == "und"] == []
    assert collocations.collocations(docs.limit(0)).count() == 0


def test_dense_tiles_and_lists_count_alike(monkeypatch):
    ranks = collocations.Ranks(np.arange(5000, dtype=np.uint64) * np.uint64(7919), np.zeros(5000, dtype=np.uint64))
    rng = np.random.default_rng(1)
    row, column = (rng.zipf(1.3, 200_000) % 5000 for _ in "ab")
    counts = []
    for dense in (1, 1 << 30):
        monkeypatch.setattr(collocations, "DENSE", dense)
        tiles, seen = collocations.Tiles(ranks, ranks), Counter()
        for part in np.array_split(np.arange(len(row)), 3):
            tiles.add(row[part], column[part])
        for batch in tiles.flush():
            for key, n in zip(batch.column(0).to_pylist(), batch.column(4).to_pylist()):
                seen[key] += n
        counts.append(seen)
    assert counts[0] == counts[1] == Counter(((row << 32) | column).tolist())


# --- token alignment -----------------------------------------------------------------------------------------------


def plain_alignment(texts):
    tokens = token_align.Tokenizers(*PATHS)
    letters, names = token_align._byte_letters(), {i: w for w, i in tokens.a.get_vocab().items()}
    rows, links = [], []
    for t in texts:
        a = tokens.a.encode(f" {t}", add_special_tokens=False).ids if t else []
        b = tokens.b.encode(t) if t else []
        bytes_a = [bytes(letters[c] for c in names[i]) for i in a]
        pieces = [tokens.b.id_to_piece(i) for i in b]
        bytes_b = [bytes([int(p[1:-1], 16)]) if tokens.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
        if not t or not b"".join(bytes_a) == b"".join(bytes_b) == f" {t}".encode():
            rows.append(None)
            links.append([])
            continue
        ends = [np.cumsum([len(x) for x in side]).tolist() for side in (bytes_a, bytes_b)]
        begins = [[0, *e[:-1]] for e in ends]
        groups, at = [], [0, 0]
        for end in sorted(set(ends[0]) & set(ends[1])):
            group = []
            for k, ids in enumerate((a, b)):
                stop = ends[k].index(end) + 1
                group.append(",".join(map(str, ids[at[k] : stop])))
                at[k] = stop
            groups.append("|".join(group))
        own, low = [], 0
        for p in range(len(a)):
            while ends[1][low] <= begins[0][p]:
                low += 1
            q = low
            while q < len(b) and begins[1][q] < ends[0][p]:
                own.append((a[p], b[q]))
                q += 1
        rows.append((len(a), len(b), len(groups), ";".join(groups)))
        links.append(own)
    count = Counter(x for own in links for x in own)
    most = defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return [
        (0, 0, 0, 0, 0, 0, "")
        if r is None
        else (*r[:3], len(own), sum(count[x] == most[x[1]] for x in own), sum(count[x] for x in own), hashlib.sha256(r[3].encode()).hexdigest())
        for r, own in zip(rows, links)
    ]


def odd_texts(seed, n=120):
    rng = random.Random(seed)
    parts = [*"abcé字 \t\n   '́x12.,<|🙂ﬁ　\x00", " the", " Wor", "ld ", "  ", "<|endoftext|>", "<s>", "<0x41>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(300))) for _ in range(n)]
    return [*texts, *texts[:9], *ODD, " " * 300, "a▁b"]


@pytest.mark.parametrize("chunk", [1 << 15, 61, 7])
def test_alignment_equals_plain_links_in_any_ranges(spark, chunk):
    texts = odd_texts(chunk)
    docs = documents(spark, list(enumerate(texts)))
    found = {r.doc_id: tuple(r)[1:] for r in token_align.align_tokens(docs, *PATHS, chunk=chunk).collect()}
    wanted = plain_alignment(texts)
    assert [found[i] for i in range(len(texts))] == wanted


def test_alignment_of_empty_and_null(spark):
    docs = documents(spark, [(None, "a b", "x"), (3, None, "y")], "doc_id long, text string, pairs string")
    found = sorted(token_align.align_tokens(docs, *PATHS).collect(), key=str)
    assert [(r.doc_id, r.n_a > 0) for r in found] == [(3, False), (None, True)]
    assert token_align.align_tokens(docs.limit(0), *PATHS).count() == 0


def test_alignment_of_rows_without_pairs_and_of_text_keys(spark):
    docs = documents(spark, [("x", None), ("y", "")], "doc_id string, text string")
    found = token_align.align_tokens(docs, *PATHS)
    assert sorted(map(tuple, found.collect())) == [(k, 0, 0, 0, 0, 0, 0, "") for k in "xy"]


def test_scoring_takes_a_block_at_a_time(spark):
    """Neither a batch of blocks nor the pairs of several blocks are held at once; both were, and grew with a task's blocks."""
    found = token_align.align_tokens(documents(spark, [(1, "a b c")]), *PATHS)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "collect_list" not in plan


def test_large_rows_are_stored_in_small_row_groups(spark):
    rows = spark.range(0, 40, 1, 1).select("id", F.expr("repeat(uuid(), 30000)").alias("body"))  # a megabyte each
    path = stored(rows, "test", LARGE_ROWS).inputFiles()[0].removeprefix("file:")
    meta = pq.ParquetFile(path).metadata
    assert meta.num_rows == 40 and max(meta.row_group(k).num_rows for k in range(meta.num_row_groups)) == 16


def test_composition_is_associative():
    tokens, rng = token_align.Tokenizers(*PATHS), random.Random(2)
    for text in odd_texts(11, 60):
        data = np.frombuffer(f" {(text or '')[:2000]}".encode(), dtype=np.uint8)
        cuts = sorted(rng.sample(range(1, len(data)), min(len(data) - 1, 5))) if len(data) > 2 else []
        parts = [token_align._fragment(tokens, data, 0, a, b) for a, b in zip([0, *cuts], [*cuts, len(data)])]
        whole = token_align.closed(token_align._fragment(tokens, data, 0, 0, len(data)))
        left, right = token_align.Fragment(), token_align.Fragment()
        for one in parts:
            left = left + one
        for one in reversed(parts):
            right = one + right
        for f in map(token_align.closed, (left, right)):
            assert (f.groups, f.sums.tolist(), f.pairs.tolist(), f.times.tolist()) == (
                whole.groups, whole.sums.tolist(), whole.pairs.tolist(), whole.times.tolist(),
            )


def test_pieces_give_the_ids_of_whole_texts():
    tokens = token_align.Tokenizers(*PATHS)
    assert tokens.by_piece
    texts = [t for t in odd_texts(5) if t]
    data, bounds = token_align._spaced(*text_bytes(pa.array(texts, pa.string())))
    a, b, good = tokens.encode(data, bounds)
    for i, t in enumerate(texts):
        if good[i]:
            assert a[0][a[3] == i].tolist() == tokens.a.encode(f" {t}", add_special_tokens=False).ids
            assert b[0][b[3] == i].tolist() == tokens.b.encode(t)
