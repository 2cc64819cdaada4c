"""Byte-level helpers against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tablespoon.llm import decontaminate, grammar, near_dup
from tablespoon.llm import words as W

TEXT = st.text(alphabet="aAbz09 \t\n\x0b.,éßЖ\u2028字-", max_size=60)


def rows(texts):
    return W.text_bytes(pa.array(texts, type=pa.string()))


@given(st.lists(st.one_of(TEXT, st.none()), max_size=8))
@settings(max_examples=60, deadline=None)
def test_words_are_those_of_the_patterns(texts):
    data, bounds = rows(texts)
    for table, pattern in ((W.NON_SPACE, r"[^\x20\x09-\x0D]+"), (W.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        found = W.hashed_words(data, bounds, table)
        names = {}
        for i, text in enumerate(texts):
            low = (text or "").translate({k: k + 32 for k in range(65, 91)})
            expected = re.findall(pattern, low)
            hashes = found.hashes[found.rows[i] : found.rows[i + 1]].tolist()
            assert len(hashes) == len(expected)
            for word, value in zip(expected, hashes):
                assert names.setdefault(word, value) == value
        assert len(set(names.values())) == len(names)


def test_a_word_longer_than_a_slice_has_one_hash():
    long = "x" * (W.SLICE_BYTES * 2 + 17)
    data, bounds = rows([long, f"a {long} b", long + "y"])
    found = W.hashed_words(data, bounds, W.NON_SPACE)
    first, _, second, _, other = found.hashes.tolist()
    assert first == second != other


def test_blocks_hold_whole_rows():
    batch = pa.RecordBatch.from_pydict({"t": pa.array(["a" * 10, None, "", "b" * 50, "c"])})
    found = list(W.blocks(iter([batch]), "t", block_bytes=12))
    assert [b.rows.num_rows for b in found] == [3, 1, 1]
    assert b"".join(b.data.tobytes() for b in found) == b"a" * 10 + b"b" * 50 + b"c"
    assert list(W.blocks(iter([batch.slice(0, 0)]), "t")) == []


@given(st.lists(st.integers(0, 3), max_size=60), st.integers(1, 9))
@settings(max_examples=60, deadline=None)
def test_suffix_array_sorts_by_the_words_that_follow(words, depth):
    text = np.array([*words, 0], dtype=np.int64)
    found = decontaminate.suffix_array(text, depth).tolist()

    def suffix(i):
        out = []
        while text[i] and len(out) < depth:
            out.append(int(text[i]))
            i += 1
        return out

    assert sorted(found) == np.flatnonzero(text).tolist()
    keys = [suffix(i) for i in found]
    assert keys == sorted(keys)


@given(st.lists(st.lists(st.integers(0, 5), max_size=40), min_size=1, max_size=6))
@settings(max_examples=60, deadline=None)
def test_grammar_round_trip_and_random_access(docs):
    ids = np.array([x for d in docs for x in d], dtype=np.uint32)
    ends = np.cumsum([len(d) for d in docs])
    made = grammar.compress(ids, ends, 6, min_count=2)
    back, back_ends = grammar.decode(made)
    assert back.tolist() == ids.tolist() and back_ends.tolist() == ends.tolist()
    for i, d in enumerate(docs):
        one, one_ends = grammar.decode(made, i, i + 1)
        assert one.tolist() == d and one_ends.tolist() == [len(d)]


def test_grammar_shortens_repeats_and_knows_lengths():
    ids = np.tile(np.array([7, 8, 9, 7], dtype=np.uint32), 500)
    made = grammar.compress(ids, np.array([len(ids)]), 49_409)
    assert len(made.symbols) < len(ids) // 8
    length = np.concatenate([np.ones(made.base, dtype=np.int64), made.length])
    assert int(length[made.symbols].sum()) == len(ids)


def test_wide_symbols():
    ids = np.tile(np.array([70_000, 70_001], dtype=np.uint32), 200)
    made = grammar.compress(ids, np.array([300, 400]), 70_002)
    assert made.symbols.dtype == np.uint32 and grammar.decode(made)[0].tolist() == ids.tolist()


def test_sketches_fill_and_agree_as_often_as_the_sets_are_similar():
    rng = np.random.default_rng(5)
    shared, a, b = (W.mix64(rng.integers(1, 2**62, n, dtype=np.uint64)) for n in (800, 100, 100))
    one, two = near_dup.sketch(np.concatenate([shared, a]), 270), near_dup.sketch(np.concatenate([shared, b]), 270)
    assert abs((one == two).mean() - 0.8) < 0.12
    for n in (1, 2, 5, 40):
        small = near_dup.sketch(shared[:n], 270)
        assert small.max() < np.iinfo(np.uint64).max
        assert (small == near_dup.sketch(shared[:n][::-1].copy(), 270)).all()
