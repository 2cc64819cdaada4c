"""Re-Pair grammar compression of id sequences in numpy.

The most frequent pairs of neighbours are replaced by new symbols, again and again, until no pair is frequent or a round gains little. A symbol
is an id or, from ``base`` on, a rule of two earlier symbols. No rule crosses the end of a document, so any document is
decoded from its own symbols; the stored lengths of the rules say which symbol holds a given token.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

MIN_COUNT = 24  # a pair must occur so often in a shard to become a rule
LEAST_GAIN = 0.01  # a round that shortens the shard by less than this part is the last
PER_ROUND = 2048  # rules made from one count of all pairs
_SLOTS = 16  # bits of the table that finds a chosen pair


@dataclass
class Grammar:
    base: int
    left: np.ndarray
    right: np.ndarray
    length: np.ndarray  # ids that each rule stands for
    symbols: np.ndarray
    ends: np.ndarray  # symbols of each document, as running total


def spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All numbers of the ranges that begin at ``first``, one after the other."""
    return np.arange(int(size.sum())) + np.repeat(first - (np.cumsum(size) - size), size)


def compress(ids: np.ndarray, ends: np.ndarray, base: int, min_count: int = MIN_COUNT, per_round: int = PER_ROUND) -> Grammar:
    """Grammar of the documents that end (exclusive) at ``ends``; ``base`` is above every id.

    Symbols take 16 bits where the ids do: rules then use up what is left of them, at most.
    """
    narrow = base < 1 << 16
    kind, wide = (np.uint16, np.uint32) if narrow else (np.uint32, np.uint64)
    shift = wide(16 if narrow else 32)
    room = (1 << (16 if narrow else 32)) - base
    seq = ids.astype(kind)
    last = np.zeros(len(seq), dtype=bool)
    last[np.asarray(ends)[np.asarray(ends) > 0] - 1] = True
    left, right = [np.zeros(0, dtype=kind)], [np.zeros(0, dtype=kind)]
    made = 0
    slots = np.uint64(64 - _SLOTS)
    while made < room and len(seq) > 1:
        code = (seq[:-1].astype(wide) << shift) | seq[1:]
        inner = ~last[:-1]
        ordered = np.sort(code[inner])
        heads = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, int)
        count = np.diff(np.append(heads, len(ordered)))
        often = np.flatnonzero(count >= min_count)
        if not len(often):
            break
        often = often[np.argsort(-count[often], kind="stable")][: min(per_round, room - made)]
        pairs = ordered[heads[often]]
        # a pair whose slot a more frequent one holds waits for the next round
        slot = (pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> slots
        _, first = np.unique(slot, return_index=True)
        pairs, slot = pairs[np.sort(first)], slot[np.sort(first)]
        table = np.full(1 << _SLOTS, pairs[0], dtype=wide)
        number = np.zeros(1 << _SLOTS, dtype=kind)
        table[slot], number[slot] = pairs, np.arange(base + made, base + made + len(pairs)).astype(kind)
        number[table == pairs[0]] = base + made
        at = (code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> slots
        found = np.flatnonzero((table[at] == code) & inner)
        # of overlapping pairs every second one, from the left
        runs = np.flatnonzero(np.concatenate([[True], np.diff(found) > 1]))
        place = np.arange(len(found)) - np.repeat(runs, np.diff(np.append(runs, len(found))))
        found = found[place % 2 == 0]
        seq[found] = number[at[found]]
        last[found] = last[found + 1]
        stay = np.ones(len(seq), dtype=bool)
        stay[found + 1] = False
        seq, last = seq[stay], last[stay]
        left.append((pairs >> shift).astype(kind))
        right.append((pairs & wide((1 << int(shift)) - 1)).astype(kind))
        made += len(pairs)
        if len(found) < LEAST_GAIN * (len(seq) + len(found)):
            break
    grammar = Grammar(base, np.concatenate(left), np.concatenate(right), np.zeros(0), seq, _doc_ends(last, ends))
    grammar.length = rule_lengths(grammar)
    return grammar


def _doc_ends(last: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Symbols up to the end of each document; an empty document ends where the one before does."""
    where = np.flatnonzero(last) + 1
    before = np.concatenate([[0], np.asarray(ends)[:-1]])
    full = np.asarray(ends) > before
    return np.concatenate([[0], where])[np.cumsum(full)]


def rule_lengths(grammar: Grammar) -> np.ndarray:
    out = np.zeros(len(grammar.left), dtype=np.int64)
    todo = np.arange(len(out))
    left, right = grammar.left.astype(np.int64) - grammar.base, grammar.right.astype(np.int64) - grammar.base
    while len(todo):
        a = np.where(left[todo] < 0, 1, out[left[todo].clip(0)])
        b = np.where(right[todo] < 0, 1, out[right[todo].clip(0)])
        ready = (a > 0) & (b > 0)
        out[todo[ready]] = (a + b)[ready]
        todo = todo[~ready]
    return out


def expansions(grammar: Grammar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, begin, length) by symbol: symbol ``s`` stands for ``ids[begin[s]:begin[s] + length[s]]``."""
    length = np.concatenate([np.ones(grammar.base, dtype=np.int64), grammar.length])
    begin = np.cumsum(length) - length
    ids = np.zeros(int(length.sum()), dtype=np.uint32)
    ids[: grammar.base] = np.arange(grammar.base)
    order = np.argsort(grammar.length, kind="stable")  # parts are shorter than the whole
    heads = np.flatnonzero(np.concatenate([[True], np.diff(grammar.length[order]) > 0])) if len(order) else []
    for some in np.split(order, heads[1:]) if len(order) else []:
        rule, a, b = some + grammar.base, grammar.left[some], grammar.right[some]
        ids[spread(begin[rule], length[a])] = ids[spread(begin[a], length[a])]
        ids[spread(begin[rule] + length[a], length[b])] = ids[spread(begin[b], length[b])]
    return ids, begin, length


def decode(grammar: Grammar, first: int = 0, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the documents ``first`` to ``end`` and their running ends; reads only the symbols of these."""
    ids, begin, length = expansions(grammar)
    ends = grammar.ends[first:end]
    at = int(grammar.ends[first - 1]) if first else 0
    some = grammar.symbols[at : int(ends[-1]) if len(ends) else at]
    total = np.concatenate([[0], np.cumsum(length[some])])
    return ids[spread(begin[some], length[some])], total[ends - at]


def decode_range(grammar: Grammar, document: int, first: int = 0, end: int | None = None) -> np.ndarray:
    """Ids ``first`` to ``end`` (exclusive) of one document.

    The lengths say which symbols hold these ids; only they are replaced by their parts, level by level, and parts outside
    the range are passed over. So the work depends on the ids asked for and the depth of their rules alone.
    """
    at = int(grammar.ends[document - 1]) if document else 0
    symbol = grammar.symbols[at : int(grammar.ends[document])].astype(np.int64)
    size = np.ones(len(symbol), dtype=np.int64)
    rule = symbol >= grammar.base
    size[rule] = grammar.length[symbol[rule] - grammar.base]
    begin = np.cumsum(size) - size
    end = int(size.sum()) if end is None else end
    while True:
        some = (begin < end) & (begin + size > first)
        symbol, begin, size = symbol[some], begin[some], size[some]
        rule = symbol >= grammar.base
        if not rule.any():
            return symbol.astype(np.uint32)
        parts = np.repeat(np.arange(len(symbol)), 1 + rule)
        second = np.concatenate([[False], parts[1:] == parts[:-1]])
        number = symbol[parts] - grammar.base
        part = np.where(second, grammar.right[number.clip(0)], grammar.left[number.clip(0)]) if len(grammar.left) else symbol[parts]
        symbol = np.where(rule[parts], part, symbol[parts]).astype(np.int64)
        size = np.ones(len(symbol), dtype=np.int64)
        deep = symbol >= grammar.base
        size[deep] = grammar.length[symbol[deep] - grammar.base]
        begin = begin[parts]
        begin[second] += size[np.flatnonzero(second) - 1]
