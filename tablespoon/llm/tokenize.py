"""Ids of whole texts by a vocabulary file of the ``tokenizers`` library.

A vocabulary that lower-cases, drops white space and ends words by ``</w>`` encodes each word by itself, so a text can be
cut at white space, and before a mark like ``.`` that follows a letter, without changing an id. Then each distinct piece
is encoded once per worker and kept. Any other vocabulary encodes whole texts.
"""

from __future__ import annotations

import json
import os

import numpy as np

from tablespoon.llm.grammar import spread
from tablespoon.llm.words import NON_SPACE, hash_spans, lower_ascii

#: Fixed value: the split pattern of the vocabularies that encode word by word.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
KEPT_PIECES = 1_500_000  # when a worker knows so many pieces it starts anew
_PER_CALL = 1024
_CELL = np.uint64(64 - 20)

_MARK = np.zeros(256, dtype=bool)
_MARK[list(b".,;:!?")] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[list(b"0123456789")] = True
_SECOND = np.zeros(256, dtype=bool)  # second bytes of the letters U+00C0 to U+00FF
_SECOND[0x80:0xC0] = True
_SECOND[[0x97, 0xB7]] = False


def _encodes_words(spec: dict) -> bool:
    split = [x for x in (spec.get("pre_tokenizer") or {}).get("pretokenizers", []) if x["type"] == "Split"]
    return (
        spec["model"].get("end_of_word_suffix") == "</w>"
        and {x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])} == {"NFC", "Replace", "Lowercase"}
        and [(x["pattern"].get("Regex"), x["behavior"], x["invert"]) for x in split] == [(WORD_PATTERN, "Removed", True)]
        and not any(x["lstrip"] or x["rstrip"] or x["single_word"] for x in spec["added_tokens"])
        and not any(c in x["content"] for x in spec["added_tokens"] for c in ".,;:!? \t\n")
    )


class TextEncoder:
    """Encodes blocks of text; made once per worker."""

    def __init__(self, vocabulary: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        with open(vocabulary) as spec:
            self.by_word = _encodes_words(json.load(spec))
        words = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(words.values()) + 1
        self.ends_word = np.zeros(self.size, dtype=bool)
        self.ends_word[[i for word, i in words.items() if word.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.hashes = np.zeros(0, dtype=np.uint64)
        self.begin = np.zeros(0, dtype=np.int64)
        self.count = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)
        # the piece met last in each cell of the hash range, found without a search
        cells = 1 << (64 - int(_CELL))
        self.cell_hash = np.zeros(cells, dtype=np.uint64)
        self.cell_begin = np.zeros(cells, dtype=np.int32)
        self.cell_count = np.zeros(cells, dtype=np.int32)

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows and the running end of each row."""
        if not self.by_word:
            raw = data.tobytes()
            texts = [raw[a:b].decode() for a, b in zip(bounds[:-1], bounds[1:])]
            found = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            ids = np.concatenate([np.zeros(0, dtype=np.uint32), *(np.array(x, dtype=np.uint32) for x in found)])
            return ids, np.cumsum([len(x) for x in found])
        data, starts, lengths, plain = self._pieces(data, bounds)
        hashes = hash_spans(data, starts, lengths)
        if len(self.hashes) > KEPT_PIECES:
            self._forget()
        cell = (hashes >> _CELL).astype(np.int64)
        begin, count = self.cell_begin[cell], self.cell_count[cell]
        missed = np.flatnonzero(self.cell_hash[cell] != hashes)
        if len(missed):
            distinct, first = np.unique(hashes[missed], return_index=True)
            slot = np.searchsorted(self.hashes, distinct)
            known = slot < len(self.hashes)
            known[known] = self.hashes[slot[known]] == distinct[known]
            new = missed[first[~known]]
            if len(new):
                self._learn(distinct[~known], data, starts[new], lengths[new], plain[new])
            slot = np.searchsorted(self.hashes, hashes[missed])
            begin[missed], count[missed] = self.begin[slot], self.count[slot]
            self.cell_hash[cell[missed]] = hashes[missed]
            self.cell_begin[cell[missed]], self.cell_count[cell[missed]] = begin[missed], count[missed]
        total = np.concatenate([[0], np.cumsum(count)])
        return self.ids[spread(begin, count)], total[np.searchsorted(starts, bounds[1:])]

    def _pieces(self, data: np.ndarray, bounds: np.ndarray):
        """Bytes (lower-cased where that is safe), first byte and length of each piece, and whether it is letters only."""
        if not len(data):
            none = np.zeros(0, dtype=np.int64)
            return data, none, none, none.astype(bool)
        inside = NON_SPACE[data]
        latin = np.zeros(len(data), dtype=bool)  # second byte of a letter U+00C0 to U+00FF
        latin[1:] = (data[:-1] == 0xC3) & _SECOND[data[1:]]
        letter = _LETTER[data] | latin
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        begins[1:] |= _MARK[data[1:]] & (letter | _DIGIT[data])[:-1]
        edge = bounds[1:-1][(bounds[1:-1] > 0) & (bounds[1:-1] < len(data))]
        begins[edge] |= inside[edge]
        starts = np.flatnonzero(begins)
        ends[:-1] &= ~inside[1:] | begins[1:]
        ends[edge - 1] |= inside[edge - 1]
        lengths = np.flatnonzero(ends) + 1 - starts
        letter[:-1] |= latin[1:]  # with its first byte
        others = np.concatenate([[0], np.cumsum(~letter)])
        plain = others[starts + lengths] == others[starts]
        odd = ((data >= 0x80) & ~letter) | (data == ord("|"))
        lowered = lower_ascii(data)
        if odd.any():
            strange = np.concatenate([[0], np.cumsum(odd)])
            keep = np.flatnonzero(strange[starts + lengths] > strange[starts])
            where = spread(starts[keep], lengths[keep])
            lowered[where] = data[where]
        return lowered, starts, lengths, plain

    def _learn(self, hashes, data, starts, lengths, plain) -> None:
        raw = data.tobytes()
        texts = [raw[a : a + n].decode() for a, n in zip(starts.tolist(), lengths.tolist())]
        ids: list[np.ndarray] = []
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        count = np.zeros(len(texts), dtype=np.int64)
        letters = order[: int(plain.sum())]
        for at in range(0, len(letters), _PER_CALL):  # words of letters have one end of word each
            some = letters[at : at + _PER_CALL]
            found = self.tokenizer.encode(" ".join([texts[i] for i in some.tolist()]), add_special_tokens=False).ids
            found = np.array(found, dtype=np.uint32)
            last = np.flatnonzero(self.ends_word[found]) + 1
            count[some] = np.diff(last, prepend=0)
            ids.append(found)
        for at in range(len(letters), len(order), _PER_CALL):
            some = order[at : at + _PER_CALL]
            found = self.tokenizer.encode_batch_fast([texts[i] for i in some.tolist()], add_special_tokens=False)
            for i, x in zip(some.tolist(), found):
                count[i] = len(x.ids)
                ids.append(np.array(x.ids, dtype=np.uint32))
        begin = np.zeros(len(texts), dtype=np.int64)
        begin[order] = len(self.ids) + np.cumsum(count[order]) - count[order]
        at = np.searchsorted(self.hashes, hashes)
        self.ids = np.concatenate([self.ids, *ids])
        self.hashes = np.insert(self.hashes, at, hashes)
        self.begin = np.insert(self.begin, at, begin)
        self.count = np.insert(self.count, at, count)
