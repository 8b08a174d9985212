"""Token ids of whole Arrow text columns with a public byte-level BPE vocabulary.

The tokenizers library encodes; this module only keeps it from encoding the
same piece twice. Byte-level BPE never merges across the pieces of its
pre-tokenizer, so a text's ids are the concatenated ids of its pieces. A
batch is cut into pieces with numpy, Arrow's dictionary encoding finds the
distinct ones, the library encodes those not met before in this worker (kept
by 64-bit hash), and the ids are gathered. Texts outside the range where the cut is known to agree
with the library (see ``_plain``) are encoded whole by the library.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from riskbook.llm.text_arrays import IS_SPACE, buffers, row_of, runs_within, span_hashes

# The piece cache is emptied at this many pieces; that bounds memory and changes no result.
CACHE_PIECES = 1_500_000
LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 4
#: Texts with code points from here on go to the library whole.
PLAIN_LIMIT = 0x3000
#: Endings that the pre-tokenizer splits off after an apostrophe, longest match by its order.
ENDINGS = (b"'s", b"'t", b"'re", b"'ve", b"'m", b"'ll", b"'d")


def _class(cp: int) -> int:
    kind = unicodedata.category(chr(cp))[0]
    if kind in "LN":
        return LETTER if kind == "L" else NUMBER
    return SPACE if chr(cp).isspace() and not 0x1C <= cp <= 0x1F else OTHER


class Encoder:
    """One per worker and vocabulary file; see :func:`encoder`."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocab_size = self.tokenizer.get_vocab_size()
        self.classes = np.array([_class(c) for c in range(PLAIN_LIMIT)], dtype=np.uint8)
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.line_break = self.tokenizer.encode("\n", add_special_tokens=False).ids[0]
        self._forget()

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=np.uint32) for e in found]

    def _forget(self) -> None:
        self.keys, self.flat = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        self.first = self.length = np.zeros(0, np.int64)

    def _pieces(self, text: str, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of n pieces and the number of each, encoded as one text with a line
        break after each piece: the pre-tokenizer cuts it there, and only there."""
        ids = np.array(self._whole([text])[0], dtype=np.uint32)
        ends = np.append(np.flatnonzero(ids == self.line_break), len(ids))
        length = np.diff(ends, prepend=-1) - 1
        if len(length) != n:
            raise ValueError("the vocabulary does not keep a line break as a piece of its own")
        return ids[ids != self.line_break], length

    def _learn(self, new: pa.Array, keys: np.ndarray) -> None:
        if len(self.keys) + len(new) > CACHE_PIECES:
            self._forget()
        data, offsets = buffers(new)
        blank = IS_SPACE[data[offsets[1:] - 1]]  # such a piece is white space only
        joined, apart = new.filter(pa.array(~blank)), new.filter(pa.array(blank)).to_pylist()
        keys = np.concatenate((keys[~blank], keys[blank]))
        ids, length = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if len(joined):
            text = pc.binary_join(pa.ListArray.from_arrays([0, len(joined)], joined), "\n")[0].as_py()
            ids, length = self._pieces(text, len(joined))
        if apart:
            own = self._whole(apart)
            length = np.concatenate((length, np.fromiter(map(len, own), np.int64, len(own))))
            ids = np.concatenate((ids, *own))
        first = len(self.flat) + np.cumsum(length) - length
        self.flat = np.concatenate((self.flat, ids))
        order = np.argsort(keys)
        at = np.searchsorted(self.keys, keys[order])
        self.keys = np.insert(self.keys, at, keys[order])
        self.first = np.insert(self.first, at, first[order])
        self.length = np.insert(self.length, at, length[order])

    def _plain(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Rows whose cut into pieces is certain: code points below PLAIN_LIMIT,
        no white space of several bytes, no added token in the text."""
        odd = data >= 0xE3
        raw = data.tobytes()
        at = np.flatnonzero(data >= 0xC2)
        two = at[data[at] < 0xE0]
        if len(two):
            cp = ((data[two].astype(np.int64) & 31) << 6) | (data[two + 1] & 63)
            odd[two[self.classes[cp] == SPACE]] = True
        three = at[(data[at] >= 0xE0) & (data[at] < 0xE3)]
        if len(three):
            cp = ((data[three].astype(np.int64) & 15) << 12) | ((data[three + 1].astype(np.int64) & 63) << 6) | (data[three + 2] & 63)
            odd[three[self.classes[cp] == SPACE]] = True
        for token in self.added:
            found = raw.find(token)
            while found >= 0:
                odd[found] = True
                found = raw.find(token, found + 1)
        plain = np.ones(len(offsets) - 1, dtype=bool)
        plain[row_of(np.flatnonzero(odd), offsets)] = False
        return plain

    def _cut(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Start of every piece, as the vocabulary's pre-tokenizer cuts plain texts."""
        n = len(data)
        kind = self.classes[data]
        lead = np.flatnonzero(data >= 0xC2)
        two, three = lead[data[lead] < 0xE0], lead[data[lead] >= 0xE0]
        kind[two] = kind[two + 1] = self.classes[((data[two].astype(np.int64) & 31) << 6) | (data[two + 1] & 63)]
        if len(three):
            c = self.classes[((data[three].astype(np.int64) & 15) << 12) | ((data[three + 1].astype(np.int64) & 63) << 6) | (data[three + 2] & 63)]
            kind[three] = kind[three + 1] = kind[three + 2] = c
        edge = np.zeros(n + 1, dtype=bool)
        edge[offsets] = True
        begin = edge[:-1].copy()
        begin[1:] |= kind[1:] != kind[:-1]
        # The last white space before anything else is a piece of its own or, if a space, joins what follows.
        space = kind == SPACE
        last = np.flatnonzero(space[:-1] & ~space[1:] & ~edge[1:-1])
        begin[last] = True
        joins = last[data[last] == 0x20]
        begin[joins + 1] = False
        # An apostrophe that is a run of its own, with nothing before it in its piece, takes its ending along.
        for p in np.flatnonzero((data == 0x27) & begin).tolist():
            if p + 1 >= n or edge[p + 1] or kind[p + 1] != LETTER:
                continue
            stop = int(offsets[row_of(np.array([p]), offsets)[0] + 1])
            tail = data[p : min(p + 3, stop)].tobytes()
            ending = next((e for e in ENDINGS if tail.startswith(e)), None)
            if ending:
                begin[p + 1] = False
                if p + len(ending) < stop:
                    begin[p + len(ending)] = True
        return np.flatnonzero(begin)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the column, and the row offsets into them. Null is empty."""
        data, offsets = buffers(column)
        rows = len(offsets) - 1
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(rows + 1, np.int64)
        plain = self._plain(data, offsets)
        if not plain.all():
            return self._mixed(data, offsets, plain)
        starts = self._cut(data, offsets)
        ends = np.append(starts[1:], len(data))
        words = pa.Array.from_buffers(
            pa.string(), len(starts), [None, pa.py_buffer(np.append(starts, len(data)).astype(np.int32)), pa.py_buffer(data)]
        ).dictionary_encode()
        spelled, spans = buffers(words.dictionary)
        keys = span_hashes(spelled, spans[:-1], spans[1:])
        for _ in range(2):  # twice if the cache was emptied meanwhile
            at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
            new = self.keys[at] != keys if len(self.keys) else np.ones(len(keys), dtype=bool)
            if not new.any():
                break
            self._learn(words.dictionary.filter(pa.array(new)), keys[new])
        at = np.searchsorted(self.keys, keys)
        piece = at[words.indices.to_numpy(zero_copy_only=False)]
        length = self.length[piece]
        ids = self.flat[np.repeat(self.first[piece], length) + runs_within(length)]
        total = np.concatenate(([0], np.cumsum(length)))
        at = np.searchsorted(starts, offsets)  # first piece of each row; row edges are always piece starts
        assert ends[-1] == len(data)
        return ids, total[at]

    def _mixed(self, data: np.ndarray, offsets: np.ndarray, plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        parts: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(plain)
        odd = np.flatnonzero(~plain)
        for i, ids in zip(odd.tolist(), self._whole([raw[offsets[i] : offsets[i + 1]].decode() for i in odd]), strict=True):
            parts[i] = ids
        rest = np.flatnonzero(plain)
        if len(rest):
            ids, at = self.encode(pa.array([raw[offsets[i] : offsets[i + 1]].decode() for i in rest], pa.large_string()))
            for k, i in enumerate(rest.tolist()):
                parts[i] = ids[at[k] : at[k + 1]]
        return np.concatenate(parts), np.concatenate(([0], np.cumsum(list(map(len, parts)))))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
