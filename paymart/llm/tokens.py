"""Token ids of whole texts by the tokenizers library, with an exact memo of pieces.

Neither tokenizer joins characters across white space or between letters,
digits and other marks, so the ids of a text are those of its *pieces* in
order: runs of one class, for the byte-level tokenizer with the space before
them.  A word with an apostrophe stays one piece, because contractions are
rules of their own.  Texts are cut only if all they hold is Latin letters (up to
U+024F), ASCII marks, single spaces and line feeds; any other text goes through
the library whole.  The ids are therefore those of one library call per text.

Cutting works on the UTF-8 bytes of many texts at once.  A piece of up to 23
bytes is its own key (three words of 8 bytes, compared in full) in an open
hash table of arrays; longer ones are in a dict.  Unseen pieces of letters go
through the library in one call, joined by spaces or line feeds: the ids that
open or close a word show where each one starts.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from paymart.llm.common import mix64

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

TABLE_BITS = 21
FULL = 1_200_000
LONG_FULL = 50_000
GROUP_BYTES = 2 << 20
KEY = 23

_SPACE, _FEED, _LETTER, _DIGIT, _MARK, _BAD = range(6)
_CLASS = np.full(256, _BAD, np.uint8)
_CLASS[0x21:0x7F] = _MARK
_CLASS[[0x20, 0x0A]] = _SPACE, _FEED
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_CLASS[ord("A") : ord("Z") + 1] = _CLASS[ord("a") : ord("z") + 1] = _LETTER
_CLASS[0x80:0xC0] = _CLASS[0xC3:0xCA] = _LETTER  # U+00C0 to U+024F; what is no letter there is sorted out below
_APOSTROPHE = ord("'")


#: By length of a key: which bits of its three words count.
_MASK = np.where(np.arange(24) < np.arange(24)[:, None], np.uint8(255), np.uint8(0)).view("<u8")


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows, and the place of each row among them."""
    _, first, inverse = np.unique(Memo.hash(keys), return_index=True, return_inverse=True)
    fresh = keys[first]
    if (fresh[inverse] == keys).all():
        return fresh, inverse
    fresh, inverse = np.unique(keys, axis=0, return_inverse=True)  # two keys of one hash
    return fresh, inverse.ravel()


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Memo:
    """Keys of three 64-bit words to numbers from 0 on, in an open hash table."""

    def __init__(self) -> None:
        self.size = 1 << TABLE_BITS
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros((self.size, 3), np.uint64)
        self.value = np.full(self.size, -1, np.int32)
        self.count = 0

    @staticmethod
    def hash(keys: np.ndarray) -> np.ndarray:
        return mix64(keys[:, 0] * np.uint64(0x9E3779B97F4A7C15) ^ keys[:, 1] * np.uint64(0xC2B2AE3D27D4EB4F) ^ keys[:, 2] * np.uint64(0x165667B19E3779F9))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 if it is not there."""
        out = np.full(len(keys), -1, np.int32)
        rest, slot = np.arange(len(keys)), (self.hash(keys) & np.uint64(self.size - 1)).astype(np.int64)
        while len(rest):
            value = self.value[slot]
            same = (self.keys[slot] == keys[rest]).all(axis=1) & (value >= 0)
            out[rest[same]] = value[same]
            on = ~same & (value >= 0)
            rest, slot = rest[on], (slot[on] + 1) & (self.size - 1)
        return out

    def add(self, keys: np.ndarray) -> np.ndarray:
        """Numbers for new, distinct keys."""
        numbers = np.arange(self.count, self.count + len(keys), dtype=np.int32)
        self.count += len(keys)
        rest, slot = np.arange(len(keys)), (self.hash(keys) & np.uint64(self.size - 1)).astype(np.int64)
        while len(rest):
            free = np.flatnonzero(self.value[slot] < 0)
            _, first = np.unique(slot[free], return_index=True)
            won = free[first]
            self.keys[slot[won]], self.value[slot[won]] = keys[rest[won]], numbers[rest[won]]
            on = np.ones(len(rest), bool)
            on[won] = False
            rest, slot = rest[on], (slot[on] + 1) & (self.size - 1)
        return numbers


class Encoder:
    """Texts to ids as little-endian unsigned 16-bit bytes (32-bit beyond 65,536 ids)."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        size = max(vocabulary.values()) + 1
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        ends, opens, feeds = (np.zeros(size, bool) for _ in range(3))
        for piece, i in vocabulary.items():
            ends[i], opens[i], feeds[i] = piece.endswith("</w>"), piece.startswith("Ġ"), piece == "Ċ"
        self.spaced = not ends.any()  # byte level: a word carries its space, a line feed is a piece
        self.edges = {"": ends, " ": opens, "\n": feeds}
        self.memo = Memo()
        self._clear()

    def _clear(self) -> None:
        self.memo.clear()
        self.pool = np.empty(1 << 20, self.dtype)
        self.used = 0
        self.at, self.n = np.zeros(FULL * 2, np.int64), np.zeros(FULL * 2, np.int32)
        self.long: dict[bytes, np.ndarray] = {}

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype)

    def _words(self, words: list[str], lead: str) -> list[np.ndarray]:
        """Ids of words of letters, each after ``lead`` (a line feed's own id is left out)."""
        out: list[np.ndarray] = []
        for at in range(0, len(words), 20_000):
            some = words[at : at + 20_000]
            text = lead + (lead or " ").join(some)
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)
            edge = np.flatnonzero(self.edges[lead][ids])
            if len(edge) != len(some):
                out += [self.whole(lead + w)[int(lead == "\n") :] for w in some]
                continue
            cuts = np.append(edge, len(ids)) if lead else np.append(0, edge + 1)
            skip = int(lead == "\n")
            out += [ids[a + skip : b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        return out

    def _encode_pieces(self, pieces: list[tuple[str, bool]]) -> list[np.ndarray]:
        """Ids of distinct (piece, after a space)."""
        out: list[np.ndarray | None] = [None] * len(pieces)
        joined: dict[str, list[int]] = {"": [], " ": [], "\n": []}
        for k, (piece, after) in enumerate(pieces):
            if piece.isalpha():
                joined[(" " if after else "\n") if self.spaced else ""].append(k)
            else:
                out[k] = self.whole(" " + piece if after else piece)
        for lead, which in joined.items():
            if which:
                for k, ids in zip(which, self._words([pieces[k][0] for k in which], lead), strict=True):
                    out[k] = ids
        return out

    def _store(self, numbers: np.ndarray, lists: list[np.ndarray]) -> None:
        sizes = np.array([len(x) for x in lists], np.int32)
        flat = np.concatenate(lists)
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate((self.pool, np.empty(len(self.pool), self.dtype)))
        self.pool[self.used : self.used + len(flat)] = flat
        self.at[numbers] = self.used + np.cumsum(sizes) - sizes
        self.n[numbers] = sizes
        self.used += len(flat)

    def _plain(self, data: np.ndarray, at: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Which texts can be cut."""
        blank = kind <= _FEED
        bad = kind == _BAD
        high = np.flatnonzero(data >= 0xC3)
        high = high[high + 1 < len(data)]
        lead, tail = data[high], data[high + 1]
        # the signs for times and division, the dotted capital I (its lower case is two characters), U+0250 on
        odd = (lead == 0xC3) & ((tail == 0x97) | (tail == 0xB7)) | (lead == 0xC4) & (tail == 0xB0) | (lead == 0xC9) & (tail >= 0x90)
        bad[high[odd]] = True
        less = np.flatnonzero(data[:-1] == ord("<"))
        bad[less[data[less + 1] == ord("|")]] = True
        run = np.flatnonzero(blank[1:] & blank[:-1]) + 1  # the second of two blanks
        some = at[1:] > at[:-1]
        first, last = np.minimum(at[:-1], len(data) - 1), np.maximum(at[1:] - 1, 0)
        wrong = np.flatnonzero(bad)
        clean = np.searchsorted(wrong, at[1:]) == np.searchsorted(wrong, at[:-1])
        single = np.searchsorted(run, at[1:]) == np.searchsorted(run, at[:-1] + 1)
        return some & clean & single & ~blank[first] & ~blank[last]

    def _group(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids of each) for texts ``data[at[i] : at[i + 1]]``."""
        texts = len(at) - 1
        if not len(data):
            return np.empty(0, self.dtype), np.zeros(texts, np.int64)
        kind = _CLASS[data]
        plain = self._plain(data, at, kind)
        use = np.repeat(plain, np.diff(at))
        opening = at[:-1][at[:-1] < len(data)]
        blank = kind <= _FEED
        edge = np.empty(len(data), bool)
        np.not_equal(kind[1:], kind[:-1], out=edge[1:])
        edge[opening] = True
        if self.spaced:
            edge |= kind == _FEED
        quotes = np.flatnonzero(data == _APOSTROPHE)
        if len(quotes):  # no cuts inside a word with an apostrophe
            word_edge = blank.copy()
            word_edge[1:] |= blank[:-1]
            word_edge[opening] = True
            word = np.cumsum(word_edge)
            has = np.zeros(int(word[-1]) + 1, bool)
            has[word[quotes]] = True
            edge &= word_edge | ~has[word]
        # a piece ends at the next edge, blank or text
        stop = np.flatnonzero(edge | blank)
        piece = use[stop] & (kind[stop] >= (_FEED if self.spaced else _LETTER))
        start, end = stop[piece], np.append(stop[1:], len(data))[piece]
        size = end - start
        after = np.zeros(len(start), bool)
        if self.spaced and len(start):
            after = (start > 0) & (kind[start - 1] == _SPACE)
            after[np.searchsorted(start, opening[np.isin(opening, start)])] = False
        short = size <= KEY
        number = np.full(len(start), -1, np.int64)
        s = start[short]
        padded = np.concatenate((data, np.zeros(24, np.uint8)))
        wide = np.ndarray((len(data),), np.dtype("V24"), padded, strides=(1,))[s].view("<u8").reshape(-1, 3)
        keys = wide & _MASK[size[short]]
        keys[:, 2] |= after[short].astype(np.uint64) << np.uint64(56)
        found = self.memo.find(keys)
        new = np.flatnonzero(found < 0)
        if len(new):
            fresh, inverse = _distinct(keys[new])
            names = fresh.astype("<u8").tobytes()
            raws = [names[k : k + 24] for k in range(0, len(names), 24)]
            numbers = self.memo.add(fresh)
            self._store(numbers, self._encode_pieces([(raw[:23].rstrip(b"\x00").decode(), raw[23] == 1) for raw in raws]))
            found[new] = numbers[inverse]
        number[short] = found
        lengths = np.zeros(len(start), np.int64)
        lengths[short] = self.n[found]
        far: dict[int, np.ndarray] = {}
        for k in np.flatnonzero(~short).tolist():
            key = (b" " if after[k] else b"") + data[start[k] : end[k]].tobytes()
            if key not in self.long:
                if len(self.long) >= LONG_FULL:
                    self.long.clear()
                self.long[key] = self.whole(key.decode())
            far[k] = self.long[key]
            lengths[k] = len(far[k])
        # texts that are encoded whole take part as one piece each
        other = np.flatnonzero(~plain & (at[1:] > at[:-1]))
        wholes = {len(start) + j: self.whole(data[at[i] : at[i + 1]].tobytes().decode()) for j, i in enumerate(other.tolist())}
        far.update(wholes)
        place = np.concatenate((start, at[:-1][other]))
        lengths = np.concatenate((lengths, np.array([len(x) for x in wholes.values()], np.int64)))
        number = np.concatenate((number, np.full(len(other), -1, np.int64)))
        if len(other):
            order = np.argsort(place, kind="stable")
            place, lengths, number = place[order], lengths[order], number[order]
            back = np.empty(len(order), np.int64)
            back[order] = np.arange(len(order))
            far = {int(back[k]): x for k, x in far.items()}
        to = np.cumsum(lengths)
        begin = to - lengths
        total = int(to[-1]) if len(to) else 0
        source = np.arange(total) + np.repeat(np.where(number >= 0, self.at[number], 0) - begin, lengths)
        for k, x in far.items():
            source[begin[k] : to[k]] = 0
        ids = self.pool[source]
        for k, x in far.items():
            ids[begin[k] : to[k]] = x
        of = np.searchsorted(at, place, side="right") - 1
        each = np.bincount(of, weights=lengths, minlength=texts).astype(np.int64)
        if self.memo.count > FULL:
            self._clear()
        return ids, each

    def encode(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text of a string column; null is empty."""
        column = column.cast(pa.large_string()).fill_null("")
        n = len(column)
        if n == 0:
            return
        _, offsets, data = column.buffers()
        at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
        data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
        first = 0
        while first < n:
            last = max(first + 1, int(np.searchsorted(at, at[first] + GROUP_BYTES, side="right")) - 1)
            ids, each = self._group(data[at[first] : at[last]], at[first : last + 1] - at[first])
            yield from np.split(ids, np.cumsum(each)[:-1])
            first = last


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder a path and worker process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
