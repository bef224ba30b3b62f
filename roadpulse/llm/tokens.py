"""Token ids of whole texts by the tokenizers library, with every distinct piece of text encoded once.

The library costs about a microsecond a byte.  Texts are therefore cut where its byte-level
pre-tokenizer cuts, by comparing classes of neighbouring characters in numpy, and only pieces not seen
before go to the library, already cut; ids of texts are then gathered from a pool.  Pieces are
recognised by their bytes and not by a hash alone.  A text holding one of the vocabulary's added
tokens goes to the library as it is.  A text of any length is worked on in blocks that end between a word and the
space after it, where the pre-tokenizer always cuts; only a text without such a place is one block.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence

import numpy as np
import regex
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

#: Pieces of up to this many bytes are recognised in bulk; longer ones are looked up one by one.
PIECE = 24
#: Distinct pieces a worker remembers.
REMEMBERED = 1_000_000
#: Characters of a text worked on at once.
BLOCK = 1 << 18

_LETTER, _NUMBER, _SPACE = 1, 2, 3
_LOW = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


@functools.cache
def character_classes() -> np.ndarray:
    """By code point: letter, number, white space, or 0, as the library's pre-tokenizer sees them.

    Its Unicode version may be older than that of ``regex``, so it is asked which letters and numbers it knows.
    """
    every = "".join(map(chr, range(0x110000)))
    classes = np.zeros(0x110000, np.uint8)
    cut = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    for kind, pattern, before in ((_LETTER, r"\p{L}", "a"), (_NUMBER, r"\p{N}", "1"), (_SPACE, r"\p{White_Space}", "")):
        found = [m.start() for m in regex.finditer(pattern, every)]
        if before:
            begins = {at for _, (at, _) in cut("".join(f"{before}{chr(c)}\n" for c in found))}
            found = [c for i, c in enumerate(found) if 3 * i + 1 not in begins]
        classes[found] = kind
    return classes


def piece_starts(points: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Where the byte-level pre-tokenizer begins a piece, in the code points of texts put one after the other.

    Its pieces are contractions, runs of letters, of numbers and of other characters, each with one
    space before it, and white space, whose last character is a piece of its own if more text follows.
    """
    n = len(points)
    kind = character_classes()[points]
    first = np.zeros(n + 1, bool)
    first[text_starts] = True
    first[n] = True
    begins = first[:n].copy()
    begins[1:] |= kind[1:] != kind[:-1]
    goes_on = ~first[1:]
    following = np.append(kind[1:], 0)
    last_space = goes_on & (kind == _SPACE) & (following != _SPACE)
    begins |= last_space
    begins[1:][(last_space & (points == 32))[:-1]] = False
    # Contractions: an apostrophe that begins a piece, and the letters after it.
    quotes = np.flatnonzero((points == 39) & begins & goes_on)
    if len(quotes):
        letters = np.append(points, [0, 0, 0])
        one, two = letters[quotes + 1], letters[quotes + 2]
        two = np.where(first[np.minimum(quotes + 2, n)], 0, two)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        for found, size in ((quotes[short], 1), (quotes[long], 2)):
            begins[found + 1] = False
            after = found + size + 1
            begins[after[after < n]] = True
    return np.flatnonzero(begins)


def blocks(text: str, limit: int = BLOCK) -> Iterator[str]:
    """The text in parts of about ``limit`` characters, cut before a lone space between two other characters."""
    start = 0
    while len(text) - start > limit:
        at = text.rfind(" ", start + 1, start + limit)
        while at > start and (text[at - 1].isspace() or text[at + 1].isspace()):
            at = text.rfind(" ", start + 1, at)
        if at <= start:
            at = text.find(" ", start + limit)
            while 0 < at < len(text) - 1 and (text[at - 1].isspace() or text[at + 1].isspace()):
                at = text.find(" ", at + 1)
            if at < 0 or at >= len(text) - 1:
                break
        yield text[start:at]
        start = at
    yield text[start:]


class Encoder:
    """Ids of texts; pieces met before come from a pool."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.forget()

    def forget(self) -> None:
        self.slots: dict[int, int] = {}
        self.words = np.zeros((1 << 12, 4), np.uint64)
        self.at, self.size = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0

    def text_ids(self, text: str) -> np.ndarray:
        """Ids of one text of any length."""
        parts = [self.encode([block])[0] for block in blocks(text)]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Ids of each text, as unsigned 32-bit integers."""
        special = {i for i, t in enumerate(texts) if any(a in t for a in self.added)} if self.added else set()
        found = self._encode_plain([("" if i in special else t) for i, t in enumerate(texts)])
        for i in special:
            found[i] = np.array(self.library.encode(texts[i], add_special_tokens=False).ids, np.uint32)
        return found

    def _encode_plain(self, texts: Sequence[str]) -> list[np.ndarray]:
        joined = "".join(texts)
        if not joined:
            return [np.zeros(0, np.uint32) for _ in texts]
        points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        ends = np.cumsum([len(t) for t in texts])
        begins = ends - np.array([len(t) for t in texts])
        starts = piece_starts(points, begins[ends > begins])
        raw = joined.encode()
        data = np.frombuffer(raw, np.uint8)
        byte_of = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        edges = np.append(byte_of[starts], len(data))
        at, size = self._pieces(raw, data, edges[:-1], np.diff(edges))
        total = np.append(0, np.cumsum(size))
        ids = self.pool[np.repeat(at - total[:-1], size) + np.arange(total[-1])]
        cuts = total[np.searchsorted(starts, np.append(begins, len(points)))]
        return [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]

    def _pieces(self, raw: bytes, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and number of ids in the pool for each piece."""
        at, size = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        bulk = np.flatnonzero(length <= PIECE)
        # A piece as three numbers of eight bytes, bytes beyond its end cleared, and its length.
        padded = np.append(data, np.zeros(PIECE, np.uint8))
        eight = np.ndarray(len(data) + PIECE - 7, "<u8", padded, strides=(1,))
        words = np.empty((len(bulk), 4), np.uint64)
        for i in range(3):
            words[:, i] = eight[start[bulk] + 8 * i] & _LOW[np.clip(length[bulk] - 8 * i, 0, 8)]
        words[:, 3] = length[bulk]
        hashes = (words * _MIX).sum(axis=1, dtype=np.uint64)
        hashes = (hashes ^ (hashes >> np.uint64(31))) * _MIX[0]
        distinct, sample, which = np.unique(hashes, return_index=True, return_inverse=True)
        slots = np.array([self.slots.get(h, -1) for h in distinct.tolist()], np.int64)
        fresh = np.flatnonzero(slots < 0)
        if len(self.slots) + len(fresh) > REMEMBERED and self.slots:
            self.forget()
            slots[:] = -1
            fresh = np.arange(len(distinct))
        if len(fresh):
            picked = bulk[sample[fresh]]
            slots[fresh] = len(self.slots) + np.arange(len(fresh))
            self._learn(raw, start[picked], length[picked], words[sample[fresh]], distinct[fresh])
        mine = slots[which]
        equal = (self.words[mine] == words).all(axis=1)
        at[bulk], size[bulk] = self.at[mine], self.size[mine]
        # Long pieces, and pieces that share a hash with another one, are encoded for this call only.
        single = np.concatenate([np.flatnonzero(length > PIECE), bulk[~equal]])
        if len(single):
            found = [raw[s : s + n] for s, n in zip(start[single].tolist(), length[single].tolist())]
            names = {piece: i for i, piece in enumerate(dict.fromkeys(found))}
            ids, counts = self._library_ids([piece.decode() for piece in names])
            self._room(len(ids))
            self.pool[self.used : self.used + len(ids)] = ids
            begin = self.used + np.append(0, np.cumsum(counts))[:-1]
            order = np.array([names[piece] for piece in found])
            at[single], size[single] = begin[order], counts[order]
        return at, size

    def _learn(self, raw: bytes, start: np.ndarray, length: np.ndarray, words: np.ndarray, hashes: np.ndarray) -> None:
        ids, counts = self._library_ids([raw[s : s + n].decode() for s, n in zip(start.tolist(), length.tolist())])
        first, last = len(self.slots), len(self.slots) + len(start)
        while last > len(self.at):
            self.words = np.concatenate([self.words, np.zeros_like(self.words)])
            self.at, self.size = np.append(self.at, np.zeros_like(self.at)), np.append(self.size, np.zeros_like(self.size))
        self._room(len(ids))
        self.pool[self.used : self.used + len(ids)] = ids
        self.words[first:last], self.size[first:last] = words, counts
        self.at[first:last] = self.used + np.append(0, np.cumsum(counts))[:-1]
        self.used += len(ids)
        self.slots.update(zip(hashes.tolist(), range(first, last)))

    def _room(self, more: int) -> None:
        while self.used + more > len(self.pool):
            self.pool = np.append(self.pool, np.zeros_like(self.pool))

    def _library_ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces one after the other, and how many each has."""
        found = self.library.encode(pieces, is_pretokenized=True, add_special_tokens=False)
        return np.array(found.ids, np.uint32), np.bincount(np.array(found.word_ids, np.int64), minlength=len(pieces))


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker."""
    return Encoder(path)
