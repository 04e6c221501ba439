"""Exact, fast use of public tokenizer files on executors."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterable, Iterator

import numpy as np

from .shingles import PAD, batched, contents, hashed
from .workers import HELD

#: Bytes of printable ASCII, and of the second byte of U+00C0 to U+00FF but for the two signs there.
#: Between such characters a single space always begins a token and a single line feed stands alone:
#: neither of the two pre-tokenizers has a pattern that goes on past it, and normalisation doesn't
#: join across it.
_ASCII = np.zeros(256, bool)
_ASCII[0x21:0x7F] = True
_SECOND = np.zeros(256, bool)
_SECOND[0x80:0xC0] = True
_SECOND[[0x97, 0xB7]] = False
_LEAD = 0xC3
_MARK = np.isin(np.arange(256), list(b".,;:!?"))
_ALNUM = np.array([chr(b).isalnum() and b < 128 for b in range(256)])
#: Kinds of bytes in a piece: 0 a space or line feed, 1 letters, 2 digits, 3 other signs.
_KIND = np.select([np.isin(np.arange(256), [10, 32]), _ALNUM & (np.arange(256) > 57) | (np.arange(256) > 127), _ALNUM], [0, 1, 2], 3).astype(np.int8)


def _joined(data: np.ndarray, begin: np.ndarray, end: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of pieces one after another, each behind its space (kind 1) or a line feed, and where each starts."""
    n = end - begin + 1
    starts = np.cumsum(n) - n
    flat = data[np.repeat(begin - 1 - starts, n) + np.arange(n.sum())]
    flat[starts] = np.where(kind == 1, 32, 10)
    return flat, starts


def _runs(flat: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many runs of letters, single digits and runs of other signs each piece has, and which pieces are odd: they
    hold an apostrophe, a control character or anything beyond the letters up to U+00FF."""
    kind, lead = _KIND[flat], flat == _LEAD
    new = np.diff(kind, prepend=0).astype(bool) & (kind > 0) | (kind == 2)
    right = _SECOND[flat] & np.concatenate([[False], lead[:-1]])
    known = _ASCII[flat] & (flat != 39) | right | (lead & np.concatenate([right[1:], [False]])) | (kind == 0)
    return np.add.reduceat(new, starts, dtype=np.int64), np.add.reduceat(~known, starts, dtype=np.int64) > 0


def file_digest(path: str) -> str:
    """SHA-256 of a tokenizer file: the version under which counts are stored."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


class PieceTable:
    """Ids of pieces by their contents, with open addressing, for many pieces at a time.

    A row holds the two values and the length of a piece's contents (with its kind), by which it is
    compared, and where its ids lie. The hash only says where to look.
    """

    def __init__(self):
        self.n, self.bits = 0, 16
        self.rows = np.zeros((1 << 15, 4), np.uint64)
        self.again = np.zeros(len(self.rows), bool)  # rows found since they were added or last kept
        self.slots = np.full(1 << self.bits, -1, np.int32)

    def find(self, keys: tuple[np.ndarray, ...], places: np.ndarray, note: bool = False) -> np.ndarray:
        """Where the ids of each key (one, two, length and kind) lie; 0 if it isn't held. note: marks the rows found."""
        found, left = np.zeros(len(places), np.int64), None
        at = (places >> np.uint64(64 - self.bits)).view(np.int64)
        while True:
            row = self.slots.take(at)
            held = self.rows.take(row, 0, mode="wrap")  # -1 gives a row too, which `row` rules out
            same = row >= 0
            go_on = same.copy()
            for k in range(3):
                same &= held[:, k] == keys[k]
            if left is None:
                found, left = np.where(same, held[:, 3].view(np.int64), 0), np.arange(len(places))
            else:
                found[left[same]] = held[same, 3]
            if note:
                self.again[row[same]] = True
            go_on = np.flatnonzero(go_on & ~same)
            if not len(go_on):
                return found
            left, at, keys = left[go_on], (at[go_on] + 1) & ((1 << self.bits) - 1), [k[go_on] for k in keys]

    def add(self, keys: tuple[np.ndarray, ...], places: np.ndarray, where: np.ndarray) -> None:
        """Adds keys that differ from each other and from all held."""
        end = self.n + len(places)
        if end > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros((max(len(self.rows) // 2, len(places)), 4), np.uint64)])
            self.again = np.concatenate([self.again, np.zeros(len(self.rows) - len(self.again), bool)])
        for k, column in enumerate((*keys, where)):
            self.rows[self.n : end, k] = column
        first, self.n = self.n, end
        if 2 * end > len(self.slots):
            self.bits, first = int(2 * end).bit_length(), 0
            self.slots, places = np.full(1 << self.bits, -1, np.int32), hashed(*self.rows[:end, :3].T)
        left = np.arange(first, end)
        at = (places >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(left):
            free = self.slots[at] < 0
            self.slots[at[free]] = left[free]  # of pieces that want one slot the last has it
            lost = self.slots[at] != left
            left, at = left[lost], (at[lost] + 1) & ((1 << self.bits) - 1)


def _where(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ids lie and how many they are, of a row's last value."""
    return packed >> 31, packed & (2**31 - 1)


def _ranges(pool: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The `n` values of a pool from each place `at` on, one after another."""
    return pool[np.repeat(at - (np.cumsum(n) - n), n) + np.arange(n.sum())]


class PieceEncoder:
    """Ids of whole texts as a `tokenizers` file gives them, with no special tokens added.

    A text is cut at single spaces and line feeds where every tokenization has a border, so that each
    distinct piece goes through the library once and later ones come from a table, which compares
    their contents. Texts with another neighbour of a space or line feed (white space, other scripts,
    text edges) go through the library whole. Past `limit` pieces, or four times as many ids, the
    table keeps only pieces that were met again, at most half as many; nothing depends on what it holds.
    """

    def __init__(self, path: str, limit: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library, self.limit = Tokenizer.from_file(path), limit
        self.kind = np.uint16 if self.library.get_vocab_size() <= 1 << 16 else np.uint32
        self.line_feed = len(self.library.encode("\n", add_special_tokens=False).ids)
        # Marked tokens: ends of words, or those that begin with a space or line feed.
        self.suffix = self.library.model.end_of_word_suffix
        self.marks = np.zeros(self.library.get_vocab_size(), bool)
        self.marks[[k for token, k in self.library.get_vocab().items() if (token.endswith(self.suffix) if self.suffix else token[0] in "ĠĊ")]] = True
        self.table = PieceTable()
        self.pool, self.used = np.zeros(1 << 18, self.kind), 1  # no piece lies at 0

    def _trim(self) -> None:
        """Begins a new table with the pieces found again, the latest of them, at most half of the limits."""
        old, pool = self.table, self.pool
        kept = old.rows[np.flatnonzero(old.again[: old.n])[-(self.limit // 2 + 1) :]]
        at, n = _where(kept[:, 3].astype(np.int64))
        fits = np.cumsum(n[::-1])[::-1] <= 2 * self.limit
        kept, at, n = kept[fits], at[fits], n[fits]
        self.table, self.pool, self.used = PieceTable(), np.zeros(1 << 18, self.kind), 1
        if len(kept):
            keys = tuple(kept[:, k].copy() for k in range(3))
            self._store(keys, hashed(*keys), _ranges(pool, at, n), n)

    def _store(self, keys: tuple[np.ndarray, ...], places: np.ndarray, ids: np.ndarray, n: np.ndarray, dropped: np.ndarray | int = 0) -> None:
        """Adds pieces with their ids, of which the first `dropped` aren't theirs."""
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(len(self.pool) // 2, len(ids)), self.kind)])
        self.pool[self.used : self.used + len(ids)] = ids
        at = self.used + np.cumsum(n) - n + dropped
        self.used += len(ids)
        self.table.add(keys, places, (at << 31 | n - dropped).view(np.uint64))

    def _owned(self, text: str, starts: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """How many ids each piece of a text has, told by where their tokens start, and the ids. starts: of pieces, in bytes."""
        found = self.library.encode(text, add_special_tokens=False)
        if not text.isascii():  # offsets count characters
            starts = np.cumsum(np.frombuffer(text.encode(), np.uint8) & 0xC0 != 0x80)[starts] - 1
        owner = np.searchsorted(starts, np.array(found.offsets, np.int64).reshape(-1, 2)[:, 0], "right") - 1
        return np.bincount(owner, minlength=len(starts)), found.ids

    def _marked(self, text: str, starts: np.ndarray, runs: np.ndarray | None) -> tuple[np.ndarray, list[int]]:
        """The same by marked tokens, without offsets, which cost as much as the ids: a piece begins with the one that
        begins with its space or line feed, or has as many ends of words as runs."""
        ids = self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids
        marks = np.flatnonzero(self.marks[ids])
        if len(marks) == (len(starts) if runs is None else runs.sum()):
            n = np.diff(marks, append=len(ids)) if runs is None else np.diff(marks[np.cumsum(runs) - 1], prepend=-1)
            if n.sum() == len(ids):
                return n, ids
        return self._owned(text, starts)  # such as a special token's text

    def _learn(self, keys: tuple[np.ndarray, ...], places: np.ndarray, data: np.ndarray, begin: np.ndarray, end: np.ndarray, kind: np.ndarray) -> None:
        """Encodes new pieces, many in one call: each begins with the space or line feed before it,
        others (a text's first piece, marks) with a line feed whose ids are dropped."""
        flat, starts = _joined(data, begin, end, kind)
        runs, odd = None, np.zeros(len(starts), bool)
        if self.suffix:
            runs, odd = _runs(flat, starts)
            if odd.any():  # odd ones last
                order = np.argsort(odd, kind="stable")
                keys, places, kind, runs, odd = tuple(k[order] for k in keys), places[order], kind[order], runs[order], odd[order]
                flat, starts = _joined(data, begin[order], end[order], kind)
        counts, ids = [], []
        # About 200,000 bytes a call: an encoding takes far more than its text.
        calls = np.flatnonzero(np.diff(starts // 200_000, prepend=-1) | np.diff(odd, prepend=odd[0]))
        for a, b in zip(calls.tolist(), [*calls[1:].tolist(), len(starts)], strict=True):
            text = flat[starts[a] : starts[b] if b < len(starts) else len(flat)].tobytes().decode()
            some = starts[a:b] - starts[a]
            n, found = self._owned(text, some) if odd[a] else self._marked(text, some, None if runs is None else runs[a:b])
            counts.append(n)
            ids.append(np.array(found, self.kind))
        self._store(keys, places, np.concatenate(ids), np.concatenate(counts), (kind == 0) * self.line_feed)

    def _whole(self, text: bytes) -> np.ndarray:
        return np.array(self.library.encode(text.decode(), add_special_tokens=False).ids, self.kind)

    def _batch(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """Ids of each text. Texts are joined by a line feed, so every border looks alike."""
        raw = b"\n" + b"\n".join(texts) + b"\n"
        whole = np.frombuffer(raw + bytes(PAD), np.uint8)
        data = whole[: len(raw)]
        bounds = np.cumsum([1, *[len(t) + 1 for t in texts]])  # where each text starts
        cuts = np.flatnonzero((data == 32) | (data == 10))
        before, after = data[np.maximum(cuts - 1, 0)], data[np.minimum(cuts + 1, len(data) - 1)]
        left = _ASCII[before] | (_SECOND[before] & (data[np.maximum(cuts - 2, 0)] == _LEAD))
        right = _ASCII[after] | ((after == _LEAD) & _SECOND[data[np.minimum(cuts + 2, len(data) - 1)]])
        left[0] = right[-1] = True
        # A border belongs to the texts on both of its sides; those with a bad one are encoded whole.
        bad = np.zeros(len(texts) + 1, np.int64)
        last = np.searchsorted(bounds, cuts, "left")  # texts that end at or contain a cut
        text_of = np.maximum(last - 1, 0)
        np.add.at(bad, text_of[~left], 1)
        starts = np.searchsorted(bounds, cuts + 1, "right") - 1
        np.add.at(bad, np.minimum(starts, len(texts))[~right], 1)
        first = np.isin(cuts + 1, bounds[:-1], assume_unique=True)  # cuts before a text
        begin, end = cuts[:-1] + 1, cuts[1:]
        kind = np.where(first[:-1], 0, np.where(data[cuts[:-1]] == 32, 1, 2))
        owner = starts[:-1]
        good = bad[owner] == 0
        begin, end, kind, owner = begin[good], end[good], kind[good], owner[good]
        # A mark after a letter or digit is a token of its own before a border.
        prior = data[np.maximum(end - 2, 0)]
        marked = np.flatnonzero(_MARK[data[end - 1]] & (end - begin > 1) & (_ALNUM[prior] | (_SECOND[prior] & (data[np.maximum(end - 3, 0)] == _LEAD))))
        begin, kind, owner = np.insert(begin, marked + 1, end[marked] - 1), np.insert(kind, marked + 1, 0), np.insert(owner, marked + 1, owner[marked])
        end = np.insert(end, marked, end[marked] - 1)
        one, two, length = contents(whole, begin, end)
        keys = (one, two, (length << 2 | kind).view(np.uint64))
        places = hashed(*keys)
        if self.table.n > self.limit or self.used > 4 * self.limit:
            self._trim()
        where = self.table.find(keys, places, note=True)
        while len(missed := np.flatnonzero(where == 0)):  # again only if unlike pieces share a hash
            fresh = missed[np.unique(places[missed], return_index=True)[1]]
            self._learn(tuple(k[fresh] for k in keys), places[fresh], data, begin[fresh], end[fresh], kind[fresh])
            where[missed] = self.table.find(tuple(k[missed] for k in keys), places[missed])
        at, n = _where(where)
        ids = _ranges(self.pool, at, n)
        upto = np.concatenate([[0], np.cumsum(n)])
        edge = upto[np.searchsorted(owner, np.arange(len(texts) + 1))]
        for k, text in enumerate(texts):
            yield self._whole(text) if bad[k] else ids[edge[k] : edge[k + 1]]

    def encode_all(self, texts: Iterable[bytes]) -> Iterator[np.ndarray]:
        """Ids (unsigned) of UTF-8 texts, in order; an empty text has none."""
        for some in batched(texts, 400_000):
            full = [t for t in some if t]
            found = self._batch(full) if full else iter(())
            for text in some:
                yield next(found) if text else np.zeros(0, np.uint32)


def encoder_of(path: str) -> PieceEncoder:
    """The encoder of a file that this worker process holds: its table outlives a task, until one of
    another kind begins. One file at a time is held, so a worker keeps one bounded table."""
    at = os.stat(path)
    key = (path, at.st_mtime_ns, at.st_size)
    if key not in HELD:
        HELD.clear()
        HELD[key] = PieceEncoder(path)
    return HELD[key]
