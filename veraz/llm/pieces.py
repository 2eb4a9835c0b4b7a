"""Texts cut into pieces that tokenizers treat on their own, and a bounded memo of what they give.

A batch of texts is one array of bytes. It is cut, hashed and looked up with numpy, window by
window; only pieces that the memo does not hold reach a tokenizer.

A unit is a run of white space and the run of other characters after it: no token crosses from a
character that is not white space to one that is, and what a unit gives does not depend on its
neighbours. A unit of ASCII characters and Latin-1 letters is cut further, where letters, digits
and signs meet. Units with other characters, apostrophes or the beginning of an added token stay
whole. So a long text never reaches a tokenizer in one piece unless it has no white space.

The memo keeps pieces of up to ``LIMIT`` bytes under 64-bit hashes, in arrays: its size is bounded
in entries and in ids, and longer pieces are turned anew each time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from veraz.llm.words import _BASE, _SPACE, mix

#: Bytes of text that are cut at a time, and of texts that are handed on together (a longer text: by itself).
WINDOW, SLICE = 1 << 20, 2 << 20
#: Longest pieces, in bytes, that are remembered; entries and values that a memo holds at most between windows.
LIMIT, ENTRIES, VALUES = 48, 1 << 18, 2 << 20
LETTER, DIGIT, SIGN = 1, 2, 3


def _kinds() -> np.ndarray:
    kind = np.full(256, SIGN, np.uint8)
    kind[_SPACE] = 0
    kind[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = LETTER
    kind[ord("0") : ord("9") + 1] = DIGIT
    return kind


_KINDS = _kinds()
#: The low bytes of a little-endian word.
_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column without nulls, and where each value begins (one more at the end)."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def sized(batches: Iterator[pa.RecordBatch], column: int, limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The rows in slices of at most ``limit`` bytes in a column, or of one row."""
    for batch in batches:
        offsets = bytes_of(batch.column(column))[1]
        at = 0
        while at < batch.num_rows:
            end = max(int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1, at + 1)
            yield batch.slice(at, end - at)
            at = end


def joined(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A binary or string column from its bytes and the length of each value."""
    offsets = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=offsets[1:])
    if offsets[-1] > np.iinfo(np.int32).max:
        raise ValueError("more than 2 GB in one batch")
    return pa.Array.from_buffers(kind, len(counts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values).view(np.uint8))])


def spread(offsets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """offset, offset + 1, ... for each length, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(offsets - (ends - lengths), lengths) + np.arange(total)


def _white_space(data: np.ndarray) -> np.ndarray:
    """Which bytes are white space: that of ASCII, U+0085, U+00A0, U+1680, U+2000 to U+200A, U+2028, U+2029, U+202F, U+205F and U+3000."""
    space = _SPACE[data]
    if not (data >= 0x80).any():
        return space
    at = np.flatnonzero((data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3)))
    a, b, c = (data[np.minimum(at + k, len(data) - 1)] for k in range(3))
    two = (at + 1 < len(data)) & (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
    three = (at + 2 < len(data)) & (((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))) | ((a == 0xE2) & (b == 0x81) & (c == 0x9F)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80)))
    space[at[two]] = space[at[two] + 1] = True
    for k in range(3):
        space[at[three] + k] = True
    return space


def _windows(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges that end where a unit does: at the end of a text or before white space after something else."""
    at, n = 0, len(data)
    while at < n:
        reach = size
        while True:
            end = min(at + reach, n)
            if end == n:
                break
            space = _white_space(data[at:end])
            ends = np.flatnonzero(space[1:] & ~space[:-1])
            text = int(offsets[np.searchsorted(offsets, end, side="right") - 1])
            found = max(at + 1 + int(ends[-1]) if len(ends) else at, text)
            if found > at:
                end = found
                break
            reach *= 2
        yield at, end
        at = end


class Cutter:
    """Where the pieces of a tokenizer begin and end.

    ``spaced``: pieces carry the white space before them, a single space with what follows (byte-level
    tokenizers); otherwise white space is dropped. ``single_digits``: each digit is a piece. Added
    tokens must not hold white space.
    """

    def __init__(self, spaced: bool, single_digits: bool, added: list[str] = ()):
        if any(not t or t.split() != [t] for t in added):
            raise ValueError("added tokens with white space are not supported")
        self.spaced, self.single_digits = spaced, single_digits
        self.heads = {t.encode()[:2] for t in added}

    def _hard(self, data: np.ndarray, space: np.ndarray, wide: bool) -> np.ndarray:
        """Bytes whose units stay whole."""
        hard = data == ord("'")
        for head in self.heads:
            hit = data == head[0]
            if len(head) > 1:
                hit[:-1] &= data[1:] == head[1]
                hit[-1] = False
            hard |= hit
        if wide:
            high = data >= 0x80
            lead = data[:-1] == 0xC3
            letter = lead & (data[1:] != 0x97) & (data[1:] != 0xB7)
            high[:-1] &= ~letter
            high[1:] &= ~letter
            hard |= high
            if not self.spaced:
                hard &= ~space
        return hard

    def cut(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Beginnings and ends of the pieces of texts that begin at ``offsets`` (the last: the end of the data)."""
        n = len(data)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        space, kind = _white_space(data), _KINDS[data]
        wide = bool((data >= 0x80).any())
        if wide:
            kind[space] = 0
        new = np.zeros(n + 1, bool)
        new[offsets] = True
        change = np.zeros(n, bool)
        np.not_equal(kind[1:], kind[:-1], out=change[1:])
        if self.spaced:
            unit = space.copy()
            unit[1:] &= ~space[:-1]
            unit |= new[:n]
            inner = change
            inner[1:] &= space[1:] | (data[:-1] != 0x20)  # a single space goes with what follows
            inner[1:-1] |= space[1:-1] & space[:-2] & ~space[2:] & ~new[2:n]  # the last of a run stands alone, or goes with what follows
        else:
            unit = ~space
            unit[1:] &= space[:-1] | new[1:n]
            inner = change & ~space
        if self.single_digits:
            inner |= kind == DIGIT
        hard = np.flatnonzero(self._hard(data, space, wide))
        if len(hard):
            begins = np.flatnonzero(unit)
            whole = np.unique(np.searchsorted(begins, hard, side="right") - 1)
            inside = np.zeros(n + 1, np.int8)
            inside[begins[whole]] += 1
            inside[np.append(begins, n)[whole + 1]] -= 1
            inner &= np.cumsum(inside[:n], dtype=np.int8) == 0
        edge = unit | inner | new[:n]
        if not self.spaced:
            edge[1:] |= space[1:] & ~space[:-1]
        begin = np.flatnonzero(edge)
        end = np.append(begin[1:], n)
        if not self.spaced:
            shown = ~space[begin]
            begin, end = begin[shown], end[shown]
        return begin, end


def hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of pieces of up to ``LIMIT`` bytes, eight bytes at a time. ``data`` has eight bytes more than the pieces."""
    words = np.lib.stride_tricks.sliding_window_view(data, 8)
    length = end - begin
    h = words[begin].view("<u8").ravel() & _LOW[np.minimum(length, 8)]
    h = mix(h + length.astype(np.uint64) * np.uint64(_BASE))
    more = np.flatnonzero(length > 8)
    for j in range(8, LIMIT, 8):
        if not len(more):
            break
        w = words[begin[more] + j].view("<u8").ravel() & _LOW[np.minimum(length[more] - j, 8)]
        h[more] = mix(h[more] * np.uint64(_BASE) + w)
        more = more[length[more] > j + 8]
    return h


class PieceMemo:
    """What ``make`` gives for pieces (a list of byte strings -> how many values each has, and all
    values or None), remembered in arrays. Old entries go when the bounds are passed."""

    def __init__(self, cutter: Cutter, make: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray | None]], entries: int = ENTRIES, values: int = VALUES, window: int = WINDOW):
        self.cutter, self.make, self.max_entries, self.max_values, self.window = cutter, make, entries, values, window
        self.used, self.now = 0, 0
        self.keys, self.begin, self.count, self.seen = np.zeros(1024, np.uint64), np.zeros(1024, np.int64), np.zeros(1024, np.int32), np.zeros(1024, np.int32)
        self.values, self.filled = np.zeros(4096, np.uint32), 0
        self._empty(11)

    def _empty(self, bits: int) -> None:
        self.bits, self.slots = bits, np.full(1 << bits, -1, np.int32)

    def _find(self, h: np.ndarray) -> np.ndarray:
        """The entries of hashes, -1 where there is none."""
        at = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        found = self.slots[at]
        wrong = np.flatnonzero((found >= 0) & (self.keys[found] != h))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & ((1 << self.bits) - 1)
            found[wrong] = again = self.slots[at[wrong]]
            wrong = wrong[(again >= 0) & (self.keys[again] != h[wrong])]
        return found

    def _place(self, entries: np.ndarray) -> None:
        """Puts entries with distinct hashes, none of them there yet, into free slots."""
        at = (self.keys[entries] >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(entries):
            free = self.slots[at] < 0
            self.slots[at[free]] = entries[free]
            left = self.slots[at] != entries
            entries, at = entries[left], (at[left] + 1) & ((1 << self.bits) - 1)

    def _add(self, pieces: list[bytes], h: np.ndarray | None) -> np.ndarray:
        """New entries; those without hashes are not found again."""
        counts, values = self.make(pieces)
        first, n = self.used, len(pieces)
        self.used += n
        if self.used > len(self.keys):
            size = max(self.used, 2 * len(self.keys))
            self.keys, self.begin, self.count, self.seen = (np.concatenate([x, np.zeros(size - len(x), x.dtype)]) for x in (self.keys, self.begin, self.count, self.seen))
        new = slice(first, self.used)
        self.count[new] = counts
        self.begin[new] = self.filled + np.cumsum(counts) - counts
        if values is not None:
            if self.filled + len(values) > len(self.values):
                more = max(self.filled + len(values), 2 * len(self.values)) - len(self.values)
                self.values = np.concatenate([self.values, np.zeros(more, np.uint32)])
            self.values[self.filled : self.filled + len(values)] = values
            self.filled += len(values)
        self.seen[new] = self.now if h is not None else -1
        entries = np.arange(first, self.used, dtype=np.int32)
        if h is not None:
            self.keys[new] = h
            if 2 * self.used > 1 << self.bits:
                self._empty((2 * self.used).bit_length() + 1)
                self._place(np.flatnonzero(self.seen[: self.used] >= 0).astype(np.int32))
            else:
                self._place(entries)
        return entries

    def _shrink(self) -> None:
        """Keeps the entries seen last, up to half of the bounds."""
        if self.used <= self.max_entries and self.filled <= self.max_values:
            return
        latest = np.argsort(-self.seen[: self.used], kind="stable")
        latest = latest[: np.count_nonzero(self.seen[: self.used] >= 0)][: self.max_entries // 2]
        if self.filled:
            latest = latest[np.cumsum(self.count[latest]) <= self.max_values // 2]
            values = self.values[spread(self.begin[latest], self.count[latest])]
            self.values, self.filled = values, len(values)
        self.used = len(latest)
        room = np.append(latest, np.zeros(1024, latest.dtype))
        self.keys, self.count, self.seen = self.keys[room], self.count[room], self.seen[room]
        self.begin = np.cumsum(self.count, dtype=np.int64) - self.count
        self._empty(max(11, (2 * self.used).bit_length() + 1))
        self._place(np.arange(self.used, dtype=np.int32))

    def _entries(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The entries of pieces, made where there are none."""
        self.now += 1
        raw = data.tobytes()
        found = np.empty(len(begin), np.int32)
        long = np.flatnonzero(end - begin > LIMIT)
        short = np.flatnonzero(end - begin <= LIMIT) if len(long) else slice(None)
        b, e = begin[short], end[short]
        h = hashes(np.append(data, np.zeros(8, np.uint8)), b, e)
        at = self._find(h)
        missing = np.flatnonzero(at < 0)
        if len(missing):
            keys, first, which = np.unique(h[missing], return_index=True, return_inverse=True)
            first = missing[first]
            made = self._add([raw[i:j] for i, j in zip(b[first].tolist(), e[first].tolist(), strict=True)], keys)
            at[missing] = made[which]
        self.seen[at] = self.now
        found[short] = at
        if len(long):
            found[long] = self._add([raw[i:j] for i, j in zip(begin[long].tolist(), end[long].tolist(), strict=True)], None)
        return found

    def turn(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many values each text gives, and all values in order (none where ``make`` gives only counts)."""
        counts, out = np.zeros(len(offsets) - 1, np.int64), []
        for lo, hi in _windows(data, offsets, self.window):
            part = data[lo:hi]
            i, j = np.searchsorted(offsets, [lo, hi])
            own = offsets[i : j + 1] if j < len(offsets) and offsets[j] == hi else np.append(offsets[i:j], hi)
            begin, end = self.cutter.cut(part, np.unique(np.concatenate([[lo], own])) - lo)
            at = self._entries(part, begin, end)
            n = self.count[at].astype(np.int64)
            text = np.searchsorted(offsets, begin + lo, side="right") - 1
            counts += np.bincount(text, weights=n, minlength=len(counts)).astype(np.int64)
            if self.filled:
                out.append(self.values[spread(self.begin[at], n)])
            self._shrink()
        return counts, np.concatenate(out) if out else np.zeros(0, np.uint32)
