"""Similarity of many pairs of names at once, each pair a lane of 64-bit words.

The longest common subsequence is counted one character of the second name at a time, for all lanes together: a
lane has a bit for each character of its first name, in as many words as the longest needs, with carries between them.  Results
equal :func:`matching.similarity_of` to the last bit.
"""

from __future__ import annotations

import itertools

import numpy as np

#: Characters of a normalized name, each with its number; 0 is for what fills up a shorter name's row.
SYMBOLS = " abcdefghijklmnopqrstuvwxyz0123456789"
_NUMBER = np.zeros(256, dtype=np.uint8)
_NUMBER[np.frombuffer(SYMBOLS.encode(), dtype=np.uint8)] = np.arange(1, len(SYMBOLS) + 1)
KINDS = len(SYMBOLS) + 1
#: Bits of a word.
WORD = 64
#: Characters of windows that are counted together; a pair with more is compared on its own.
CELLS = 1 << 20


def coded(names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(names, longest) numbers of characters, rows filled up with 0, and the names' lengths."""
    lengths = np.array([len(x) for x in names], dtype=np.int64)
    width = int(lengths.max(initial=0)) or 1
    raw = np.array([x.encode("ascii") for x in names], dtype=f"S{width}") if names else np.zeros(0, dtype="S1")
    return _NUMBER[raw.view(np.uint8).reshape(len(names), width)], lengths


def _places(codes: np.ndarray) -> np.ndarray:
    """(words, names * KINDS): the bits at which each character stands in each name."""
    words = -(-codes.shape[1] // WORD)
    table = np.zeros((words, len(codes), KINDS), dtype=np.uint64)
    rows = np.arange(len(codes))
    for i in range(codes.shape[1]):
        table[i // WORD, rows, codes[:, i]] |= np.uint64(1 << i % WORD)
    table[:, :, 0] = 0
    return table.reshape(words, -1)


def common_lengths(table: np.ndarray, of: np.ndarray, lengths: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of name ``of[k]`` (its places in ``table``, its length ``lengths[k]``) and the coded row ``other[k]``."""
    ones = np.uint64(2**64 - 1)
    full = []
    for w in range(len(table)):
        bits = np.clip(lengths - w * WORD, 0, WORD)
        full.append(np.where(bits == WORD, ones, (np.uint64(1) << np.minimum(bits, WORD - 1).astype(np.uint64)) - np.uint64(1)))
    rows = [x.copy() for x in full]
    start = of.astype(np.int64) * KINDS
    for j in range(other.shape[1]):
        at = start + other[:, j]
        carry = None
        for w, places in enumerate(table):
            row = rows[w]
            hit = row & places[at]
            total = row + hit
            over = total < row
            if carry is not None:
                total += carry
                over |= (total == 0) & (carry == 1)
            rows[w] = total | (row - hit)
            carry = over.astype(np.uint64) if len(table) > 1 else None
    return lengths - sum(np.bitwise_count(r & f).astype(np.int64) for r, f in zip(rows, full, strict=True))


def _batches(sizes: list[int], order: list[int]):
    """``order`` in parts whose sizes add up to at most CELLS, but for single ones."""
    part, total = [], 0
    for k in order:
        if part and total + sizes[k] > CELLS:
            yield part
            part, total = [], 0
        part.append(k)
        total += sizes[k]
    if part:
        yield part


def ratios(a: list[str], b: list[str]) -> np.ndarray:
    """200 times the common length over both lengths, 100 for two empty names."""
    out = np.full(len(a), 100.0)
    pairs = [sorted(p, key=len) for p in zip(a, b, strict=True)]
    order = sorted((k for k, (x, y) in enumerate(pairs) if y), key=lambda k: len(pairs[k][1]))
    for part in _batches([len(y) for _, y in pairs], order):
        first, lengths = coded([pairs[k][0] for k in part])
        second, sizes = coded([pairs[k][1] for k in part])
        out[part] = 200.0 * common_lengths(_places(first), np.arange(len(part)), lengths, second) / (lengths + sizes)
    return out


def _windows(longer: np.ndarray, sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(windows, width) numbers and (windows,) lengths: for each coded row the same number of windows, those cut off at its ends included; those beyond its end are empty."""
    padded = np.pad(longer, ((0, 0), (width - 1, width - 1)))
    rows = np.lib.stride_tricks.sliding_window_view(padded, width, axis=1)
    start = np.arange(rows.shape[1]) + 1 - width
    inside = np.clip(np.minimum(start + width, sizes[:, None]) - np.maximum(start, 0), 0, width)
    return rows.reshape(-1, width), inside.ravel()


def partial_ratios(a: list[str], b: list[str]) -> np.ndarray:
    """The best ratio of the shorter name with a window of the longer one, for each pair of names that aren't empty."""
    from .matching import partial_ratio

    out = np.zeros(len(a))
    pairs = [sorted(p, key=len) for p in zip(a, b, strict=True)]
    asked = [(k, x, y) for k, (x, y) in enumerate(pairs)] + [(k, y, x) for k, (x, y) in enumerate(pairs) if len(x) == len(y)]
    cells = [len(x) * (len(x) + len(y)) for _, x, y in asked]
    for i, (k, x, y) in enumerate(asked):
        if cells[i] > CELLS:
            out[k] = partial_ratio(x, y)
    # equal widths and alike lengths together, so that rows are hardly filled up
    order = sorted((i for i, c in enumerate(cells) if c <= CELLS), key=lambda i: (len(asked[i][1]), len(asked[i][2])))
    for width, same in itertools.groupby(order, key=lambda i: len(asked[i][1])):
        for part in _batches(cells, same):
            which, short, long = zip(*(asked[i] for i in part), strict=True)
            others, sizes = coded(list(long))
            rows, widths = _windows(others, sizes, width)
            owner = np.repeat(np.arange(len(part)), len(rows) // len(part))
            found = 200.0 * common_lengths(_places(coded(list(short))[0]), owner, np.full(len(rows), width), rows) / (width + widths)
            np.maximum.at(out, np.array(which), found.reshape(len(part), -1).max(1))
    return out


def similarities(a: list[str], b: list[str], least: float | np.ndarray = 0.0, windows: float | np.ndarray = 1.0) -> np.ndarray:
    """0 to 1 for each pair of normalized names; 0 where the words, and a bound of the windows' ratio, put it below ``least``."""
    out = np.zeros(len(a))
    open_ = []
    for k, (x, y) in enumerate(zip(a, b, strict=True)):
        if x and y:
            if x == y:
                out[k] = 1.0
            else:
                open_.append(k)
    sets = np.zeros(len(open_))
    ask: list[tuple[int, str, str]] = []
    for i, k in enumerate(open_):
        x, y = set(a[k].split(" ")), set(b[k].split(" "))
        both, left, right = x & y, x - y, y - x
        same = " ".join(sorted(both))
        if same and (not left or not right):
            sets[i] = 100.0
            continue
        one, two = f"{same} {' '.join(sorted(left))}".strip(), f"{same} {' '.join(sorted(right))}".strip()
        ask.append((i, one, two))
        if same:
            # what stands first in both: the common words are a subsequence of either
            sets[i] = max(200.0 * len(same) / (len(same) + len(one)), 200.0 * len(same) / (len(same) + len(two)))
    if ask:
        which, one, two = zip(*ask, strict=True)
        np.maximum.at(sets, np.array(which), ratios(list(one), list(two)))
    least, windows = (np.broadcast_to(x, len(a))[open_] for x in (least, windows))
    may = np.flatnonzero((sets / 100.0 + windows) / 2 >= least - 1e-9)
    if len(may):
        left = [open_[i] for i in may]
        out[left] = (sets[may] + partial_ratios([a[k] for k in left], [b[k] for k in left])) / 200.0
    return out
