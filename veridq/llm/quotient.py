"""Counting quotient filter over wide integer keys, as a compact immutable table.

A key of K bits is a list of uint64 limbs (one up to 64 bits).  ``permute`` mixes it
invertibly (a Feistel network whose halves are the limbs or the parts of one), so that
equal keys stay equal, different ones stay different, and the top bits are even.  The
permuted key is cut into a quotient, which places the entry, and the remainder, which is
kept in full: counts are exact and keys come back by ``restore``.

A filter holds its entries in order of the permuted keys: a bit for each occupied quotient,
a bit for each end of a run (the entries of one quotient), the remainders, and counters of
one byte that go over into eight.  Sorted filters merge by one pass over their entries.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
ROUNDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)


def widths(bits: int) -> list[int]:
    """Bits of each limb of a key of ``bits`` bits."""
    k = -(-bits // 64)
    return [bits // k + (i < bits % k) for i in range(k)]


def pack(ids: list[np.ndarray], bits: int) -> list[np.ndarray]:
    """Limbs of the keys made of the columns ``ids``, ``bits`` bits each, first one on top."""
    total = bits * len(ids)
    out, below = [], total
    for w in widths(total):
        below -= w  # bits under this limb
        limb = np.zeros(len(ids[0]), U)
        for i, c in enumerate(ids):
            at = bits * (len(ids) - 1 - i) - below
            if -bits < at < w:
                limb |= (c.astype(U) << U(at) if at >= 0 else c.astype(U) >> U(-at)) & _mask(w)
        out.append(limb)
    return out


def unpack(limbs: list[np.ndarray], bits: int, m: int) -> list[np.ndarray]:
    total = bits * m
    cols = [np.zeros(len(limbs[0]), U) for _ in range(m)]
    below = total
    for w, limb in zip(widths(total), limbs, strict=True):
        below -= w
        for i in range(m):
            at = bits * (m - 1 - i) - below
            if -bits < at < w:
                cols[i] |= (limb >> U(at) if at >= 0 else limb << U(-at)) & _mask(bits)
    return cols


def _mask(w: int) -> U:
    return U((1 << w) - 1)


def _mix(x: np.ndarray, c: int, w: int) -> np.ndarray:
    """``w`` bits of a hash of ``x``."""
    if not w:
        return np.zeros_like(x)
    x = (x + U(c)) * U(0xFF51AFD7ED558CCD)
    x ^= x >> U(33)
    x *= U(0xC4CEB9FE1A85EC53)
    x ^= x >> U(29)
    return x >> U(64 - w)


def _halves(limbs: list[np.ndarray], bits: int) -> tuple[list[np.ndarray], list[int]]:
    if len(limbs) > 1:
        return [x.copy() for x in limbs], widths(bits)
    low = bits // 2
    return [limbs[0] >> U(low), limbs[0] & _mask(low)], [bits - low, low]


def _whole(parts: list[np.ndarray], sizes: list[int], bits: int) -> list[np.ndarray]:
    return parts if bits > 64 else [(parts[0] << U(sizes[1])) | parts[1]]


def _steps(parts: list[np.ndarray], sizes: list[int], steps) -> None:
    for r, i in steps:
        rest = np.full(len(parts[0]), U(ROUNDS[r]))
        for j, x in enumerate(parts):
            if j != i:
                rest = rest * U(0x9FB21C651E98DF25) + x
        parts[i] ^= _mix(rest, ROUNDS[r] + i, sizes[i])


def permute(limbs: list[np.ndarray], bits: int) -> list[np.ndarray]:
    parts, sizes = _halves(limbs, bits)
    steps = [(r, i) for r in range(len(ROUNDS)) for i in range(len(parts) - 1, -1, -1)]
    _steps(parts, sizes, steps)
    return _whole(parts, sizes, bits)


def restore(limbs: list[np.ndarray], bits: int) -> list[np.ndarray]:
    parts, sizes = _halves(limbs, bits)
    steps = [(r, i) for r in range(len(ROUNDS)) for i in range(len(parts) - 1, -1, -1)]
    _steps(parts, sizes, steps[::-1])
    return _whole(parts, sizes, bits)


def order(limbs: list[np.ndarray]) -> np.ndarray:
    return np.argsort(limbs[0], kind="stable") if len(limbs) == 1 else np.lexsort(limbs[::-1])


def starts(limbs: list[np.ndarray]) -> np.ndarray:
    """Whether each of the sorted keys differs from the one before."""
    new = np.zeros(len(limbs[0]), bool)
    new[:1] = True
    for x in limbs:
        new[1:] |= x[1:] != x[:-1]
    return new


def tally(limbs: list[np.ndarray], counts: np.ndarray | None = None):
    """Distinct keys in order, their summed counts, and the place of every key among them."""
    at = order(limbs)
    limbs = [x[at] for x in limbs]
    new = starts(limbs)
    first = np.flatnonzero(new)
    n = np.diff(np.r_[first, len(at)]) if counts is None else np.add.reduceat(counts[at], first) if len(first) else counts[:0]
    place = np.empty(len(at), np.int64)
    place[at] = np.cumsum(new) - 1
    return [x[first] for x in limbs], n.astype(np.int64), place


# ---- the filter as bytes -------------------------------------------------------


def encode(limbs: list[np.ndarray], counts: np.ndarray, bits: int, head: int = 0, range_: int = 0) -> bytes:
    """Filter of sorted distinct permuted keys that all start with the ``head`` bits ``range_``."""
    n, top = len(counts), widths(bits)[0]
    q = min(max(n - 1, 0).bit_length(), top - head)
    rest = top - head - q
    quotient = (limbs[0] >> U(rest) if rest < 64 else np.zeros(n, U)) & _mask(q)
    new = np.r_[True, quotient[1:] != quotient[:-1]][:n]
    occupied = np.zeros(1 << q, np.uint8)
    occupied[quotient.astype(np.int64)] = 1
    run_end = np.r_[new[1:], True][:n]
    parts = [np.array([n, q, bits, head, range_, len(limbs)], np.int64).tobytes(), np.packbits(occupied).tobytes(), np.packbits(run_end).tobytes()]
    for i, (w, x) in enumerate(zip(widths(bits), limbs, strict=True)):
        size = -(-(rest if i == 0 else w) // 8)
        parts.append(np.ascontiguousarray((x & _mask(rest) if i == 0 else x).astype("<u8").view(np.uint8).reshape(n, 8)[:, :size]).tobytes())
    parts += [np.minimum(counts, 255).astype(np.uint8).tobytes(), counts[counts >= 255].astype("<i8").tobytes()]
    return b"".join(parts)


def decode(raw: bytes) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted permuted keys and counts of a filter."""
    n, q, bits, head, range_, k = (int(v) for v in np.frombuffer(raw, np.int64, 6))
    at = 48

    def take(size: int) -> np.ndarray:
        nonlocal at
        at += size
        return np.frombuffer(raw, np.uint8, size, at - size)

    occupied = np.flatnonzero(np.unpackbits(take(-(-(1 << q) // 8)), count=1 << q)).astype(U)
    run_end = np.unpackbits(take(-(-n // 8)), count=n)
    rest = widths(bits)[0] - head - q
    limbs = []
    for i, w in enumerate(widths(bits)):
        size = -(-(rest if i == 0 else w) // 8)
        whole = np.zeros((n, 8), np.uint8)
        whole[:, :size] = take(n * size).reshape(n, size)
        limbs.append(whole.view("<u8").reshape(n).astype(U))
    if n:
        run = np.r_[0, np.cumsum(run_end[:-1], dtype=np.int64)]
        high = occupied[run] | (U(range_) << U(q) if q < 64 else U(0))
        limbs[0] = limbs[0] | (high << U(rest) if rest < 64 else U(0))
    counts = take(n).astype(np.int64)
    over = counts == 255
    counts[over] = np.frombuffer(raw, "<i8", int(over.sum()), at)
    return limbs, counts


def bits_of(raw: bytes) -> int:
    """Bits of the keys of a filter."""
    return int(np.frombuffer(raw, np.int64, 6)[2])


def merge(filters: list[bytes]) -> tuple[list[np.ndarray], np.ndarray, list[np.ndarray]]:
    """Keys and summed counts of several filters, and where each one's entries are among them."""
    each = [decode(f) for f in filters]
    limbs = [np.concatenate(x) for x in zip(*(e[0] for e in each), strict=True)]
    keys, counts, place = tally(limbs, np.concatenate([e[1] for e in each]))
    return keys, counts, np.split(place, np.cumsum([len(e[1]) for e in each])[:-1])


def merge_pieces(filters: list[bytes], size: int = 1 << 18):
    """``merge`` of the filters of one range, about ``size`` entries at a time in order of the
    keys: nothing but the decoded filters is held whole."""
    each = [decode(f) for f in filters]
    _, _, bits, head, range_, _ = (int(v) for v in np.frombuffer(filters[0], np.int64, 6))
    rest = widths(bits)[0] - head
    pieces = min(max(1, -(-sum(len(c) for _, c in each) // size)), 1 << rest)
    bounds = np.array([(range_ << rest) + (k << rest) // pieces for k in range(1, pieces)], U)
    ends = [np.r_[0, np.searchsorted(keys[0], bounds), len(counts)] for keys, counts in each]
    for k in range(pieces):
        part = [([x[e[k] : e[k + 1]] for x in keys], counts[e[k] : e[k + 1]]) for (keys, counts), e in zip(each, ends, strict=True)]
        limbs = [np.concatenate(x) for x in zip(*(p[0] for p in part), strict=True)]
        keys, counts, place = tally(limbs, np.concatenate([p[1] for p in part]))
        yield keys, counts, np.split(place, np.cumsum([len(p[1]) for p in part])[:-1])
