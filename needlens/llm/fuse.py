"""Binary fuse filters (Graf and Lemire 2022) over 64-bit keys, in numpy.

A static filter of about 9 bits a key answers "surely absent" or "perhaps
present" (1 in 256 wrong).  Peeling runs in rounds: all cells that hold a single
key are peeled at once, which gives the assignment order.
"""

from __future__ import annotations

import math

import numpy as np


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    x = (x + np.uint64(seed)).astype(np.uint64)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _shape(n: int) -> tuple[int, int]:
    """Segment length and number of start segments for ``n`` keys."""
    n = max(n, 2)
    seg = 1 << min(18, max(2, int(math.floor(math.log(n) / math.log(3.33) + 2.25))))
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(n))
    return seg, max(1, -(-int(round(n * factor)) // seg) - 2)


def _cells(h: np.ndarray, seg: int, starts: int) -> np.ndarray:
    """The three cells of every hash, in three neighbouring segments."""
    first = ((h >> np.uint64(32)) * np.uint64(starts * seg)) >> np.uint64(32)
    mask = np.uint64(seg - 1)
    base = first & ~mask
    b = base + np.uint64(seg) + ((first ^ (h >> np.uint64(18))) & mask)
    c = base + np.uint64(2 * seg) + ((first ^ h) & mask)
    return np.stack([first, b, c], axis=1).astype(np.int64)


def _prints(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> np.uint64(32))) & np.uint64(0xFF)).astype(np.uint8)


def build(keys: np.ndarray) -> dict:
    """Filter of distinct uint64 ``keys``: seed, shape and fingerprint bytes."""
    keys = np.unique(np.asarray(keys, dtype=np.uint64))
    seg, starts = _shape(len(keys))
    size = (starts + 2) * seg
    for seed in range(1, 1001):
        if seed % 20 == 0:  # small sets may need more room
            starts += 1
            size += seg
        h = _mix(keys, seed)
        cells = _cells(h, seg, starts)
        owner = np.repeat(np.arange(len(keys)), 3)
        count = np.bincount(cells.ravel(), minlength=size)
        held = np.zeros(size, np.int64)  # xor of the key numbers in a cell
        np.bitwise_xor.at(held, cells.ravel(), owner)
        rounds, left = [], len(keys)
        while left:
            single = np.flatnonzero(count == 1)
            if not len(single):
                break
            who, at = np.unique(held[single], return_index=True)
            rounds.append((who, single[at]))
            gone = cells[who].ravel()
            np.subtract.at(count, gone, 1)
            np.bitwise_xor.at(held, gone, np.repeat(who, 3))
            left -= len(who)
        if left:
            continue
        prints, cell_print = _prints(h), np.zeros(size, np.uint8)
        for who, own in reversed(rounds):
            x = cell_print[cells[who]]  # the own cell still holds 0
            cell_print[own] = prints[who] ^ x[:, 0] ^ x[:, 1] ^ x[:, 2]
        return {"seed": seed, "seg": seg, "starts": starts, "prints": cell_print.tobytes()}
    raise ValueError("no filter found; are the keys distinct?")


def contains(f: dict, keys: np.ndarray) -> np.ndarray:
    h = _mix(np.asarray(keys, dtype=np.uint64), int(f["seed"]))
    p = np.frombuffer(f["prints"], np.uint8)
    x = p[_cells(h, int(f["seg"]), int(f["starts"]))]
    return (x[:, 0] ^ x[:, 1] ^ x[:, 2]) == _prints(h)
