"""Many pairwise alignments at once: one dynamic programme over a batch, moves as bits, one traceback for all pairs."""

from __future__ import annotations

import numpy as np

MATCH, MISMATCH = 1, -1
#: Bytes of moves that one batch may hold; a larger pair is a batch by itself.
CELLS = 1 << 24
_NONE = np.int32(-(10**8))
_DIAGONAL, _DOWN, _DOWN_OPENED, _ALONG_OPENED = 1, 2, 4, 8


def _matrix(texts: list[bytes], width: int, pad: int) -> np.ndarray:
    out = np.full((len(texts), width), pad, np.uint8)
    out[np.arange(width) < np.fromiter(map(len, texts), np.int64, len(texts))[:, None]] = np.frombuffer(b"".join(texts), np.uint8)
    return out


def _fill(a: list[bytes], b: list[bytes], gap_open: int, gap_extend: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Moves of every cell, rows x pairs x columns, and where each pair's best path ends."""
    n, m = max(map(len, a)), max(map(len, b))
    pairs, columns = np.arange(len(a)), np.arange(m + 1)
    lengths, widths = (np.fromiter(map(len, s), np.int64, len(s)) for s in (a, b))
    x, y = _matrix(a, n, 1), _matrix(b, m, 2)
    first, ramp = gap_open + gap_extend, (columns * gap_extend).astype(np.int32)
    score, down = np.zeros((len(a), m + 1), np.int32), np.full((len(a), m + 1), _NONE, np.int32)
    last_row, last_column = np.zeros((len(a), m + 1), np.int32), np.full((len(a), n + 1), _NONE, np.int32)
    last_column[:, 0] = 0
    moves = np.zeros((n + 1, len(a), m + 1), np.uint8)
    row, along = np.zeros_like(score), np.full_like(score, _NONE)
    for i in range(1, n + 1):
        opened = score - first
        down = np.maximum(down - gap_extend, opened)
        down[:, 0] = _NONE
        diagonal = score[:, :-1] + np.where(y == x[:, i - 1 : i], np.int32(MATCH), np.int32(MISMATCH))
        row[:, 0] = 0
        row[:, 1:] = np.maximum(down[:, 1:], diagonal)
        along[:, 1:] = np.maximum.accumulate(row + ramp, axis=1)[:, :-1] - ramp[1:] - gap_open
        score = np.maximum(row, along)
        here = moves[i]
        here |= (down == opened).astype(np.uint8) * _DOWN_OPENED
        here |= (score == down).astype(np.uint8) * _DOWN
        here[:, 1:] |= (score[:, 1:] == diagonal).astype(np.uint8) * _DIAGONAL
        here[:, 1:] |= (along[:, 1:] == score[:, :-1] - first).astype(np.uint8) * _ALONG_OPENED
        ends = lengths == i
        last_row[ends] = score[ends]
        inside = lengths >= i
        last_column[inside, i] = score[pairs[inside], widths[inside]]
    last_row[columns > widths[:, None]] = _NONE
    by_row = last_row.max(axis=1) >= last_column.max(axis=1)
    return moves, np.where(by_row, lengths, last_column.argmax(axis=1)), np.where(by_row, last_row.argmax(axis=1), widths)


def _steps(moves: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All paths backwards at once: steps x pairs (1 both, 2 only a, 3 only b, 0 ended), and where each path begins."""
    i, j, gap = i.copy(), j.copy(), np.zeros(len(i), np.int8)
    out = []
    active = np.flatnonzero((i > 0) & (j > 0))
    while len(active):
        m, g = moves[i[active], active, j[active]], gap[active]
        both = (g == 0) & (m & _DIAGONAL > 0)
        g = np.where((g == 0) & ~both, np.where(m & _DOWN > 0, 1, 2), g)
        down, along = ~both & (g == 1), ~both & (g == 2)
        gap[active] = np.where((down & (m & _DOWN_OPENED > 0)) | (along & (m & _ALONG_OPENED > 0)), 0, g)
        i[active] -= both | down
        j[active] -= both | along
        step = np.zeros(len(i), np.int8)
        step[active] = np.where(both, 1, np.where(down, 2, 3))
        out.append(step)
        active = active[(i[active] > 0) & (j[active] > 0)]
    return np.array(out, np.int8).reshape(-1, len(i)), i, j


def _spelled(text: bytes, begin: int, end: int, has: np.ndarray) -> bytes:
    out = np.full(len(has), 45, np.uint8)
    out[has] = np.frombuffer(text, np.uint8)[begin:end]
    return out.tobytes()


def align_batch(a: list[str], b: list[str], gap_open: int = 0, gap_extend: int = 2, cells: int = CELLS) -> list[tuple[str, str]]:
    """Global alignments of ``a[i]`` with ``b[i]``, gaps at the ends free: what ``align.align_pair`` gives for each pair.

    Pairs are batched by length, so that a batch's moves fit in ``cells`` bytes.
    """
    out: list = [None] * len(a)
    x, y = [s.encode() for s in a], [s.encode() for s in b]
    order = sorted(range(len(a)), key=lambda p: (len(x[p]), len(y[p])))
    start = 0
    while start < len(order):
        stop, n, m = start, 0, 0
        while stop < len(order):
            n2, m2 = max(n, len(x[order[stop]])), max(m, len(y[order[stop]]))
            if stop > start and (n2 + 1) * (m2 + 1) * (stop + 1 - start) > cells:
                break
            n, m, stop = n2, m2, stop + 1
        some = order[start:stop]
        sa, sb = [x[p] for p in some], [y[p] for p in some]
        moves, i, j = _fill(sa, sb, gap_open, gap_extend)
        steps, i0, j0 = _steps(moves, i, j)
        for p, (name, s, t) in enumerate(zip(some, sa, sb, strict=True)):
            path = steps[::-1, p]
            path = path[path > 0]
            ib, jb, ie, je = int(i0[p]), int(j0[p]), int(i[p]), int(j[p])
            mine, other = _spelled(s, ib, ie, path != 3), _spelled(t, jb, je, path != 2)
            out[name] = (
                (b"-" * jb + s[:ib] + mine + b"-" * (len(t) - je) + s[ie:]).decode(),
                (t[:jb] + b"-" * ib + other + t[je:] + b"-" * (len(s) - ie)).decode(),
            )
        start = stop
    return out


def banded_identities(rows: np.ndarray, codes: np.ndarray, band: int) -> np.ndarray:
    """Of each row (sequences of one length) with a sequence: matches of the best alignment with at most ``band`` gaps to either side, over the shorter length."""
    width = 2 * band + 1
    best = np.zeros((len(rows), width), np.int32)
    shifted = np.zeros_like(best)
    for i in range(rows.shape[1]):
        j = i + np.arange(width) - band
        ok = (j >= 0) & (j < len(codes))
        shifted[:, :-1] = best[:, 1:]
        same = np.zeros_like(best)
        same[:, ok] = rows[:, i : i + 1] == codes[j[ok]]
        best = np.maximum.accumulate(np.maximum(best + same, shifted), axis=1)
    return best.max(axis=1) / max(1, min(rows.shape[1], len(codes)))
