"""Counting the lattice points of a union of spheres column by column."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Sphere-column entries that are worked on at once.
ENTRIES = 1 << 17


def _runs(spheres: np.ndarray, box: np.ndarray, first: np.ndarray, stop: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
    """(sphere, i, j, lo, hi): the run of points ``(dx^2 + dy^2) + dz^2 <= r^2``
    of every sphere in every column of its block that it touches.

    ``spheres``: x, y, z, r; ``box``: origin and step of x, y and z; ``first`` and
    ``stop``: columns of the block, each a row per sphere. The ends come from a
    square root and are then set by the very comparison that defines the points.
    """
    lows, sizes = [], []
    for d in range(2):
        o, s = box[:, 2 * d], box[:, 2 * d + 1]
        low = np.maximum(first[:, d], np.floor((spheres[:, d] - spheres[:, 3] - o) / s - 1.5).astype(np.int64))
        high = np.minimum(stop[:, d], np.ceil((spheres[:, d] + spheres[:, 3] - o) / s + 1.5).astype(np.int64))
        lows.append(low)
        sizes.append(np.maximum(high - low, 0))
    # First every sphere with each i, then each of those with every j.
    line, i = _spread(lows[0], sizes[0])
    dx = box[line, 0] + box[line, 1] * (i + 0.5) - spheres[line, 0]
    row, j = _spread(lows[1][line], sizes[1][line])
    of = line[row]
    dy = box[of, 2] + box[of, 3] * (j + 0.5) - spheres[of, 1]
    flat, rest = (dx * dx)[row] + dy * dy, (spheres[:, 3] * spheres[:, 3])[of]
    rest -= flat
    some = np.flatnonzero(rest >= 0)
    of, i, j, flat, rest = of[some], i[row[some]], j[some], flat[some], rest[some]
    z, o, s = spheres[of, 2], box[of, 4], box[of, 5]
    half = np.sqrt(rest)
    up, down = (z - half - o) / s - 0.5, (z + half - o) / s - 0.5
    lo, hi = np.ceil(up).astype(np.int64), np.floor(down).astype(np.int64)
    for edge, at, step in ((up, lo, -1), (down, hi, 1)):
        near = np.flatnonzero(np.abs(edge - np.rint(edge)) < 1e-5)  # far more than the root's error
        if len(near):
            q, r2 = at[near], (spheres[:, 3] * spheres[:, 3])[of[near]]

            def inside(q: np.ndarray) -> np.ndarray:
                dz = o[near] + s[near] * (q + 0.5) - z[near]  # noqa: B023
                return flat[near] + dz * dz <= r2  # noqa: B023

            at[near] = np.where(inside(q + step), q + step, np.where(inside(q), q, q - step))
    np.maximum(lo, 0, out=lo)
    np.minimum(hi, n - 1, out=hi)
    real = np.flatnonzero(lo <= hi)
    return of[real], i[real], j[real], lo[real], hi[real]


def _spread(low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every entry repeated ``size`` times, and the numbers from ``low`` on."""
    of = np.repeat(np.arange(len(low)), size)
    return of, np.arange(len(of)) + (low - np.cumsum(size) + size)[of]


def _united(column: np.ndarray, lo: np.ndarray, hi: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
    """Disjoint runs (column, lo, hi) that cover the same points: each run
    without what an earlier run of its column covers."""
    order = np.argsort(column * n + lo, kind="stable")
    column, lo, hi = column[order], lo[order], hi[order]
    # Columns follow each other, so one running maximum serves all of them.
    end = np.maximum.accumulate(column * n + hi) if len(column) else hi
    before = np.concatenate([[-1], end[:-1]]) - column * n
    lo = np.maximum(lo, before + 1)
    new = lo <= hi
    return column[new], lo[new], hi[new]


def _bits(n: int) -> np.ndarray:
    """For each word of 64 points, the bits of its points below 0 .. n."""
    below = np.clip(np.arange(n + 1)[None, :] - 64 * np.arange(-(-n // 64))[:, None], 0, 64)
    return np.array([[(1 << int(k)) - 1 for k in row] for row in below], np.uint64)


def lone_counts(spheres: np.ndarray, group: np.ndarray, box: np.ndarray, first: np.ndarray, stop: np.ndarray,
                n: int) -> np.ndarray:
    """Number of points of each group, which has its block for itself.

    The rows are those of ``_runs``, but ``box``, ``first`` and ``stop`` have one
    per group. A sphere's runs fill a small square of columns; squares of about
    the same size are worked on together, and the runs of a group are united as
    bits of its columns, a word for 64 points. The ends are set as in ``_runs``.
    """
    out = np.zeros(len(box), np.int64)
    low, size = np.empty((2, len(spheres)), np.int64), np.empty((2, len(spheres)), np.int64)
    with np.errstate(invalid="ignore"):
        for d in range(2):
            o, s = box[group, 2 * d], box[group, 2 * d + 1]
            low[d] = np.maximum(first[group, d], np.ceil((spheres[:, d] - spheres[:, 3] - o) / s - 0.51).astype(np.int64))
            size[d] = np.minimum(stop[group, d], np.floor((spheres[:, d] + spheres[:, 3] - o) / s + 0.51).astype(np.int64)) - low[d]
    met = np.flatnonzero((size > 0).all(axis=0) & np.isfinite(spheres).all(axis=1))
    if not len(met):
        return out
    # Groups by their largest square, the spheres of a group together.
    widest = np.zeros(len(box), np.int64)
    np.maximum.at(widest, group[met], size.max(axis=0)[met])
    met = met[np.lexsort((group[met], widest[group[met]]))]
    starts = np.flatnonzero(np.append(True, np.diff(group[met]) != 0))
    ends, names = np.append(starts[1:], len(met)), group[met][starts]
    bits = _bits(n)
    most = max(1, (1 << 19) // (n * n * len(bits)))  # groups united at once: 4 MB
    columns = np.zeros((len(bits), min(most, len(names)), n, n), np.uint64)
    at = 0
    while at < len(names):
        to = at + 1
        while to < len(names) and to - at < most and (ends[to] - starts[at]) * widest[names[to]] ** 2 <= ENTRIES:
            to += 1
        portion = max(1, ENTRIES // int(widest[names[to - 1]]) ** 2)
        for part in range(starts[at], ends[to - 1], portion):
            some = met[part:min(ends[to - 1], part + portion)]
            lo, hi = _square(spheres[some], box[group[some]], low[:, some], size[:, some])
            place = np.searchsorted(ends[at:to], np.arange(part, part + len(some)), side="right")
            squares = list(zip(range(len(some)), place.tolist(), *low[:, some].tolist(), *size[:, some].tolist()))
            for mask, words in zip(bits, columns):
                run = mask.take(hi, mode="clip")
                run ^= mask.take(lo, mode="clip")
                for k, g, i, j, w, h in squares:
                    square = words[g, i:i + w, j:j + h]
                    np.bitwise_or(square, run[k, :w, :h], out=square)
        used = columns[:, :to - at]
        out[names[at:to]] = np.bitwise_count(used).reshape(len(bits), to - at, -1).sum(axis=2, dtype=np.int64).sum(axis=0)
        used[...] = 0
        at = to
    return out


def _square(spheres: np.ndarray, box: np.ndarray, low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lo, stop) of the run of each sphere (first axis) in each column of its
    square; stop is lo where there is none."""
    sides = []
    for d in range(2):
        steps = np.arange(size[d].max())
        delta = box[:, 2 * d, None] + box[:, 2 * d + 1, None] * ((low[d, :, None] + steps) + 0.5) - spheres[:, d, None]
        delta *= delta
        delta[steps >= size[d, :, None]] = np.inf
        sides.append(delta)
    flat = sides[0][:, :, None] + sides[1][:, None, :]
    r2, z, o, s = spheres[:, 3] * spheres[:, 3], spheres[:, 2], box[:, 4], box[:, 5]
    half = r2[:, None, None] - flat
    np.maximum(half, 0.0, out=half)
    np.sqrt(half, out=half)
    half *= (1 / s)[:, None, None]
    middle = ((z - o) / s - 0.5)[:, None, None]
    up, down = middle - half, middle + half
    lo, hi = np.ceil(up), np.floor(down)
    # Both ends are looked at where one may be near a point (far more than the
    # root's error), and where a column misses a sphere whose centre is.
    up -= np.rint(up, out=half)
    down -= np.rint(down, out=half)
    up *= down
    near = np.flatnonzero(np.abs(up, out=up).ravel() < 1e-5)
    if len(near):
        k, across = near // flat[0].size, flat.ravel()[near]
        for at, step in ((lo.reshape(-1), -1), (hi.reshape(-1), 1)):
            q = at[near]

            def inside(q: np.ndarray) -> np.ndarray:
                dz = o[k] + s[k] * (q + 0.5) - z[k]
                return across + dz * dz <= r2[k]

            at[near] = np.where(inside(q + step), q + step, np.where(inside(q), q, q - step))
    hi += 1
    np.maximum(hi, lo, out=hi)
    return lo.astype(np.intp), hi.astype(np.intp)


def column_runs(n: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow over groups of spheres (key, _nb, bx, by, _chunks, origin
    and step of each axis, spheres): a group that has its block for itself
    returns its number of points as one run under negative indices; a chunk of a
    block returns disjoint runs of its columns. Rows are (key, i, j, lo, hi)."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, (blocks, bx, by, chunks) = batch.column(0), [batch[c].to_numpy().astype(np.int64) for c in ("_nb", "bx", "by", "_chunks")]
            boxes = np.stack([batch[f"{k}{c}"].to_numpy() for c in "xyz" for k in "os"], axis=1)
            lists = batch["spheres"]
            spheres = np.asarray(lists.flatten()).reshape(-1, 4)
            sizes = np.diff(lists.offsets.to_numpy()) // 4
            group = np.repeat(np.arange(len(sizes)), sizes)
            first = np.stack([-(-b * n // blocks) for b in (bx, by)], axis=1)
            stop = np.stack([-(-(b + 1) * n // blocks) for b in (bx, by)], axis=1)
            lone = np.flatnonzero(chunks == 1)
            if len(lone):
                mine = np.flatnonzero(chunks[group] == 1)
                place = (np.cumsum(chunks == 1) - 1)[group[mine]]
                points = lone_counts(spheres[mine], place, boxes[lone], first[lone], stop[lone], n)
                yield pa.RecordBatch.from_arrays(
                    [key.take(pa.array(lone)), *[pa.array(x.astype(np.int64)) for x in (
                        -1 - bx[lone], -1 - by[lone], np.zeros(len(lone)), points - 1)]],
                    names=[batch.schema.names[0], "i", "j", "lo", "hi"])
            # The others in portions of about ENTRIES sphere-column entries.
            each = np.ones(len(spheres))
            for d in range(2):
                wide = 2 * spheres[:, 3] / boxes[group, 2 * d + 1] + 3
                each *= np.minimum(wide, (stop - first)[group, d])
            load = np.cumsum(np.bincount(group, each * (chunks[group] > 1), len(sizes)))
            cut = [0, *(np.flatnonzero(np.diff(load // ENTRIES)) + 1).tolist(), len(sizes)]
            for a, b in zip(cut, cut[1:]):
                if (chunks[a:b] > 1).any():
                    yield _portion(batch.schema.names[0], key, slice(a, b), group, spheres, boxes, first, stop, chunks, n)
    return read


def _portion(name, key, part, group, spheres, boxes, first, stop, chunks, n) -> pa.RecordBatch:
    mine = np.arange(*np.searchsorted(group, [part.start, part.stop]))
    mine = mine[chunks[group[mine]] > 1]
    of_group = group[mine]
    of, i, j, lo, hi = _runs(spheres[mine], boxes[of_group], first[of_group], stop[of_group], n)
    column, lo, hi = _united(((of_group[of] - part.start) * n + i) * n + j, lo, hi, n)
    owner, cell = column // (n * n) + part.start, column % (n * n)
    return pa.RecordBatch.from_arrays(
        [key.take(pa.array(owner)), *[pa.array(x.astype(np.int64)) for x in (cell // n, cell % n, lo, hi)]],
        names=[name, "i", "j", "lo", "hi"])
