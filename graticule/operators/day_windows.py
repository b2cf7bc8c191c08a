"""Windows around every day of the year, of one series of days, in numpy inside a task.

A series is sorted once.  The sorted window of a day of the year is cut out of that run by filtering it, in two steps: first what
lies near a block of neighbouring days, then the days of each window.  No window is sorted, and each value is looked at a bounded
number of times per block and per window it belongs to.

All windows of a series are one flat array of values, ascending inside each window, and the number of values in each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from ..functions.randoms import uniform_np

BLOCK = 32  # days of the year filtered at once


@dataclass
class Windows:
    values: np.ndarray   # ascending inside each window
    counts: np.ndarray   # one per day of the year

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.counts) - self.counts

    @property
    def rows(self) -> np.ndarray:
        """The window of each value."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def means(self) -> np.ndarray:
        return self._sums(self.values) / np.where(self.counts > 0, self.counts, np.nan)

    def below(self, limit: float) -> np.ndarray:
        return self._sums((self.values < limit).astype(np.int64))

    def _sums(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.counts), values.dtype)
        some = self.counts > 0
        if some.any():
            out[some] = np.add.reduceat(values, self.starts[some])
        return out

    def quantiles(self, levels: np.ndarray) -> np.ndarray:
        """(window, level), interpolated linearly; ``levels`` is one row for all windows or one per window.  NaN for empty windows."""
        last = np.maximum(self.counts - 1, 0)[:, None]
        flat = np.append(self.values, np.nan)
        pos = np.broadcast_to(levels, (len(self.counts), np.shape(levels)[-1])) * last
        low = np.floor(pos).astype(np.int64)
        at = self.starts[:, None]
        a, b = flat[at + low], flat[np.minimum(at + np.minimum(low + 1, last), len(self.values))]
        return np.where(self.counts[:, None] > 0, a + (pos - low) * (b - a), np.nan)


def windows(year: np.ndarray, doy: np.ndarray, x: np.ndarray, n: int, period: tuple[int, int], half: int) -> Windows:
    """The values within ``half`` days of each day 1..``n`` of the year; a NaN is no value.

    Days near the turn of the year also count at its other end (as day ``doy + n`` or ``doy - n``), except where the window would
    be that of a year outside the period.
    """
    first, last = period
    have = ~np.isnan(x)
    year, doy, x = year[have], doy[have].astype(np.int64), x[have]
    late, early = (doy > n - half) & (year < last), (doy <= half) & (year > first)
    day = np.concatenate([doy, doy[late] - n, doy[early] + n])
    value = np.concatenate([x, x[late], x[early]])
    order = np.argsort(value, kind="stable")
    day, value = day[order], value[order]
    out, counts = [], []
    for low in range(1, n + 1, BLOCK):
        high = min(low + BLOCK - 1, n)
        near = (day >= low - half) & (day <= high + half)
        day_near, value_near = day[near], value[near]
        inside = np.abs(day_near - np.arange(low, high + 1)[:, None]) <= half
        counts.append(inside.sum(axis=1))
        out.append(np.broadcast_to(value_near, inside.shape)[inside])
    return Windows(np.concatenate(out), np.concatenate(counts))


def adapted(ref: Windows, sim: Windows, limit: float, cell: int, seed: int) -> Windows:
    """Frequency adaptation of the simulated windows; those where the simulation is not the drier one stay.

    The share of extra dry days, (F_sim(D) - F_ref(D)) / F_sim(D), is taken from the highest dry values and replaced by random values
    in [D, F_ref^-1(F_sim(D))].
    """
    dry, dry_ref = sim.below(limit), ref.below(limit)
    some = (ref.counts > 0) & (sim.counts > 0)
    n_ref = np.where(some, ref.counts, 1)
    # floor((F_sim - F_ref) * n_sim) in integers, so that no rounding decides.
    extra = np.where(some, (dry * ref.counts - dry_ref * sim.counts) // n_ref, 0)
    changed = np.flatnonzero(extra >= 1)
    if not len(changed):
        return sim
    top = ref.quantiles((dry / np.where(some, sim.counts, 1))[:, None])[:, 0]
    top = np.maximum(top, limit)
    more = extra[changed]
    owner = np.repeat(changed, more)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(more) - more, more) + 1
    values = sim.values.copy()
    values[sim.starts[owner] + dry[owner] - extra[owner] + number - 1] = limit + uniform_np(
        seed, np.full(len(owner), cell), owner + 1, number) * (top[owner] - limit)
    # Only the changed windows are sorted again, side by side, filled up with infinities.
    sizes = sim.counts[changed]
    places = np.arange(sizes.max()) < sizes[:, None]
    flat = np.isin(sim.rows, changed)
    table = np.full(places.shape, np.inf)
    table[places] = values[flat]
    table.sort(axis=1)
    values[flat] = table[places]
    return Windows(values, sim.counts)
