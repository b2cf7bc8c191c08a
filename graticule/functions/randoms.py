"""Reproducible pseudo-random numbers: the same row gets the same number on every rerun, executor and engine."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, functions as F

# A prime below 2^31, so that a product of two residues fits a 64-bit integer, and two multipliers below it.
_MODULUS = 2_147_483_647
_A, _B = 1_103_515_245, 950_706_376


def _mix_np(x):
    """One round: multiply, fold the upper bits into the lower, multiply again, fold again; plain 64-bit integers."""
    y = (x * _A + 12345) % _MODULUS
    z = ((y ^ y >> 15) * _B) % _MODULUS
    return z ^ z >> 13


def uniform_np(seed: int, *keys: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1), both excluded, from integer arrays and a seed.  Each key is mixed into what came before, so neighbouring
    keys and neighbouring seeds give unrelated numbers."""
    state = np.int64(seed)
    for key in keys:
        state = _mix_np((_mix_np(state) + np.asarray(key, np.int64) % _MODULUS) % _MODULUS)
    return (state + 1) / float(_MODULUS + 2)


def _bound(x: Column, body) -> Column:
    """``body(x)`` with ``x`` computed once, however often ``body`` names it."""
    return F.get(F.transform(F.array(x), body), F.lit(0))


def _mix(x: Column) -> Column:
    """``_mix_np`` as an expression whose length does not grow with the rounds before it."""
    z = _bound(F.pmod(x * _A + 12345, F.lit(_MODULUS)), lambda y: F.pmod(y.bitwiseXOR(F.shiftright(y, 15)) * _B, F.lit(_MODULUS)))
    return _bound(z, lambda v: v.bitwiseXOR(F.shiftright(v, 13)))


def uniform(a: Column, b: Column, seed: int, c: Column | None = None) -> Column:
    """``uniform_np`` of columns."""
    keys = (a, b) if c is None else (a, b, c)
    mixed = F.lit(int(_mix_np(int(seed)))).cast("long")
    for i, key in enumerate(keys):
        mixed = _mix(F.pmod(mixed + F.pmod(key.cast("long"), F.lit(_MODULUS)), F.lit(_MODULUS)))
        if i < len(keys) - 1:
            mixed = _mix(mixed)
    return (mixed + 1) / F.lit(float(_MODULUS + 2))
