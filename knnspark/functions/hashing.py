"""Hash functions: md5-derived uniforms, the LSH grid hash (V8, V11, L2, L3) and the hypercube
coin flip (H3, H4).

The LSH hash exists as column arithmetic (``lsh_hash``, usable in any projection) and as the same
arithmetic on NumPy batches (``lsh_buckets_np``), which the LSH operators use: Spark evaluates
higher-order array functions without code generation, and a plan with L x k literal arrays is slow
to analyse.  The hypercube coin flip needs wrapping
64-bit multiplication, which Spark SQL does not have under ANSI mode, so vertex codes are computed
on Arrow batches with NumPy ``uint64`` arithmetic inside ``mapInArrow``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO52 = float(1 << 52)


def md5_uniform(key: Column) -> Column:
    """u in (0, 1): (first 13 hex digits of md5(key) + 0.5) / 2^52 (same rule in the SQL oracle)."""
    return (F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(_TWO52)


# --------------------------------------------------------------------------- LSH grid hash

# Fixed values that must equal the reference for identical buckets:
# reference bucket count 256, and coefficient base -5 (the modulus 2^32 - 5 narrowed to a
# signed 32-bit int).  Coefficient i is base^i reduced modulo 256.
LSH_TABLE_SIZE = 256
LSH_COEF_BASE = -5


def lsh_coefficients(dim: int, base: int = LSH_COEF_BASE, modulus: int = LSH_TABLE_SIZE) -> list[int]:
    """``r_i = base^i mod modulus`` for i = 0..dim-1 (non-negative residues)."""
    return [pow(base, i, modulus) for i in range(dim)]


def double_array(values) -> str:
    """SQL text of a DOUBLE array literal; each value is parsed from its round-trip text."""
    return "array(" + ", ".join(f"CAST('{float(x)!r}' AS DOUBLE)" for x in values) + ")"


def lsh_hash_sql(vec: str, offsets: list[float], coef: list[int], w: float,
                 modulus: int = LSH_TABLE_SIZE) -> str:
    """SQL text of one grid hash ``h``: cells ``a_i = floor((x_i - s_i) / w)`` folded as
    ``sum_i pmod(pmod(a_{d-1-i}, M) * r_i, M)`` then reduced ``mod M``."""
    r = "array(" + ", ".join(f"{int(c)}L" for c in coef) + ")"
    cells = (f"zip_with({vec}, {double_array(offsets)}, "
             f"(x, o) -> CAST(floor((x - o) / CAST('{float(w)!r}' AS DOUBLE)) AS BIGINT))")
    terms = f"zip_with(reverse({cells}), {r}, (a, c) -> pmod(pmod(a, {modulus}L) * c, {modulus}L))"
    return f"pmod(aggregate({terms}, 0L, (acc, t) -> acc + t), {modulus}L)"


def lsh_hash(v: str, offsets: list[float], coef: list[int], w: float,
             modulus: int = LSH_TABLE_SIZE) -> Column:
    """One grid hash as a column (parsed once from SQL text, evaluated in the JVM)."""
    return F.expr(lsh_hash_sql(v, offsets, coef, w, modulus))


def lsh_amplify(hashes: list[Column], k: int, table_size: int | None = LSH_TABLE_SIZE) -> Column:
    """``g``: fold the k hashes as a 32-bit word, ``g = (g << (32 div k)) | h``, then ``mod table_size``.

    ``table_size=None`` keeps the whole 32-bit word (k <= 4); for k > 4, where the shifted fields
    overlap, use ``lsh_buckets_np`` (which then chains splitmix64 over the k values).
    """
    if table_size is None and k > 4:
        raise NotImplementedError("full keys for k > 4 are computed by lsh_buckets_np")
    shift = 32 // k if k > 1 else 0
    g = F.lit(0).cast("bigint")
    for h in hashes:
        g = F.shiftleft(g, shift).bitwiseOR(h).bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint"))
    return g if table_size is None else F.pmod(g, F.lit(int(table_size)).cast("bigint"))


def lsh_buckets_np(X: np.ndarray, offsets: np.ndarray, coef: np.ndarray, w: float, k: int,
                   table_size: int | None = LSH_TABLE_SIZE, modulus: int = LSH_TABLE_SIZE) -> np.ndarray:
    """The same hash on a batch: ``X`` (n x d), ``offsets`` (L x k x d) -> buckets (n x L) int64.

    Same IEEE operations as the column form (subtract, divide, floor), so cells are identical.
    """
    n, d = X.shape
    L = offsets.shape[0]
    S = offsets.reshape(L * k, d)
    out = np.empty((n, L), dtype=np.int64)
    step = max(1, (1 << 21) // max(1, L * k * d))
    shift = np.int64(32 // k if k > 1 else 0)
    mask = np.int64(0xFFFFFFFF)
    r = np.asarray(coef, dtype=np.int64)[None, None, :]
    for s0 in range(0, n, step):
        cells = np.floor((X[s0:s0 + step, None, :] - S[None, :, :]) / w).astype(np.int64)
        terms = (np.mod(cells, modulus)[:, :, ::-1] * r) % modulus
        h = (terms.sum(axis=2) % modulus).reshape(-1, L, k)
        if table_size is None and k > 4:
            g = np.zeros(h.shape[:2], dtype=np.uint64)
            for j in range(k):
                g = splitmix64(g ^ h[:, :, j].astype(np.uint64))
            out[s0:s0 + step] = (g >> np.uint64(1)).astype(np.int64)
            continue
        g = np.zeros(h.shape[:2], dtype=np.int64)
        for j in range(k):
            g = ((g << shift) | h[:, :, j]) & mask
        out[s0:s0 + step] = g if table_size is None else np.mod(g, table_size)
    return out


# --------------------------------------------------------------------------- hypercube coin flip

# The public splitmix64 finaliser constants.
SPLITMIX_GAMMA = 0x9E3779B97F4A7C15
SPLITMIX_MUL1 = 0xBF58476D1CE4E5B9
SPLITMIX_MUL2 = 0x94D049BB133111EB


def splitmix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser on ``uint64`` arrays (wrapping arithmetic)."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x += np.uint64(SPLITMIX_GAMMA)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(SPLITMIX_MUL1)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(SPLITMIX_MUL2)
    return x ^ (x >> np.uint64(31))


def cube_bits(cells: np.ndarray, seed: int) -> np.ndarray:
    """Coin flip per (point, function): ``splitmix64(((i << 32) ^ cell) ^ seed) & 1``.

    ``cells`` is (n x kproj) int64; negative cells are taken as their 64-bit two's complement.
    """
    n, k = cells.shape
    idx = (np.arange(k, dtype=np.uint64) << np.uint64(32))[None, :]
    key = idx ^ cells.astype(np.int64).view(np.uint64)
    key = key ^ np.uint64(int(seed) & 0xFFFFFFFFFFFFFFFF)
    return (splitmix64(key) & np.uint64(1)).astype(np.int64)


def cube_codes(X: np.ndarray, P: np.ndarray, t: np.ndarray, w: float, seed: int) -> np.ndarray:
    """Vertex code ``sum_i bit_i * 2^i`` with ``bit_i = coin(i, floor((x . p_i + t_i) / w))``."""
    if X.shape[0] == 0:
        return np.empty(0, dtype=np.int64)
    cells = np.floor((X @ P.T + t[None, :]) / w).astype(np.int64)
    # The reference keeps cells as 32-bit ints before widening; values outside that range cannot
    # come from finite inputs of sane scale, so they are clipped into it.
    cells = np.clip(cells, -(1 << 31), (1 << 31) - 1)
    bits = cube_bits(cells, seed)
    weights = (np.int64(1) << np.arange(P.shape[0], dtype=np.int64))
    return (bits * weights[None, :]).sum(axis=1).astype(np.int64)
