"""Singular values and right singular vectors of a small square matrix:
Householder bidiagonalisation, dqds, twisted factorisations.

Everything here works on one d x d factor, whose size is that of a vector
squared and doesn't grow with the rows that it stands for.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
#: Eigenvalues nearer than this part of themselves get a representation of their own.
GAP = 1e-3
#: Representations inside representations; deeper clusters are equal to working precision.
DEPTH = 8


def bidiagonal(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal of U' m V, and V (all orthogonal by reflections)."""
    a = np.array(m, float)
    d = len(a)
    v = np.eye(d)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        if not np.any(x[1:]):
            return None
        u = x / np.abs(x).max()
        u[0] += np.copysign(np.linalg.norm(u), u[0])
        return u / np.linalg.norm(u)

    for k in range(d):
        if (u := reflector(a[k:, k])) is not None:
            a[k:, k:] -= 2 * np.outer(u, u @ a[k:, k:])
        if k < d - 2 and (u := reflector(a[k, k + 1 :])) is not None:
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ u, u)
            v[:, k + 1 :] -= 2 * np.outer(v[:, k + 1 :] @ u, u)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squares of the singular values of the bidiagonal (a, b), falling.

    The qd array q = a*a, e = b*b goes through differential transforms with
    shifts; a transform only adds, multiplies and divides positive numbers, so
    that even tiny values keep their relative accuracy. A shift above the
    least value shows as a negative number: it is then halved towards what is
    known to be below, and 0 always works.
    """
    found: list[float] = []
    todo = [(a.astype(float) ** 2, b.astype(float) ** 2, 0.0, 0.0)]
    while todo:
        q, e, base, low = todo.pop()
        if len(q) > 1 and q[0] * 1.5 < q[-1]:
            q, e = q[::-1].copy(), e[::-1].copy()
        while len(q):
            if len(q) == 1:
                found.append(base + (low + q[0]))
                break
            gone = np.flatnonzero(e <= (4 * EPS) ** 2 * (base + np.minimum(q[:-1], q[1:])))
            if len(gone):
                i = int(gone[-1])
                if i + 1 < len(q) - 1:
                    todo.append((q[: i + 1], e[:i], base, low))
                    q, e = q[i + 1 :], e[i + 1 :]
                else:
                    found.append(base + (low + q[-1]))
                    q, e = q[:-1], e[:-1]
                continue
            # lower eigenvalue of the last two rows, less what the row above them adds
            half = (q[-2] + e[-1] - q[-1]) / 2
            root = np.hypot(half, np.sqrt(q[-1] * e[-1]))
            last = max(0.0, q[-1] - q[-1] * e[-1] / (half + root) if half + root > 0 else q[-1] + half - root)
            above = np.sqrt(q[-2] * e[-2]) if len(q) > 2 else 0.0
            for s in (max(0.0, last - min(above, last / 4)), last / 2, last / 16, 0.0):
                if (done := _transform(q, e, s)) is not None:
                    break
            q, e = done
            total = base + (low + s)  # what rounding cuts off the sum of shifts is carried along
            base, low = total, (base - total) + (low + s)
    return np.sort(np.maximum(found, 0.0))[::-1]


def _transform(q: np.ndarray, e: np.ndarray, s: float) -> tuple[np.ndarray, np.ndarray] | None:
    """One differential transform with shift ``s``; None if ``s`` is too large."""
    new_q, new_e = [], []
    d = q[0] - s
    qs, es = q.tolist(), e.tolist()
    for i, up in enumerate(es):
        if d < 0:
            return None
        t = d + up
        new_q.append(t)
        if t == 0:
            new_e.append(0.0)
            d = qs[i + 1] - s
        else:
            new_e.append(qs[i + 1] * (up / t))
            d = qs[i + 1] * (d / t) - s
    if d < 0:
        return None
    new_q.append(d)
    return np.array(new_q), np.array(new_e)


def _below(dd: np.ndarray, ll: np.ndarray, x: np.ndarray) -> np.ndarray:
    """How many eigenvalues of L D L' lie below each of ``x``."""
    s = -x
    n = np.zeros(len(x), int)
    for i in range(len(ll)):
        p = dd[i] + s
        p = np.where(p == 0, -np.finfo(float).tiny, p)
        n += p < 0
        s = ll[i] * ll[i] * dd[i] * (s / p) - x
    return n + (dd[-1] + s < 0)


def _shifted(dd: np.ndarray, ll: np.ndarray, x: float) -> tuple[np.ndarray, np.ndarray]:
    """L+ D+ L+' = L D L' - x."""
    d2, l2, s = np.empty_like(dd), np.empty_like(ll), -x
    for i in range(len(ll)):
        d2[i] = dd[i] + s
        if d2[i] == 0:
            d2[i] = -np.finfo(float).tiny
        l2[i] = dd[i] * ll[i] / d2[i]
        s = l2[i] * ll[i] * s - x
    d2[-1] = dd[-1] + s
    return d2, l2


def _refined(dd: np.ndarray, ll: np.ndarray, guess: np.ndarray, above: np.ndarray, spread: float) -> np.ndarray:
    """Eigenvalues by bisection; ``above`` has how many eigenvalues lie at or above each."""
    below = len(dd) - above  # eigenvalues smaller than the wanted one
    w = np.full(len(guess), max(spread, np.finfo(float).tiny * 1e10))
    lo, hi = guess - w, guess + w
    for _ in range(200):
        bad = _below(dd, ll, lo) > below
        lo = np.where(bad, lo - w, lo)
        w = np.where(bad, 2 * w, w)
        if not bad.any():
            break
    w = hi - lo
    for _ in range(200):
        bad = _below(dd, ll, hi) <= below
        hi = np.where(bad, hi + w, hi)
        w = np.where(bad, 2 * w, w)
        if not bad.any():
            break
    for _ in range(120):
        mid = (lo + hi) / 2
        up = _below(dd, ll, mid) <= below
        lo, hi = np.where(up, mid, lo), np.where(up, hi, mid)
        if np.all(hi - lo <= 2 * EPS * np.maximum(np.abs(lo), np.abs(hi))):
            break
    return (lo + hi) / 2


def twisted(dd: np.ndarray, ll: np.ndarray, x: float, skip: tuple[int, ...] = ()) -> tuple[np.ndarray, float, int]:
    """The eigenvector of L D L' at ``x`` from the twisted factorisation with
    the least middle element, a correction of ``x``, and the twist's place."""
    n = len(dd)
    tiny = np.finfo(float).tiny
    down_l, s = np.empty(n - 1), np.empty(n)
    s[0] = -x
    for i in range(n - 1):
        p = dd[i] + s[i] or -tiny
        down_l[i] = dd[i] * ll[i] / p
        s[i + 1] = down_l[i] * ll[i] * s[i] - x
    up_u, p = np.empty(n - 1), np.empty(n)
    p[-1] = dd[-1] - x
    for i in range(n - 2, -1, -1):
        t = dd[i] * ll[i] * ll[i] + p[i + 1] or -tiny
        up_u[i] = dd[i] * ll[i] / t
        p[i] = p[i + 1] * (dd[i] / t) - x
    gamma = s + p + x
    order = [i for i in np.argsort(np.abs(np.nan_to_num(gamma, nan=np.inf)), kind="stable") if i not in skip]
    r = int(order[0])
    z = np.zeros(n)
    z[r] = 1.0
    for i in range(r - 1, -1, -1):
        z[i] = -down_l[i] * z[i + 1]
    for i in range(r, n - 1):
        z[i + 1] = -up_u[i] * z[i]
    size = z @ z
    return z / np.sqrt(size), float(gamma[r] / size), r


def _vectors(dd: np.ndarray, ll: np.ndarray, values: np.ndarray, first: int, wanted: int, depth: int) -> np.ndarray:
    """Vectors (columns) of the ``wanted`` largest of ``values``, which are
    eigenvalues number ``first``, ``first + 1``, ... from the top of L D L'."""
    out = np.zeros((len(dd), min(wanted, len(values))))
    i = 0
    while i < out.shape[1]:
        j = i + 1
        while j < len(values) and values[j - 1] - values[j] <= GAP * max(abs(values[j - 1]), abs(values[j])):
            j += 1
        if j - i == 1:
            x = values[i]
            room = min([abs(x - values[k]) for k in (i - 1, i + 1) if 0 <= k < len(values)] or [abs(x)])
            z, step, _ = twisted(dd, ll, x)
            for _ in range(4):
                if not abs(step) <= room / 4 or abs(step) <= 2 * EPS * abs(x):
                    break
                x += step
                z, step, _ = twisted(dd, ll, x)
            out[:, i] = z
        elif depth < DEPTH:
            # A shift next to the cluster moves its values apart, relative to their size.
            width = max(values[i] - values[j - 1], 4 * EPS * max(abs(values[i]), abs(values[j - 1])))
            tries = [values[j - 1] - width / 16, values[i] + width / 16, values[j - 1] - 4 * width, values[i] + 4 * width]
            made = [(t, *_shifted(dd, ll, t)) for t in tries]
            t, d2, l2 = min(made, key=lambda x: np.nan_to_num(np.abs(x[1]).max(), nan=np.inf))
            inner = _refined(d2, l2, values[i:j] - t, first + np.arange(i, j) + 1, 8 * EPS * max(abs(values[i]), abs(values[j - 1])))
            out[:, i : min(j, out.shape[1])] = _vectors(d2, l2, inner, first + i, out.shape[1] - i, depth + 1)
        else:
            # Equal to working precision: any orthonormal basis of their space is right.
            got, used = [], ()
            for k in range(i, min(j, out.shape[1])):
                z, _, r = twisted(dd, ll, values[k], used)
                got.append(z)
                used += (r,)
            out[:, i : i + len(got)] = np.linalg.qr(np.array(got).T)[0]
        i = j
    return out


def right_singular(r: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """All squared singular values of ``r``, falling, and the right singular
    vectors (columns) of the ``wanted`` largest."""
    a, b, v = bidiagonal(r)
    cut = np.flatnonzero(np.abs(b) <= EPS * np.minimum(np.abs(a[:-1]), np.abs(a[1:])))
    found = []
    for lo, hi in zip([0, *(cut + 1)], [*(cut + 1), len(a)]):
        squares = dqds(a[lo:hi], b[lo : hi - 1])
        found += [(-x, lo, hi, i) for i, x in enumerate(squares)]
    found.sort()
    take = found[: min(wanted, len(a))]
    z, top = np.zeros((len(a), len(take))), max(np.abs(a).max(), np.abs(b).max(initial=0.0))
    for lo, hi in {x[1:3] for x in take}:
        at = [k for k, x in enumerate(take) if x[1] == lo]
        squares = np.array(sorted((-x[0] for x in found if x[1] == lo), reverse=True))
        if hi - lo == 1:
            z[lo, at] = 1.0
            continue
        least = EPS * top or 1.0  # a zero on the diagonal would have no factor
        diag = np.where(np.abs(a[lo:hi]) < least, least, a[lo:hi])
        z[lo:hi, at] = _vectors(diag * diag, b[lo : hi - 1] / diag[:-1], squares, 0, len(at), 0)
    w = v @ z
    if np.abs(w.T @ w - np.eye(w.shape[1])).max(initial=0.0) > 1e-12:
        # Columns that aren't orthogonal to the last digits are made so, the larger values first.
        q, t = np.linalg.qr(w)
        w = q * np.sign(np.where(np.diag(t) == 0, 1, np.diag(t)))
    return np.array([-x[0] for x in found]), w
