"""Penalised least squares on moments: solutions that come with a proof.

The problem is  P(w) = mean((y − b − xᵀw)²) + l1‖w‖₁ + l2‖w‖²  with the best intercept b, that is
spread − 2cᵀw + wᵀAw + l1‖w‖₁ + l2‖w‖² in the centred moments A (covariance of x), c (covariance
of x and y) and spread (variance of y). Nothing here reads data.

*Duality gap.* With residual r = y − Xw of the problem that carries l2 in extra rows, any t r with
|2Xᵀ(t r)| ≤ l1 bounds the minimum from below by 2t yᵀr − t²rᵀr, and yᵀr and rᵀr follow from the
moments. P(w) less the best such bound is how far w can be from optimal (without L1 that distance
is a quadratic form of the gradient); the solvers stop on it
and raise if they can't get there, so an iteration count never decides.

*Coordinate descent* updates the covariances of the residual (covariance updates) and, where the
signs of a solution have settled, solves for these signs exactly; besides the features it steps along the directions that leave
the error unchanged, which whole one-hot blocks have. *The path* is the homotopy in
l1 for a fixed l2: w is piecewise linear in l1, each piece ends where a feature joins or leaves,
and one run gives the solutions of any number of l1.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from tripdeck.operators.gram import Moments

GAP = 1e-11       # proven distance from the optimum, as a share of the variance of y
DEPENDENT = 1e-9  # a feature with less variance of its own than this share adds no direction


@dataclass(frozen=True)
class Quadratic:
    """Centred moments of one data set."""

    A: np.ndarray
    c: np.ndarray
    spread: float
    mean_x: np.ndarray
    mean_y: float

    @classmethod
    def of(cls, m: Moments) -> Quadratic:
        mx, my = m.sx / m.n, m.sy / m.n
        return cls(m.sxx / m.n - np.outer(mx, mx), m.sxy / m.n - mx * my,
                   max(m.syy / m.n - my * my, 0.0), mx, my)

    def intercept(self, w: np.ndarray) -> float:
        return float(self.mean_y - self.mean_x @ w)

    def loss(self, w: np.ndarray, l1: float, l2: float) -> float:
        return float(self.spread - 2 * self.c @ w + w @ self.A @ w + l1 * np.abs(w).sum()
                     + l2 * w @ w)

    def gap(self, w: np.ndarray, l1: float, l2: float) -> float:
        """Upper bound of P(w) − min P; without L1 the distance itself."""
        aw = self.A @ w
        g = self.c - aw - l2 * w                       # Xᵀr
        if l1 == 0.0:
            return float(max(g @ np.linalg.lstsq(self.A + l2 * np.eye(len(g)), g, rcond=1e-13)[0],
                             0.0))
        yr = self.spread - self.c @ w                  # yᵀr
        rr = self.spread - 2 * self.c @ w + w @ aw + l2 * w @ w
        most = 2 * np.abs(g).max(initial=0.0)
        t = 0.0 if rr <= 0 else yr / rr                # the best multiple without the constraint
        if most > 0:
            t = min(max(t, -l1 / most), l1 / most)
        return float(max(rr + l1 * np.abs(w).sum() - (2 * t * yr - t * t * rr), 0.0))


def least_squares(q: Quadratic, l2: float) -> np.ndarray:
    """The solution without L1; of least norm where collinear features leave a choice."""
    return np.linalg.lstsq(q.A + l2 * np.eye(len(q.c)), q.c, rcond=None)[0]


def settled(q: Quadratic, w: np.ndarray, l1: float, l2: float) -> np.ndarray | None:
    """The exact solution with the signs of ``w``, or None where it has other signs."""
    s = np.flatnonzero(w)
    if not len(s):
        return None
    sign = np.sign(w[s])
    part = q.A[np.ix_(s, s)] + l2 * np.eye(len(s))
    x = w[s] + np.linalg.lstsq(part, q.c[s] - l1 / 2 * sign - part @ w[s], rcond=1e-13)[0]
    if (x * sign <= 0).any():
        return None
    out = np.zeros_like(w)
    out[s] = x
    return out


def free_directions(A: np.ndarray) -> np.ndarray:
    """Sparse columns that span the directions in which the error does not change: sums of the
    levels of a one-hot block, copies of a feature. Coordinate steps alone creep along them."""
    values, vectors = np.linalg.eigh(A)
    rows = vectors[:, values <= 1e-12 * max(values.max(initial=0.0), 1e-300)].T.copy()
    used: list[int] = []
    for k in range(len(rows)):                 # Gauss-Jordan with the largest pivot
        size = np.abs(rows[k:]).copy()
        size[:, used] = 0.0
        i, j = np.unravel_index(size.argmax(), size.shape)
        rows[[k, k + i]] = rows[[k + i, k]]
        rows[k] /= rows[k, j]
        others = np.arange(len(rows)) != k
        rows[others] -= np.outer(rows[others, j], rows[k])
        used.append(int(j))
    rows[np.abs(rows) < 1e-7] = 0.0
    return rows.T


def best_step(w: np.ndarray, v: np.ndarray, l1: float, l2: float) -> float:
    """t that minimises l1‖w + t v‖₁ + l2‖w + t v‖², by the sign changes along the line."""
    s = np.flatnonzero(v)
    turn = -w[s] / v[s]
    order = np.argsort(turn)
    turn, size = turn[order], np.abs(v[s])[order]
    slope = -l1 * size.sum()                   # of the L1 part left of all turns
    a, b = 2 * l2 * float(v @ v), 2 * l2 * float(w @ v)
    for t, k in zip(turn, size, strict=True):
        if slope + a * t + b >= 0:             # the minimum lies before this turn
            return (-slope - b) / a
        slope += 2 * l1 * k
        if slope + a * t + b >= 0:
            return float(t)
    return (-slope - b) / a if a > 0 else float(turn[-1])


def coordinate_descent(q: Quadratic, l1: float, l2: float, start: np.ndarray | None = None,
                       tol: float = GAP, max_sweeps: int = 200_000, trace: list | None = None,
                       polish: bool = True) -> tuple[np.ndarray, int, float]:
    """(w, sweeps, proven gap) with a gap of at most ``tol`` times the variance of y.

    ``trace`` receives (sweep, w) of every iterate, the start (zero, if not given) included.
    With ``polish`` the exact solution for an iterate's signs is tried as well."""
    d = len(q.c)
    w = np.zeros(d) if start is None else start.astype(float).copy()
    if trace is not None:
        trace.append((0, w.copy()))
    g = q.c - q.A @ w
    own = np.diag(q.A).copy()
    free = free_directions(q.A).T if l1 + l2 > 0 else ()
    limit = tol * q.spread
    best, least, check = w.copy(), q.gap(w, l1, l2), 1
    for sweep in range(1, max_sweeps + 1):
        for j in range(d):
            if own[j] + l2 <= 0:
                continue
            z = g[j] + own[j] * w[j]
            new = np.sign(z) * max(abs(z) - l1 / 2, 0.0) / (own[j] + l2)
            if new != w[j]:
                g -= q.A[:, j] * (new - w[j])
                w[j] = new
        for v in free:
            w += best_step(w, v, l1, l2) * v
        if trace is not None:
            trace.append((sweep, w.copy()))
        if sweep < check and trace is None:
            continue
        check = sweep + max(1, sweep // 4)     # checks thin out, a polish costs d³
        for x in (w, settled(q, w, l1, l2) if polish else None):
            if x is not None and (now := q.gap(x, l1, l2)) < least:
                best, least = x.copy(), now
        if least <= limit:
            if trace is not None and not np.array_equal(best, w):
                trace.append((sweep + 1, best.copy()))
            return best, sweep, least
    raise RuntimeError(f"gap {least:.3g} after {max_sweeps} sweeps, above {limit:.3g}")


def path(q: Quadratic, l2: float, l1s: list[float], max_steps: int = 100_000
         ) -> dict[float, np.ndarray]:
    """Solutions at each of ``l1s``, from one run of the homotopy from the empty model down."""
    d = len(q.c)
    B = q.A + l2 * np.eye(d)
    w, g = np.zeros(d), q.c.astype(float).copy()
    out, targets = {}, sorted(set(l1s), reverse=True)
    lam = float(np.abs(g).max(initial=0.0))      # the bound on |g|, l1 / 2
    active: list[int] = []
    barred: set[int] = set()                     # add no direction to the active ones
    left = -1                                    # just left: still at the bound, but going inside
    while targets and targets[0] / 2 >= lam:
        out[targets.pop(0)] = w.copy()
    for _ in range(max_steps):
        if not targets:
            return out
        # join what stands at the bound
        rest = np.ones(d, bool)
        rest[active] = False
        rest[list(barred)] = False
        stand = rest & (np.abs(g) >= lam * (1 - 1e-12))
        if left >= 0:
            stand[left] = False
        for j in np.flatnonzero(stand):
            if _own_share(B, active, j) > DEPENDENT:
                active.append(int(j))
            else:
                barred.add(int(j))
            rest[j] = False
        s = np.array(active, int)
        step, event = lam - targets[0] / 2, ("target", -1)
        slope, move = np.zeros(d), np.zeros(len(s))
        if len(s):
            move = np.linalg.solve(B[np.ix_(s, s)], np.sign(g[s]))
            slope = B[:, s] @ move
            with np.errstate(divide="ignore", invalid="ignore"):
                gone = np.where(move != 0, -w[s] / move, np.inf)
            for k in np.flatnonzero((gone > 0) & (w[s] != 0)):
                if gone[k] < step:
                    step, event = float(gone[k]), ("leave", int(s[k]))
        for j in np.flatnonzero(rest):
            for up in (1.0, -1.0):
                rate = 1.0 - up * slope[j]
                if rate > 0 and (t := (lam - up * g[j]) / rate) < step and (
                        j != left or t > 1e-9 * lam):
                    step, event = max(float(t), 0.0), ("join", int(j))
        if len(s):
            w[s] += step * move
            g -= step * slope
        lam -= step
        left = -1
        if event[0] == "leave":
            left = event[1]
            w[left] = 0.0
            active.remove(left)
            barred.clear()
        elif event[0] == "target":
            while targets and targets[0] / 2 >= lam * (1 - 1e-12):
                out[targets.pop(0)] = w.copy()
        else:
            g[event[1]] = np.sign(g[event[1]]) * lam      # without the step's rounding
    raise RuntimeError(f"the path did not end in {max_steps} steps")


def _own_share(B: np.ndarray, active: list[int], j: int) -> float:
    """What share of feature j's variance the active features leave unexplained."""
    if B[j, j] <= 0:
        return 0.0
    if not active:
        return 1.0
    x = np.linalg.lstsq(B[np.ix_(active, active)], B[active, j], rcond=None)[0]
    return float((B[j, j] - B[active, j] @ x) / B[j, j])


def solve_all(q: Quadratic, penalties: list[tuple[float, float]]
              ) -> list[tuple[np.ndarray, int, float]]:
    """(w, sweeps, proven gap) for each (l1, l2): closed form without L1, otherwise one path for
    all l1 that share an l2; what a path can't prove, coordinate descent finishes from there."""
    by_l2: dict[float, list[float]] = {}
    for l1, l2 in penalties:
        if l1 > 0:
            by_l2.setdefault(l2, []).append(l1)
    starts = {}
    for l2, l1s in by_l2.items():
        for l1, w in path(q, l2, l1s).items():
            exact = settled(q, w, l1, l2)
            starts[l1, l2] = w if exact is None or q.gap(exact, l1, l2) > q.gap(w, l1, l2) \
                else exact
    out = []
    for l1, l2 in penalties:
        if l1 <= 0:
            out.append((least_squares(q, l2), 0, 0.0))
            continue
        w = starts[l1, l2]
        gap = q.gap(w, l1, l2)
        out.append((w, 0, gap) if gap <= GAP * q.spread
                   else coordinate_descent(q, l1, l2, start=w))
    return out
