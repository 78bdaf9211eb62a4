"""Leading eigenpairs of a symmetric matrix by contour integration.

The spectrum is cut into slices at places that no eigenvalue is near; how many lie above a place is
the inertia of the shifted matrix. For each slice, solves with complex shifts along a circle around
it, summed by Gauss-Legendre quadrature, project a subspace onto the slice's eigenvectors.
Rayleigh-Ritz extracts them, and the found vectors are projected again until they no longer
improve. A slice ends with as many eigenpairs as its inertia counts say, so none is missed.
"""

from __future__ import annotations

import numpy as np

#: Quadrature nodes on the upper half of the circle; the lower half is their conjugate.
NODES = 8


def inertia(matrix: np.ndarray) -> int:
    """How many eigenvalues of a symmetric matrix are positive, from the signs of its pivots.

    Elimination takes the largest entry of the diagonal, or the two by two block around the largest
    entry elsewhere where that is much larger; such a block has one positive eigenvalue.
    """
    a = np.array(matrix, dtype=float)
    positive = 0
    while len(a):
        diagonal = np.abs(np.diag(a))
        i = int(np.argmax(diagonal))
        apart = np.abs(a - np.diag(np.diag(a)))
        r, s = divmod(int(np.argmax(apart)), len(a))
        if max(diagonal[i], apart[r, s]) == 0:
            break
        if diagonal[i] >= 0.6404 * apart[r, s]:  # (1 + sqrt(17)) / 8 bounds the growth
            pivots = [i]
            positive += a[i, i] > 0
        else:
            pivots = [r, s]
            positive += 1
        rest = np.setdiff1d(np.arange(len(a)), pivots)
        across = a[np.ix_(rest, pivots)]
        a = a[np.ix_(rest, rest)] - across @ np.linalg.solve(a[np.ix_(pivots, pivots)], across.T)
        a = (a + a.T) / 2
    return int(positive)


def above(matrix: np.ndarray, place: float) -> int:
    return inertia(matrix - place * np.eye(len(matrix)))


def cut_below(matrix: np.ndarray, count: int, top: float, floor: float, steps: int = 50) -> float | None:
    """A place with just ``count`` eigenvalues above it, in the middle of the gap there, or None
    where the gap is too narrow to tell."""
    low, high = floor, top
    for _ in range(steps):
        middle = (low + high) / 2
        found = above(matrix, middle)
        if found == count:
            break
        low, high = (middle, high) if found > count else (low, middle)
        if high - low <= 1e-9 * top:
            return None
    else:
        return None
    inside = middle
    lower, upper = low, inside  # the lower end of the gap
    for _ in range(12):
        place = (lower + upper) / 2
        lower, upper = (lower, place) if above(matrix, place) == count else (place, upper)
    gap_low = upper
    lower, upper = inside, high  # and the upper one
    for _ in range(12):
        place = (lower + upper) / 2
        lower, upper = (place, upper) if above(matrix, place) == count else (lower, place)
    if lower - gap_low <= 1e-7 * top:
        return None
    return (gap_low + lower) / 2


def slices(matrix: np.ndarray, wanted: int, top: float, floor: float, size: int) -> list[tuple[float, float, int]]:
    """``(low, high, count)`` from the top, together with at least ``wanted`` eigenvalues, or with
    all above ``floor``."""
    total = above(matrix, floor)
    edges = [(top, 0)]
    while edges[-1][1] < min(wanted, total):
        done = edges[-1][1]
        goal = min(done + size, wanted, total)
        cut = None
        # A cluster cannot be cut; the slice then ends before it, or else after it.
        for count in [*range(goal, done, -1), *range(goal + 1, total)]:
            if count < total and (cut := cut_below(matrix, count, edges[-1][0], floor)) is not None:
                break
        else:
            count, cut = total, floor
        edges.append((cut, count))
    return [(low, high, n - m) for (high, m), (low, n) in zip(edges, edges[1:])]


def project(matrix: np.ndarray, low: float, high: float, subspace: np.ndarray) -> np.ndarray:
    """The subspace filtered to eigenvectors of eigenvalues between the two places."""
    centre, radius = (low + high) / 2, (high - low) / 2
    points, weights = np.polynomial.legendre.leggauss(NODES)
    filtered = np.zeros_like(subspace)
    for angle, weight in zip(np.pi / 2 * (1 - points), weights):
        turn = np.exp(1j * angle)
        solved = np.linalg.solve((centre + radius * turn) * np.eye(len(matrix)) - matrix, subspace.astype(complex))
        filtered += weight / 2 * (radius * turn * solved).real
    return filtered


def feast(matrix: np.ndarray, low: float, high: float, count: int, rounds: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues between the two places, falling, and their unit eigenvectors."""
    n, scale = len(matrix), np.linalg.norm(matrix, 2)
    drawn = np.random.default_rng(1)
    size = min(n, count + max(4, count // 2))
    while True:
        subspace, last = drawn.standard_normal((n, size)), np.inf
        for _ in range(rounds):
            basis, _ = np.linalg.qr(project(matrix, low, high, subspace))
            values, turned = np.linalg.eigh(basis.T @ matrix @ basis)
            subspace = basis @ turned
            inside = np.flatnonzero((values > low) & (values < high))[::-1]
            residual = np.inf
            if len(inside) == count:
                found = subspace[:, inside]
                residual = np.abs(matrix @ found - found * values[inside]).max() / scale
                if residual < 1e-12 and residual >= last / 2:
                    return values[inside], found
            last = residual
        if size == n:
            raise ArithmeticError(f"{count} eigenvalues lie between {low} and {high} but were not found")
        size = min(n, 2 * size)


def leading(matrix: np.ndarray, wanted: int, relative: float = 1e-10, size: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a positive semidefinite matrix, falling, and unit
    eigenvectors as columns, the largest entry of each positive; fewer where others are zero, which
    is what those below ``relative`` times the trace count as."""
    trace = float(np.trace(matrix))
    if not len(matrix) or trace <= 0:
        return np.zeros(0), np.zeros((len(matrix), 0))
    top = min(trace, float(np.abs(matrix).sum(axis=1).max())) * 1.01
    parts = [feast(matrix, *slice_) for slice_ in slices(matrix, wanted, top, relative * trace, size)]
    values = np.concatenate([v for v, _ in parts])[:wanted]
    vectors = np.concatenate([u for _, u in parts], axis=1)[:, :wanted]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])
    return values, vectors * signs
