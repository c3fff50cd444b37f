"""Scaled forward-backward over many sequences in flat arrays (used by the HMM and the CRF)."""

from __future__ import annotations

import numpy as np


def by_length(lengths: np.ndarray, most: int):
    """Groups of sequence numbers, longest first, of about ``most`` steps in all."""
    order, at = np.argsort(-lengths, kind="stable"), 0
    while at < len(order):
        total = np.cumsum(lengths[order[at:]])
        n = max(1, int(np.searchsorted(total, most, side="right")))
        yield order[at:at + n]
        at += n


def _active(lengths: np.ndarray) -> np.ndarray:
    """For each step, how many of the (longest first) sequences have it."""
    return np.searchsorted(-lengths, -np.arange(lengths[0]), side="left") if len(lengths) and lengths[0] else np.zeros(0, int)


def _by_step(starts: np.ndarray, lengths: np.ndarray):
    """Active sequences and first place of each step, and the flat position of each place: the places of a step
    are neighbours, in the order of the sequences."""
    active = _active(lengths)
    first = np.cumsum(active) - active
    n = int(active.sum())
    at = starts[np.arange(n) - np.repeat(first, active)] + np.repeat(np.arange(len(active)), active)
    return active.tolist(), first.tolist(), at


def forward(emit: np.ndarray, starts: np.ndarray, lengths: np.ndarray, first: np.ndarray, step: np.ndarray, every: int = 1):
    """Alphas and scales of sequences given longest first; ``emit`` is (steps, states). Alphas are normalised at every
    ``every``-th step and at the last one; the scales of the other steps are 1. The scales of a sequence multiply to its
    likelihood, and alphas times the betas of these scales are its marginals, whichever steps are normalised."""
    active, place, at = _by_step(starts, lengths)
    a, s, move = np.ascontiguousarray(emit[at].T), np.ones(len(at)), np.ascontiguousarray(step.T)
    for t, m in enumerate(active):
        lo, hi = place[t], place[t] + m
        here = a[:, lo:hi]
        here *= first[:, None] if t == 0 else move @ a[:, place[t - 1]:place[t - 1] + m]
        if t % every == 0:
            s[lo:hi] = total = here.sum(axis=0)
            here /= total
    if every > 1:
        some = np.flatnonzero((lengths > 0) & ((lengths - 1) % every != 0))
        last = np.array(place, int)[lengths[some] - 1] + some
        s[last] = total = a[:, last].sum(axis=0)
        a[:, last] /= total
    alpha, scale = np.empty_like(emit), np.ones(len(emit))
    alpha[at], scale[at] = a.T, s
    return alpha, scale


def backward(emit, scale, starts, lengths, step, last=None):
    """Betas that go with ``forward``'s scales; ``last`` is the beta of the last step of a single sequence (else ones)."""
    active, place, at = _by_step(starts, lengths)
    e = np.ascontiguousarray((emit[at] / scale[at][:, None]).T)
    b = np.ones_like(e)
    if last is not None:
        b[:, -1] = last
    for t in range(len(active) - 2, -1, -1):
        m, lo, nxt = active[t + 1], place[t], place[t + 1]
        b[:, lo:lo + m] = step @ (e[:, nxt:nxt + m] * b[:, nxt:nxt + m])
    beta = np.ones_like(emit)
    beta[at] = b.T
    return beta


# The same sums over arrays that stay in step order (``by_step``): the rows of a step are one block, (rows, states).

def by_step(starts: np.ndarray, lengths: np.ndarray):
    """Active sequences and first place of each step, the flat position of each place, and its sequence."""
    active, first, at = _by_step(starts, lengths)
    return active, first, at, np.arange(len(at)) - np.repeat(np.array(first, int), active)


def forward_by_step(a: np.ndarray, active: list, place: list, lengths: np.ndarray, first: np.ndarray, step: np.ndarray, every: int):
    """Turns the emissions ``a`` into ``forward``'s alphas in place; returns the scales."""
    s, ones = np.ones(len(a)), np.ones(a.shape[1])
    for t, m in enumerate(active):
        lo = place[t]
        here = a[lo:lo + m]
        here *= first if t == 0 else a[place[t - 1]:place[t - 1] + m] @ step
        if t % every == 0:
            s[lo:lo + m] = total = here @ ones
            here /= total[:, None]
    some = np.flatnonzero((lengths > 0) & ((lengths - 1) % every != 0))
    last = np.array(place, int)[lengths[some] - 1] + some
    s[last] = total = a[last] @ ones
    a[last] /= total[:, None]
    return s


def backward_by_step(e: np.ndarray, active: list, place: list, step: np.ndarray, last=None):
    """Betas for ``e``, the emissions over the scales; ``e`` becomes their product with the betas."""
    b, back = np.ones_like(e), np.ascontiguousarray(step.T)
    if last is not None:
        b[-1] = last
    for t in range(len(active) - 1, -1, -1):
        lo, m = place[t], active[t]
        here = e[lo:lo + m]
        here *= b[lo:lo + m]
        if t:
            np.matmul(here, back, out=b[place[t - 1]:place[t - 1] + m])
    return b
