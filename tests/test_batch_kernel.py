"""The batch kernel and its summaries against a row-by-row loop."""

import numpy as np
import pytest

from tslines.operators import batch as B


def loop(t, nb, txn, lim):
    """Row by row, as the rules read."""
    rows = size = bid = 0
    last, prev, cur = t[0], t[0], txn[0]
    out = []
    for i in range(len(t)):
        if txn[i] != cur:
            if rows:
                bid += 1
            rows = size = 0
            last = prev if txn[i] is None else t[i]
            cur = txn[i]
        rows, size = rows + 1, size + nb[i]
        out.append(bid)
        if txn[i] is None and (rows >= lim[0] or size >= lim[1] or t[i] - last >= lim[2]):
            bid, rows, size, last = bid + 1, 0, 0, t[i]
        prev = t[i]
    return out


def case(rng, n, with_txn):
    t = np.cumsum(rng.integers(0, rng.choice([2, 5, 40]), n)).astype(np.int64)
    nb = rng.integers(1, rng.choice([2, 30]), n).astype(np.int64)
    txn = [None] * n
    if with_txn:
        i = 0
        while i < n:
            j = i + int(rng.integers(1, 9))
            txn[i:j] = [None if rng.random() < 0.5 else str(rng.integers(3))] * (min(j, n) - i)
            i = j
    off = B.NEVER
    lim = (int(rng.choice([off, 1, 3, 7])), int(rng.choice([off, 10, 45])),
           int(rng.choice([off, 4, 30])))
    return t, nb, txn, lim


@pytest.mark.parametrize("with_txn", [False, True])
def test_walk_and_summaries(with_txn):
    rng = np.random.default_rng(7)
    for _ in range(1500):
        n = int(rng.integers(1, 60))
        t, nb, txn, lim = case(rng, n, with_txn)
        want = loop(t.tolist(), nb.tolist(), txn, lim)
        tx = txn if with_txn else None
        state = B.State()
        got = B.walk_key(t, nb, tx, lim, state)
        assert got.tolist() == want
        # random cuts into pieces: enter each with the state of the previous ones
        cuts = [0, *sorted(set(rng.integers(0, n + 1, 4).tolist()) - {0, n}), n]
        parts = [B.Summary.of(t[a:b], nb[a:b], tx[a:b] if tx else None, lim)
                 for a, b in zip(cuts, cuts[1:])]
        joined = parts[0]
        for p in parts[1:]:
            joined = joined.then(p, lim)
        right = parts[-1]
        for p in reversed(parts[:-1]):
            right = p.then(right, lim)
        fresh = [np.array([v], dtype=np.int64) for v in (0, 0, 0, int(t[0]))]
        for s in (joined, right):
            out = s.enter(*fresh, int(t[0]), txn[0], lim)
            assert [int(v[0]) for v in out] == [state.id, state.rows, state.bytes, state.last]
