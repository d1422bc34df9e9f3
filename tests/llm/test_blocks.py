"""The blocks of large buckets against brute force."""

import types

import numpy as np
import pandas as pd

from catrec.llm import icws


def test_block_links_match_brute_force():
    draw = np.random.default_rng(7)
    idf = types.SimpleNamespace(value=draw.uniform(1, 3, 1 << icws.FREQUENCY_BITS).astype(np.float32))
    base = np.unique(draw.integers(1, 1 << icws.KEY_BITS, 40, dtype=np.uint64))
    sets = [np.sort(draw.choice(base, draw.integers(33, len(base) + 1), replace=False)) for _ in range(60)]
    times = [1 + (draw.random(len(s)) < 0.05).astype(np.int64) for s in sets]
    roots, stripe = draw.integers(0, 50, 60), draw.integers(0, 2, 60)
    rows = pd.DataFrame({"own": stripe, "id": np.arange(60), "root": roots,
                         "keys": [s.astype("<u8").tobytes() for s in sets],
                         "times": [t.astype("<i8").tobytes() for t in times]})
    weights = [{int(k): int(n) * float(idf.value[icws.counter_of(np.array([k]))[0]]) for k, n in zip(s, t, strict=True)}
               for s, t in zip(sets, times, strict=True)]
    expected = set()
    for a in range(60):
        for b in range(a + 1, 60):
            shared = sum(min(w, weights[b][k]) for k, w in weights[a].items() if k in weights[b])
            total = sum(weights[a].values()) + sum(weights[b].values()) - shared
            if roots[a] != roots[b] and shared >= icws.SIMILARITY * total:
                expected.add((a, b))
    found = []
    for low, high in ((0, 0), (0, 1), (1, 1)):
        block = rows[rows["own"].isin([low, high])].assign(low=low, high=high)
        found += list(icws.block_links(idf)(block).itertuples(index=False, name=None))
    assert 0 < len(expected) < 1500 and len(found) == len(set(found)) and set(found) == expected
