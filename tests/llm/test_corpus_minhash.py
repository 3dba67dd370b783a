import random
import re

import pytest
from pyspark.sql import functions as F

from ordermill.llm import minhash as M
from ordermill.llm.components import components
from tests.llm import cases

WORD = r"[^\x20\x09-\x0D]+"


def shingles(text, size):
    w = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[k: k + size]) for k in range(len(w) - size + 1)) or frozenset([tuple(w)])


def brute(rows, s):
    """Ids, shingle counts and components by comparing every two sets."""
    sets = [shingles(r[1], s.shingle) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            same_id = rows[a][0] is not None and rows[a][0] == rows[b][0]
            inter = len(sets[a] & sets[b])
            if same_id or sets[a] and rows[a][0] is not None and rows[b][0] is not None and 100 * inter >= s.share * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            least[find(k)] = min(least.get(find(k), r[0]), r[0])
    out = []
    for k, r in enumerate(rows):
        if r[0] is None:
            equal = [least[find(j)] for j, o in enumerate(rows) if o[0] is not None and sets[j] and sets[j] == sets[k]]
            out.append((None, len(sets[k]), min(equal, default=None), not equal))
        else:
            out.append((r[0], len(sets[k]), least[find(k)], r[0] == least[find(k)]))
    return sorted(out, key=str)


def groups(seed, members=25):
    """Copies with more and more words changed, so that links form chains, beside unlike texts."""
    rng = random.Random(seed)
    out, i = [], 0
    for _ in range(4):
        base = cases.words(rng, rng.choice([40, 120, 300]))
        for _ in range(members):
            t = list(base)
            for _ in range(rng.randint(0, max(1, len(t) // 25))):
                t[rng.randrange(len(t))] = f"new{rng.randint(0, 999)}"
            out.append((i, " ".join(t), "en", "a", 0))
            i += 3
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("s", [M.Settings(), M.Settings(shingle=5, share=80)])
def test_components_equal_brute_force(spark, s):
    rows = [(r[0] if r[0] is None else r[0] + 1000, *r[1:]) for r in cases.corpus(5, 80)] + groups(2)
    out = M.near_duplicates(cases.clashing(cases.frame(spark, rows), "kept", "sig").repartition(3), s).collect()
    assert sorted((tuple(r) for r in out), key=str) == brute(rows, s)


def test_large_groups_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(M, "CHUNK_ROWS", 7)
    rows = groups(3, 40)
    s = M.Settings()
    assert sorted((tuple(r) for r in M.near_duplicates(cases.frame(spark, rows), s).collect()), key=str) == brute(rows, s)


def test_every_pair_of_a_group_meets(spark):
    df = spark.range(40).withColumn("parts", F.lit(4))
    met = {}
    for r in M.chunked(df, "parts", "id").collect():
        met.setdefault((r.i, r.j), set()).add(r.id)
    assert all(any({a, b} <= ids for ids in met.values()) for a in range(40) for b in range(a))


def test_bounds_of_the_posterior():
    s = M.Settings()
    assert s.bands == 20 and s.least_matches() == sorted(s.least_matches())
    x, least = 0.85 + 0.15 / 256, s.least_matches()[-1]
    # Numeric integral of the posterior density m of k on either side of the bound.
    def tail(m, k, n=20_000):
        grid = [(j + 0.5) / n for j in range(n)]
        dens = [p**m * (1 - p) ** (k - m) for p in grid]
        return sum(d for p, d in zip(grid, dens) if p >= x) / sum(dens)
    assert tail(least - 1, 64) < s.miss <= tail(least, 64) * 1.01


def test_signatures_estimate_similarity():
    import numpy as np
    import pyarrow as pa
    rng = random.Random(4)
    a = [f"w{rng.randint(0, 10**6)}" for _ in range(400)]
    b = a[:300] + [f"v{k}" for k in range(100)]
    h, first = M.shingles(pa.array([" ".join(a), " ".join(b)]), 1)
    sig = M.signatures(h, first, 512)
    assert abs((sig[0] == sig[1]).mean() - 300 / 500) < 0.08 and np.diff(first).tolist() == [len(set(a)), len(set(b))]


def test_components(spark):
    links = [(1, 2), (2, 1), (3, 2), (9, 8), (8, 7), (7, 6), (6, 5), (20, 20)] + [(100, k) for k in range(101, 180)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert found == {**{k: 1 for k in (1, 2, 3)}, **{k: 5 for k in range(5, 10)}, **{k: 100 for k in range(100, 180)}}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_empty_table(spark):
    assert M.near_duplicates(cases.frame(spark, [])).count() == 0
    alone = M.near_duplicates(cases.frame(spark, [(4, None, "en", "a", 0)])).collect()
    assert [tuple(r) for r in alone] == [(4, 0, 4, True)]
