import math
import re
from collections import Counter, defaultdict

import pytest

from ordermill.llm import mixing
from tests.llm import cases

WORD = r"[^\x20\x09-\x0D]+"


def tokens(text):
    return len(re.findall(WORD, text or ""))


def uneven(n=400):
    """Four sources of very different sizes; the first holds most rows."""
    out = []
    for i in range(n):
        source = "big" if i % 10 < 7 else "mid" if i % 10 < 9 else "small" if i % 20 == 9 else None
        out.append((i, " ".join(f"w{k}" for k in range(5 + i % 13)), "en", source, 0))
    return out


def shares(rows):
    total = Counter()
    for r in rows:
        total[r[3]] += tokens(r[1])
    return total


def weights(total, a):
    whole = sum(total.values())
    z = sum((t / whole) ** a for t in total.values())
    return {s: (t / whole) ** a / z for s, t in total.items()}


def entropy(w):
    return -sum(x * math.log(x) for x in w.values())


@pytest.mark.parametrize("target", [
    mixing.Target(entropy_share=0.95, max_repeats=None), mixing.Target(entropy_share=1.0, max_repeats=3.0),
    mixing.Target(entropy_share=0.9, max_repeats=None, budget=9000), mixing.Target(entropy_share=0.97, max_repeats=2.0, at_least_once=True)])
def test_budgets_blocks_and_order(spark, target):
    rows = uneven()
    total = shares(rows)
    sources, _ = mixing.plan(cases.frame(spark, rows), target)
    plan = {None if r.source_key == mixing.NO_SOURCE else r.source_key: r for r in sources.collect()}
    w = {s: r.weight for s, r in plan.items()}
    repeats = {s: r.budget / total[s] for s, r in plan.items()}
    if target.max_repeats:
        assert max(repeats.values()) <= target.max_repeats * 1.01
        assert max(repeats.values()) > target.max_repeats * 0.95 or entropy(w) >= target.entropy_share * math.log(4) - 1e-4
    else:
        assert entropy(w) == pytest.approx(target.entropy_share * math.log(4), abs=1e-4)
    a = math.log(w["big"] / w["mid"]) / math.log(total["big"] / total["mid"])
    assert w == pytest.approx(weights(total, a), rel=1e-6)
    out = mixing.schedule(cases.frame(spark, rows), target).collect()
    by = defaultdict(list)
    for r in out:
        by[r.source].append(r)
    longest = max(tokens(r[1]) for r in rows)
    for s, rs in by.items():
        used = sum(r.n_tokens for r in rs)
        assert plan[s].budget - longest < used <= plan[s].budget
        at = 0
        for r in sorted(rs, key=lambda r: (r.block, r.position)):
            assert r.tokens_before == at
            at += r.n_tokens
        blocks = defaultdict(list)
        for r in rs:
            blocks[r.block].append(r)
        own = sorted(r[0] for r in rows if r[3] == s)
        for b, inside in blocks.items():
            assert sorted(r.position for r in inside) == list(range(len(inside)))
            ids = [r.doc_id for r in inside]
            assert len(set(ids)) == len(ids) and (b == max(blocks) or sorted(ids) == own)
    if target.at_least_once:
        assert {r.doc_id for r in out} == {r[0] for r in rows}
    mixed = mixing.mix(cases.clashing(cases.frame(spark, rows), "Block"), target).collect()
    assert Counter((r.doc_id, r.block) for r in mixed) == Counter((r.doc_id, r.block) for r in out)


def test_blocks_are_permuted_anew(spark):
    rows = uneven(100)
    out = mixing.schedule(cases.frame(spark, rows), mixing.Target(entropy_share=None, max_repeats=None, budget=10 * sum(shares(rows).values()))).collect()
    orders = [[r.doc_id for r in sorted((r for r in out if r.source == "big" and r.block == b), key=lambda r: r.position)] for b in range(3)]
    assert orders[0] != orders[1] != orders[2] and set(map(tuple, map(sorted, orders))) == {tuple(sorted(orders[0]))}


def test_awkward_rows(spark):
    rows = cases.corpus(8)
    out = mixing.schedule(cases.frame(spark, rows), mixing.Target(entropy_share=None, at_least_once=True)).collect()
    with_tokens = {s for s, t in shares(rows).items() if t}
    assert Counter((r.doc_id, r.source, r.n_tokens) for r in out) == Counter((r[0], r[3], tokens(r[1])) for r in rows if r[3] in with_tokens)


@pytest.mark.parametrize("rows", [[], [(1, None, "en", "a", 0), (2, " ", "en", "b", 0)]])
def test_nothing_to_mix(spark, rows):
    assert mixing.schedule(cases.frame(spark, rows)).count() == 0 and mixing.mix(cases.frame(spark, rows)).count() == 0


def test_sources_without_tokens_are_taken_once(spark):
    rows = [(1, "some words here", "en", "a", 0), (2, None, "en", "t", 0), (3, " ", "en", "t", 0), (4, "", "en", None, 0)]
    for target in (mixing.Target(), mixing.Target(at_least_once=True)):
        assert Counter(r.doc_id for r in mixing.mix(cases.frame(spark, rows), target).collect()) == Counter([1, 2, 3, 4])
        assert {(r.doc_id, r.source, r.block, r.n_tokens) for r in mixing.schedule(cases.frame(spark, rows), target).collect()} == {(1, "a", 0, 3), (2, "t", 0, 0), (3, "t", 0, 0), (4, None, 0, 0)}
    assert mixing.mix(cases.frame(spark, rows[1:]), mixing.Target(at_least_once=True)).count() == 3
