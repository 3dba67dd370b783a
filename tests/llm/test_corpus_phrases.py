import random
import re

import pytest

from ordermill.llm import phrases
from tests.llm import cases

WORD = r"[^\x20\x09-\x0D]+"


def brute(rows, span):
    first = {}
    for i, text, *_ in rows:
        w = re.findall(WORD, text or "")
        for k in range(len(w) - span + 1 if i is not None else 0):
            window = tuple(w[k: k + span])
            first[window] = min(first.get(window, (i, k)), (i, k))
    out = []
    for i, text, *_ in rows:
        w = re.findall(WORD, text or "")
        gone = {k + j for k in range(len(w) - span + 1 if i is not None else 0) if first[tuple(w[k: k + span])] < (i, k) for j in range(span)}
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


def passages(seed, n=60):
    """Shared passages at random places, periodic texts, words of one letter."""
    rng = random.Random(seed)
    shared = [cases.words(rng, rng.randint(15, 70)) for _ in range(6)]
    out = []
    for i in range(n):
        t = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(shared)
            a = rng.randint(0, 8)
            t += cases.words(rng, rng.randint(0, 15)) + p[a: rng.randint(a, len(p))]
        if i % 9 == 0:
            t = [rng.choice("ab") for _ in range(60)] if i % 2 else ["a", "b", "c"] * 30
        out.append((i * 2, rng.choice([" ", "\n", "  "]).join(t), "en", "a", 0))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("hot", [phrases.HOT, 3])
def test_equals_brute_force(spark, hot):
    rows = [(r[0] if r[0] is None else r[0] + 500, *r[1:]) for r in cases.corpus(7, 60)] + passages(1)
    df = cases.clashing(cases.frame(spark, rows), "n_words", "kept_text").repartition(4)
    out = phrases.without_repeats(df, hot=hot).collect()
    assert sorted((tuple(r) for r in out), key=str) == brute(rows, 20)
    assert sum(r.n_removed for r in out) > 0


def test_other_spans_and_small_automata(spark, monkeypatch):
    monkeypatch.setattr(phrases, "AUTOMATON_STRETCHES", 5)
    rows = passages(2)
    out = phrases.without_repeats(cases.frame(spark, rows), span=8, anchor=3).collect()
    assert sorted((tuple(r) for r in out), key=str) == brute(rows, 8)


def test_a_full_bit_map_only_costs_time(spark, monkeypatch):
    monkeypatch.setattr(phrases, "MAP_BITS", 7)
    rows = passages(3, 30)
    out = phrases.without_repeats(cases.frame(spark, rows), hot=10**9).collect()
    assert sorted((tuple(r) for r in out), key=str) == brute(rows, 20)


def test_empty_table(spark):
    assert phrases.without_repeats(cases.frame(spark, [])).count() == 0


def test_texts_that_share_an_id_keep_their_own_words(spark):
    long = " ".join(f"w{k}" for k in range(60))
    other = " ".join(f"v{k}" for k in range(60))
    rows = [(i, t, "en", "a", 0) for i, t in [(1, long), (2, long), (2, "only five words of text"), (2, None), (2, other), (3, "x " + other)]]
    out = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in phrases.without_repeats(cases.frame(spark, rows)).collect()))
    assert out == sorted([(1, 60, 0, long), (2, 60, 60, ""), (2, 5, 0, "only five words of text"), (2, 0, 0, ""), (2, 60, 0, other), (3, 61, 60, "x")])
