import random
import re

import pytest

from ordermill.llm import lines
from tests.llm import cases


def reach(said, at, own, k):
    """How many lines from line k of a document on are those from each earlier place on."""
    for other, theirs in said.items():
        if other > at:
            continue
        for j in range(len(theirs) if other < at else k):
            n = 0
            while k + n < len(own) and j + n < len(theirs) and own[k + n] == theirs[j + n]:
                n += 1
            yield n


def brute(rows, run):
    worded = lambda t: [(k, x) for k, x in enumerate((t or "").split("\n")) if re.search(r"[^\x20\x09-\x0D]", x)]
    order = lambda i, text: (i is None, i or 0)
    said = {order(i, text): [x for _, x in worded(text)] for i, text, *_ in rows}
    first = {}
    for i, text, *_ in rows:
        w = worded(text)
        for k in range(len(w) - run + 1):
            window = tuple(x for _, x in w[k: k + run])
            first[window] = min(first.get(window, (order(i, text), k)), (order(i, text), k))
    out = []
    for i, text, *_ in rows:
        w = worded(text)
        at = {k: first[tuple(x for _, x in w[k: k + run])] for k in range(len(w) - run + 1)}
        late = {k: f for k, f in at.items() if f < (order(i, text), k)}
        gone = {w[k + j][0] for k in late for j in range(run)}
        own = [x for _, x in w]
        longest = max((n for k in range(len(w)) for n in reach(said, order(i, text), own, k)), default=0)
        longest = longest if longest >= run else 0
        kept = "\n".join(x for k, x in enumerate((text or "").split("\n")) if k not in gone)
        out.append((i, len(w), len(gone), longest, kept))
    return sorted(out, key=str)


def runs(seed):
    rng = random.Random(seed)
    shared = [[f"line {rng.randint(0, 30)}" for _ in range(rng.randint(1, 9))] for _ in range(5)]
    out = []
    for i in range(50):
        t = []
        for _ in range(rng.randint(0, 4)):
            t += [f"own {rng.randint(0, 400)}" for _ in range(rng.randint(0, 2))] + rng.choice(shared) + [""] * rng.randint(0, 1)
        out.append((i, "\n".join(t), "en", "a", 0))
    out.append((90, "\n".join(["again"] * 30), "en", "a", 0))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("run", [1, 2, 3, 4, 7])
def test_equals_brute_force(spark, run):
    rows = runs(run) + [(200 + r[0] if r[0] is not None else None, *r[1:]) for r in cases.corpus(9, 40)]
    # Rows that share an id and a text are one document; every other id is its own.
    df = cases.clashing(cases.frame(spark, rows), "n_lines", "Version").repartition(3)
    out = lines.without_repeated_runs(df, run).collect()
    assert sorted((tuple(r) for r in out), key=str) == brute(rows, run)


def test_ranks_are_dense_and_ordered(spark):
    rng = random.Random(1)
    pairs = [(rng.randint(-9, 9), rng.randint(-9, 9)) for _ in range(400)]
    found = {(r.a, r.b): r["rank"] for r in lines.ranked(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()}
    often = sorted(p for p in set(pairs) if pairs.count(p) > 1)
    assert found == {p: k + 1 for k, p in enumerate(often)}


def test_longest_run_is_that_of_any_earlier_place(spark):
    # The first five lines occur first in 1, all ten in 2: lines of 3 repeat ten of 2, not seven of it behind three of 1.
    ten = [f"line {k}" for k in range(10)]
    rows = [(1, ten[:5]), (2, [*ten, "own"]), (3, ["new", *ten, "other"]), (4, ["new", *ten[2:9]]), (5, ["x"] * 9), (6, ["x"] * 12)]
    df = cases.frame(spark, [(i, "\n".join(t), "en", "a", 0) for i, t in rows])
    out = {r.doc_id: (r.n_removed, r.longest_run) for r in lines.without_repeated_runs(df).collect()}
    # Copies of themselves may overlap: all but the first of nine are one run, and twelve repeat nine, and their own eleven.
    assert out == {1: (0, 0), 2: (5, 5), 3: (10, 10), 4: (7, 7), 5: (8, 8), 6: (12, 11)}


def test_equal_texts_and_texts_of_one_id(spark):
    ten = "\n".join(f"line {k}" for k in range(10))
    rows = [(7, ten), (3, ten), (3, "a\nb"), (4, "a\nb"), (None, ten), (None, ten), (9, ten + "\n \n"), (9, None)]
    df = cases.frame(spark, [(i, t, "en", "a", 0) for i, t in rows])
    out = sorted(((r.doc_id, r.n_lines, r.n_removed, r.longest_run, r.kept_text) for r in lines.without_repeated_runs(df).collect()), key=str)
    assert out == sorted([(7, 10, 10, 10, ""), (3, 10, 0, 0, ten), (3, 2, 0, 0, "a\nb"), (4, 2, 0, 0, "a\nb"), (None, 10, 10, 10, ""),
                          (None, 10, 10, 10, ""), (9, 10, 10, 10, " \n"), (9, 0, 0, 0, "")], key=str)


def test_empty_table(spark):
    assert lines.without_repeated_runs(cases.frame(spark, [])).count() == 0
    assert [tuple(r) for r in lines.without_repeated_runs(cases.frame(spark, [(1, None, "en", "a", 0)])).collect()] == [(1, 0, 0, 0, "")]
