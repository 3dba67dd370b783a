import random

import numpy as np
import pyarrow as pa
import pytest

from ordermill.llm import periods, words
from tests.llm import cases


def brute(said, least=6, exponent=4):
    found = {}
    for q in range(1, len(said) // exponent + 1):
        i = 0
        while i + q < len(said):
            j = i
            while j + q < len(said) and said[j] == said[j + q]:
                j += 1
            if j + q - i >= max(least, exponent * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i) + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def kept(said, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(said) if i not in gone)


def repetitive(seed, n=150):
    """Texts of stretches with roots of 1 to 40 words of few kinds, so that runs touch, overlap and nest."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        said = []
        for _ in range(rng.randint(1, 5)):
            root = [rng.choice("abc") for _ in range(rng.choice([1, 2, 3, 4, 5, 7, 8, 9, 16, 40]))]
            length = rng.randint(1, 6 * len(root) + 3)
            said += (root * 8)[:length] + [rng.choice("abcd") for _ in range(rng.randint(0, 6))]
        out.append(said)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_brute_force(seed):
    said = [*repetitive(seed), [], ["a"], ["a"] * 5, ["a"] * 6, ["a"] * 1000, ["a", "b"] * 300 + ["c"] + ["b", "a"] * 257]
    w = words.split(pa.array([" ".join(s) for s in said]))
    found = [[] for _ in said]
    for k, *run in zip(*(x.tolist() for x in periods.runs(w.hashes(), w.first)), strict=True):
        found[k].append(tuple(run))
    assert found == [brute(s) for s in said]


def test_transform_is_exact():
    rng = np.random.default_rng(1)
    for size in (1, 2, 8, 32):
        blocks = rng.integers(0, periods.PRIME, (5, size)).astype(np.uint64)
        windows = rng.integers(0, periods.PRIME, (5, 2 * size)).astype(np.uint64)
        windows[0, : size] = blocks[0]
        expected = [[sum((int(a) - int(b)) ** 2 for a, b in zip(x, y[k: k + size], strict=True)) % periods.PRIME for k in range(size)]
                    for x, y in zip(blocks, windows, strict=True)]
        assert periods.mismatches(blocks, windows).tolist() == expected and expected[0][0] == 0


def test_smaller_exponents_are_refused():
    with pytest.raises(ValueError):
        periods.runs(np.zeros(8, np.uint64), np.array([0, 8]), exponent=2)


def test_documents(spark):
    rows = cases.corpus(6) + [(700 + k, " ".join(s), "en", "a", 0) for k, s in enumerate(repetitive(9, 40))] + [(800, "one two\t three\n" * 2000, "en", "a", 0)]
    docs = cases.clashing(cases.frame(spark, rows), "runs", "Kept_text", "n_words")
    out = periods.collapsed(docs)
    assert out.columns == ["doc_id", "n_words", "runs", "kept_text"]
    found = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.kept_text) for r in out.collect()), key=repr)
    expected = []
    for r in rows:
        said = (r[1] or "").split()  # the fixture has no other white space than the six blanks
        runs = brute(said)
        expected.append((r[0], len(said), runs, kept(said, runs)))
    assert found == sorted(expected, key=repr)
    assert max(n for _, n, _, _ in found) >= 6000 and sum(len(x) for _, _, x, _ in found) > 50


def test_empty_table_and_text_ids(spark):
    assert periods.collapsed(cases.frame(spark, [])).count() == 0
    named = spark.createDataFrame([("x", "a " * 9), (None, None)], "name string, body string")
    assert {(r.doc_id, len(r.runs), r.kept_text) for r in periods.collapsed(named, "name", "body").collect()} == {("x", 1, "a"), (None, 0, "")}


def test_planted_cycles(spark):
    """The query's texts against the rule written out."""
    import zlib

    from ordermill.llm.queries import with_cycles

    rows = [(i, " ".join(f"w{k}" for k in range(i % 37)), "en", "a", 0) for i in range(300)] + [(None, "a b", "en", "a", 0), (5, None, "en", "a", 0)]
    found = sorted(((r.doc_id, (r.text or "").split()) for r in with_cycles(cases.frame(spark, rows)).collect()), key=repr)
    expected = []
    for doc, text, *_ in rows:
        said = (text or "").split()
        h, n = zlib.crc32(str(doc).encode()) if doc is not None else 1, len(said)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            said = [said[i] if i < a else said[a + (i - a) % p] for i in range(n)]
        expected.append((doc, said))
    assert found == sorted(expected, key=repr)


def test_only_the_drawn_tenth_is_cut_into_words(spark):
    from ordermill.llm.queries import with_cycles

    plan = with_cycles(cases.frame(spark, []).repartition(1))._jdf.queryExecution().optimizedPlan().toString()
    before = plan.split("regexp_extract_all(")[:-1]
    assert before and all(p.endswith("= 0) THEN ") for p in before)
