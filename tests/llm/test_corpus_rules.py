import collections
import random
import re

import numpy as np
import pyarrow as pa

from ordermill.llm import rules
from tests.llm import cases

WORD = r"[^\x20\x09-\x0D]+"


def brute(text):
    t = text or ""
    w = re.findall(WORD, t)
    lines = [x for x in t.split("\n") if re.search(WORD, x)]
    three = collections.Counter(zip(w, w[1:], w[2:]))
    covered = {k + i for k in range(len(w) - 2) if three[tuple(w[k: k + 3])] > 1 for i in range(3)}
    counts = len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)
    upper, letters = len(re.findall("[A-Z]", t)), len(re.findall("[A-Za-z]", t))
    n, chars, symbols, dup, repeat = counts
    base = n < 50 or 100 * repeat > 50 * n
    bad = base or 10 * symbols > n or 2 * dup > len(lines) or not 2 * n <= chars <= 12 * n or 2 * upper > letters
    return (*counts, not bad)


def test_counts_and_verdicts(spark):
    rows = cases.corpus(3, 80) + [(900, "#bad " * 60, "en", "a", 0), (901, "UPPER CASE WORDS %d " * 30, "en", "a", 0), (902, "same line here\n" * 40 + " ".join(f"w{i}" for i in range(200)), "en", "a", 0)]
    out = rules.cascade(cases.clashing(cases.frame(spark, rows), "kept", "N_words"), measures=True).collect()
    found = sorted(((r.doc_id, r.text), tuple(r[m] for m in rules.MEASURES) + (r.kept,)) for r in out if r.doc_id is not None)
    assert found == sorted(((r[0], r[1]), brute(r[1])) for r in rows if r[0] is not None)
    assert len(out) == len(rows) and all((r.rejected_by is None) == r.kept for r in out)


def test_order_changes_no_verdict_and_spares_rejected_texts():
    texts = pa.array([r[1] for r in cases.corpus(4)])
    expected = rules.judge(texts, rules.RULES) < 0
    seen = []
    for seed in range(5):
        order = list(rules.RULES)
        random.Random(seed).shuffle(order)
        spied = tuple(rules.Rule(r.name, lambda f, r=r: (seen.append((r.name, len(f.texts))), r.rejects(f))[1]) for r in order)
        assert ((rules.judge(texts, spied) < 0) == expected).all()
    assert min(n for _, n in seen) < len(texts)


def test_rules_go_by_rejections_per_cost():
    figures = {"few_words": (1.0, 0.5), "symbols": (0.1, 0.2), "capitals": (5.0, 0.0)}
    assert [r.name for r in rules.ordered(rules.RULES, figures)][:2] == ["symbols", "few_words"]


def test_estimates_come_from_the_rows(spark):
    figures = rules.estimate(cases.frame(spark, [(i, "word", "en", "a", 4) for i in range(100)]), rules.RULES)
    assert figures["few_words"][1] == 1.0 and figures["symbols"][1] == 0.0 and all(c > 0 for c, _ in figures.values())


def test_empty_table(spark):
    assert rules.cascade(cases.frame(spark, []), measures=True).count() == 0


def test_lines_at_text_edges():
    f = rules.Features(pa.array(["a\n", "a", "\na\na", "", None, "a\n\n\na\n"]))
    assert np.array_equal(f.n_lines, [1, 1, 2, 0, 0, 2]) and np.array_equal(f.n_dup_lines, [0, 0, 1, 0, 0, 1])


def test_counts_known_already_do_not_end_the_cascade():
    """With all texts counted, as the registered query asks, later rules still see survivors only."""
    texts = pa.array([r[1] for r in cases.corpus(4)])
    whole = rules.Features(texts)
    for name in rules.MEASURES:
        getattr(whole, name)
    seen = []
    spied = tuple(rules.Rule(r.name, lambda f, r=r: (seen.append((r.name, len(f.texts), "n_letters" in f.__dict__)), r.rejects(f))[1]) for r in rules.RULES)
    verdict = rules.judge(texts, spied, whole)
    assert (verdict == rules.judge(texts, rules.RULES)).all()
    assert [n for _, n, _ in seen] == [len(texts) - int(((verdict >= 0) & (verdict < k)).sum()) for k in range(len(seen))]
    assert seen[0][1] == len(texts) > seen[1][1] and not any(counted for *_, counted in seen)  # letters are counted for those that reach the last rule
