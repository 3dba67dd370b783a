import math
import re
from collections import Counter

import pytest

from ordermill.llm import ranking
from tests.llm import cases

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
ITEMS = [(1, "The river and the stone"), (2, "COLD warm cold cold"), (3, None), (4, ""), (5, "nowhere-to-be-found"), (6, "日本 É the sun99"), (6, "another text of the moon"),
         (1, "The river and the stone"), (None, "old new"), (8, " ".join(["tree"] * 500)), (9, "x-y_z sings!Sings")]


def terms(text):
    return re.findall(TERM, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, items, top=10):
    bags = [(r[0], Counter(terms(r[1]))) for r in rows]
    lengths = [sum(b.values()) for _, b in bags]
    n, total = sum(x > 0 for x in lengths), sum(lengths)
    held = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in {(i, t) for i, t in items}:
        scored = []
        for (doc, bag), length in zip(bags, lengths, strict=True):
            m = 100 - 75 + (75 * length * n) // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * held[t] + 1))) * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 8 * m)) for t in terms(text) if bag[t])
            if score > 0:
                scored.append((-score, doc is None, doc if doc is not None else 0))
        out += [(item, k, None if missing else doc, -score) for k, (score, missing, doc) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=repr)


def ranked(spark, rows, items, **bounds):
    docs = cases.clashing(cases.frame(spark, rows), "rank", "Score", "item_id", "key", "n_terms")
    asked = cases.clashing(spark.createDataFrame(items, "item_id long, text string"), "doc_id", "term", "Version")
    out = ranking.rank(docs, asked, **bounds)
    assert out.columns == ["item_id", "rank", "doc_id", "score"] and dict(out.dtypes)["score"] == "bigint" and dict(out.dtypes)["rank"] == "int"
    return sorted((tuple(r) for r in out.collect()), key=repr)


@pytest.mark.parametrize("bounds", [{}, {"most_items": 2, "most_terms": 5}, {"top": 3}])
def test_ranks_equal_brute_force(spark, bounds):
    rows = cases.corpus(2) + [(k, "the river, the stone", "en", "a", 0) for k in range(400, 430)] + [(500, "THE river the Stone", "en", "a", 0)]
    assert ranked(spark, rows, ITEMS, **bounds) == brute(rows, ITEMS, bounds.get("top", 10))


def test_equal_bags_of_other_lengths_are_classes_of_their_own(spark):
    rows = [(k, "sun " + "filler " * (k % 7) + "more" * (k % 2), "en", "a", 0) for k in range(80)]
    assert ranked(spark, rows, [(1, "sun")]) == brute(rows, [(1, "sun")])


def test_one_score_for_each_class(spark, monkeypatch, tmp_path):
    """Copies are scored once."""
    seen = tmp_path / "seen"
    original = ranking.scores

    def spied(bags, *rest):
        with open(seen, "a") as f:
            f.write(f"{len(bags)}\n")
        return original(bags, *rest)

    monkeypatch.setattr(ranking, "scores", spied)
    rows = [(k, f"sun moon {k % 3}", "en", "a", 0) for k in range(900)]
    assert len(ranked(spark, rows, [(1, "sun 1")])) == 10
    counted = [int(x) for x in seen.read_text().split()] if seen.exists() else []
    assert sum(counted) <= 2  # with and without the term "1"


def test_bags_round_trip_and_hash_hits_are_verified():
    import numpy as np

    packed = [ranking.pack(np.array([1, 5]), np.array([2, 7])), b"", ranking.pack(np.array([3]), np.array([9]))]
    assert [x.tolist() for x in ranking.unpack(packed)] == [[0, 0, 2], [1, 5, 3], [2, 7, 9]]


def test_empty_tables(spark):
    assert ranked(spark, [], ITEMS) == [] and ranked(spark, [(1, None, "en", "a", 0), (2, "--", "en", "a", 0)], ITEMS) == []
    assert ranked(spark, cases.corpus(2), []) == []
