import random

import numpy as np
import pytest

from ordermill.llm import decontaminate as D
from tests.llm import cases

ITEMS = "item_id long, text string, doc_id string"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij é") for _ in range(rng.randint(2, 9))).strip() or "x" for _ in range(n))


def nearest(window, text):
    """Fewest edits between the window and any part of the text."""
    row = np.zeros(len(text) + 1, int)
    for c in window:
        step = np.minimum(row[1:] + 1, row[:-1] + np.array([c != t for t in text], int))
        new = np.concatenate(([row[0] + 1], step))
        row = np.minimum.accumulate(new - np.arange(len(new))) + np.arange(len(new))
    return int(row.min())


def windows(item):
    t = D.normal(item)
    if len(t) < D.Q:
        return []
    last = max(len(t) - D.WINDOW, 0)
    return [t[s: s + D.WINDOW] for s in sorted({*range(0, last + 1, D.WINDOW // 2), last})]


def budget(window):
    return max(0, min(int(len(window) * D.EDIT_SHARE), len(window) // D.Q - 1))


def damaged(rng, text, edits):
    t = list(text)
    for _ in range(edits if len(t) > edits else 0):
        k = rng.randrange(len(t))
        kind = rng.randint(0, 2)
        if kind == 0:
            t[k] = rng.choice("xyz")
        elif kind == 1:
            del t[k]
        else:
            t.insert(k, rng.choice("xyz"))
    return "".join(t)


def data(seed):
    rng = random.Random(seed)
    items = [(k, prose(rng, rng.choice([1, 3, 12, 40, 70])), "theirs") for k in range(12)] + [(50, None, "t"), (51, "", "t"), (52, "short", "t")]
    items.append((53, items[4][1], "t"))
    docs = []
    for i in range(70):
        text = prose(rng, rng.randint(0, 60))
        if i % 2:
            source = rng.choice(items[:12])[1]
            text = f"{text} {damaged(rng, source, rng.randint(0, 12)).upper()}\n\n {prose(rng, rng.randint(0, 20))}"
        docs.append((i, text, "en", "a", 0))
    return items, docs + [(100, None, "en", "a", 0), (101, "", "en", "a", 0), (102, docs[1][1], "en", "a", 0), (102, docs[1][1], "en", "a", 0), (None, docs[1][1], "en", "a", 0)]


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_equal_brute_force(spark, seed):
    items, docs = data(seed)
    expected = {}
    for i, text, *_ in docs:
        for k, item, _ in items:
            found = [(e, w) for w, win in enumerate(windows(item)) if (e := nearest(win, D.normal(text))) <= budget(win)]
            if found:
                expected[i, k] = (len(found), min(e for e, _ in found))
    out = D.matches(cases.frame(spark, docs).repartition(3), spark.createDataFrame(items, ITEMS)).collect()
    assert {(r.doc_id, r.item_id): (r.n_windows, r.edits) for r in out} == expected and len(out) == len(expected)
    assert any(e for _, e in expected.values())


def test_blocks_of_items_change_nothing(spark):
    items, docs = data(3)
    df, bench = cases.frame(spark, docs), spark.createDataFrame(items, ITEMS)
    whole = D.matches(df, bench).select("doc_id", "item_id", "edits").collect()
    assert sorted(map(str, whole)) == sorted(map(str, D.matches(df, bench, block_chars=300).select("doc_id", "item_id", "edits").collect()))
    clean = D.clean(cases.clashing(df, "item_id", "edits"), bench, block_chars=300).collect()
    hit = {r.doc_id for r in whole}
    assert sorted(str(r.doc_id) for r in clean) == sorted(str(d[0]) for d in docs if d[0] not in hit)


def test_a_passage_in_a_very_long_text(spark):
    rng = random.Random(9)
    item = prose(rng, 40)
    text = prose(rng, 40_000) + " " + item + " " + prose(rng, 40_000)
    out = D.matches(cases.frame(spark, [(1, text, "en", "a", 0)]), spark.createDataFrame([(7, item, "t")], ITEMS)).collect()
    assert [(r.doc_id, r.item_id, r.edits) for r in out] == [(1, 7, 0)]
    assert D.normal(text)[out[0].last_end - 20: out[0].last_end] == D.normal(item)[-20:]


def test_a_match_is_not_carried_over_two_texts():
    index = D.build([(1, "abcdefghijklmnopqrstuvwxyz0123456789")])
    assert len(D.search(["abcdefghijklmnopqr", "stuvwxyz0123456789"], index)[0]) == 0
    assert len(D.search(["", "abcdefghijklmnopqrstuvwxyz0123456789"], index)[0]) > 0


def test_empty_tables(spark):
    items, docs = data(1)
    none, bench = cases.frame(spark, []), spark.createDataFrame(items, ITEMS)
    empty = spark.createDataFrame([], ITEMS)
    assert D.matches(none, bench).count() == 0 and D.matches(cases.frame(spark, docs), empty).count() == 0
    assert D.clean(cases.frame(spark, docs), empty).count() == len(docs) and D.clean(none, bench).count() == 0


def test_verbatim_excerpts_at_every_offset(spark):
    rng = random.Random(12)
    item = D.normal(prose(rng, 60))
    index = D.build([(7, item)])
    for size in (50, 51, 64, 93, 120):
        for k in range(len(item) - size + 1):
            hits = D.search(["zz " * 9 + item[k: k + size] + " zz" * 9, "zz " * 20], index)
            assert set(hits[0]) == {0}, (size, k)
    short = [(k, "zz" * 9 + item[k: k + 49] + "zz" * 9, "en", "a", 0) for k in range(0, len(item) - 49, 7)]
    part = (900, "zz " * 9 + item[30:105] + " zz" * 9, "en", "a", 0)
    df, bench = cases.frame(spark, [*short, part]), spark.createDataFrame([(7, item, "t")], ITEMS)
    out = D.matches(df, bench).collect()
    assert [(r.doc_id, r.item_id, r.n_windows, r.edits) for r in out] == [(900, 7, 0, 0)]
    assert {r.doc_id for r in D.clean(df, bench).collect()} == {r[0] for r in short}


def test_runs_of_one_character_stay_bounded(monkeypatch):
    """A text of blanks to fill in against an item that holds some: slices give what one pass gives, in little memory."""
    import tracemalloc

    item = "fill in the name here: " + "_" * 200 + " and sign below the line, please"
    index = D.build([(1, item)])
    texts = ["x" * 50 + "_" * 3_000 + " and sign below the line, please do", item + " and more", "-_" * 500, "nothing in common at all"]
    monkeypatch.setattr(D, "POSTINGS", 1 << 40)
    whole = sorted(zip(*(x.tolist() for x in D.search(texts, index)), strict=True))
    for size in (1, 50, 5_000):
        monkeypatch.setattr(D, "POSTINGS", size if size > 1 else 700)
        assert sorted(zip(*(x.tolist() for x in D.search(texts, index)), strict=True)) == whole
    assert {t for t, *_ in whole} == {0, 1}
    monkeypatch.undo()
    tracemalloc.start()
    D.search(["_" * 100_000], index)
    assert tracemalloc.get_traced_memory()[1] < 400 << 20
    tracemalloc.stop()


@pytest.mark.parametrize("kind", ["int", "string", "long"])
def test_ids_of_items_keep_their_type(spark, kind):
    docs = cases.frame(spark, [(1, "abcdefghijklmnop qrstuvwxyz 0123456789 abc " * 3, "en", "a", 0)])
    items = docs.selectExpr(f"cast(7 AS {kind}) AS item_id", "text").union(docs.selectExpr(f"cast(NULL AS {kind})", "text")).union(docs.selectExpr(f"cast(7 AS {kind})", "text"))
    out = D.matches(docs, items)
    assert dict(out.dtypes)["item_id"] == {"long": "bigint"}.get(kind, kind)
    assert {None if r.item_id is None else str(r.item_id) for r in out.collect()} == {"7", None}
