import random
import re

import pyarrow as pa

from ordermill.llm import words as W


def test_words_and_runs_of_any_text():
    rng = random.Random(5)
    pieces = ["a", "bb", "é", "日", " ", "\n", "\t", "\x0b", "  ", " ", "Z"]
    for _ in range(150):
        texts = [rng.choice([None, "", "".join(rng.choice(pieces) for _ in range(rng.randint(0, 40)))]) for _ in range(rng.randint(0, 7))]
        column = pa.array(texts, pa.string())
        w = W.split(column)
        expected = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for t in texts]
        assert w.counts.tolist() == [len(x) for x in expected]
        flat = [x for e in expected for x in e]
        assert [w.data[a:b].tobytes() for a, b in zip(w.start, w.end)] == flat
        h = w.hashes()
        assert len(set(h.tolist())) == len(set(flat)) and all((h[i] == h[j]) == (flat[i] == flat[j]) for i in range(len(flat)) for j in range(i))
        runs, at, first = W.runs(w, h, 3)
        named = [tuple(e[k: k + 3]) for e in expected for k in range(len(e) - 2)]
        assert len(runs) == len(named) == first[-1] and len(set(runs.tolist())) == len(set(named))
        assert all(tuple(flat[k: k + 3]) == n for k, n in zip(at.tolist(), named))


def test_a_sliced_column_and_long_words():
    texts = ["skipped", "z" * 700_000 + " abc " + "y" * 600_000, None, "abc"]
    w = W.split(pa.array(texts).slice(1))
    h = w.hashes()
    assert w.counts.tolist() == [3, 0, 1] and h[1] == h[3] and len(set(h.tolist())) == 3
    assert [bytes(w.data[a:b])[:3] for a, b in zip(w.start, w.end)] == [b"zzz", b"abc", b"yyy", b"abc"]


def test_groups_of_rows_hold_whole_texts():
    column = pa.array(["aaaa", "", None, "b" * 50, "cc", "dd"])
    parts = list(W.batches(column, 6))
    assert [lo for lo, _ in parts] == [0] + [hi for _, hi in parts][:-1] and parts[-1][1] == 6
    assert (3, 4) in parts or any(lo <= 3 < hi for lo, hi in parts)


def test_lower_case_is_for_ascii_only():
    w = W.split(pa.array(["AbZ É"]), lower=True)
    assert w.data.tobytes().decode() == "abz É"
