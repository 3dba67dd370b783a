import random

from ordermill.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, part string"


def conversations(seed=1):
    rng = random.Random(seed)
    out, texts = [], ["hi", "hello <|user|>", "", None, "same"]
    logs = {}
    for c in range(60):
        if logs and rng.random() < 0.6:
            base = rng.choice(list(logs.values()))
            log = base[: rng.randint(1, len(base))] + [(rng.choice(["user", None]), rng.choice(texts)) for _ in range(rng.randint(0, 2))]
        else:
            log = [(rng.choice(["user", "assistant", "system", None]), rng.choice(texts)) for _ in range(rng.randint(1, 9))]
        logs[c] = log
        gap = rng.choice([1, 3])
        out += [(c, 5 + gap * k, role, text, "theirs") for k, (role, text) in enumerate(log)]
    out += [(None, 1, "user", "nobody", "t"), (99, None, "user", "first", "t"), (99, 4, "user", "tie", "t"), (99, 4, "user", "tie", "t")]
    rng.shuffle(out)
    return out


def brute(rows, per_part):
    none = lambda v: (v is not None, v if v is not None else "")
    logs = {}
    for c, turn, role, text, _ in sorted(rows, key=lambda r: (none(r[1]) if r[1] is not None else (False, 0), none(r[2]), none(r[3]))):
        logs.setdefault(c, []).append((role, text))
    out = set()
    for c, log in logs.items():
        equal = [d for d, other in logs.items() if other == log]
        if any(len(o) > len(log) and o[: len(log)] == log for o in logs.values()) or c != min(equal, key=lambda d: (d is None, d)):
            continue
        for p in range(0, len(log), per_part):
            said = "".join(f"<|{(r if r is not None else 'unknown')}|>\n{(t or '').replace('<|', '< |')}\n<|end|>\n" for r, t in log[p: p + per_part])
            out.add((c, p // per_part, len(log), len(equal), said))
    return out


def test_maximal_conversations(spark):
    for seed in (1, 2):
        rows = conversations(seed)
        df = spark.createDataFrame(rows, SCHEMA)
        turns = chat.positioned(df, block=3)
        kept = chat.maximal(turns)
        found = {(r.conv_id, r.part, r.n_turns, r.rendered) for r in chat.render(turns, 2).collect()}
        copies = {r.conv_id: r.n_copies for r in kept.collect()}
        assert {(c, p, n, copies[c], s) for c, p, n, s in found if c in copies} == brute(rows, 2)


def test_whole_operator(spark):
    rows = conversations(3)
    assert {tuple(r) for r in chat.collapse_and_render(spark.createDataFrame(rows, SCHEMA)).collect()} == brute(rows, 256)


def test_a_common_first_turn_collapses_nothing_else(spark):
    rows = [(c, t, "user", "start" if t == 0 else f"{c}-{t}", "") for c in range(50) for t in range(2)] + [(100, 0, "user", "start", "")]
    out = chat.collapse_and_render(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.conv_id for r in out} == set(range(50))


def test_empty_table(spark):
    assert chat.collapse_and_render(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = chat.collapse_and_render(spark.createDataFrame(conversations(), SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
