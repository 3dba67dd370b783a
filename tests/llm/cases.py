"""Small documents with every awkward case: nulls, empty and very long texts, ties, repeats, clashing columns."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
VOCABULARY = ["sun", "moon", "river", "stone", "of", "the", "and", "tree", "walks", "sings", "cold", "warm", "É", "日本", "x,", "y.", "old", "new", "fast", "slow"]


def words(rng, n):
    return [rng.choice(VOCABULARY) + rng.choice(["", "", str(rng.randint(0, 99))]) for _ in range(n)]


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    base = [" ".join(words(rng, rng.choice([1, 2, 5, 30, 80, 200]))) for _ in range(n // 2)]
    texts = list(base)
    while len(texts) < n:  # copies, near copies, shared passages, repeated lines
        t = rng.choice(base).split()
        kind = rng.randint(0, 3)
        if kind == 1 and t:
            t[rng.randrange(len(t))] = "changed"
        if kind == 2:
            t = words(rng, 12) + t[:60] + words(rng, 9)
        lines = " ".join(t).replace(" the ", "\n")
        texts.append(lines if kind != 3 else "\n".join([lines, "a line", "another line", "third line", "", lines]))
    texts += [None, "", " \t\n ", "one", "two words", " ".join(words(rng, 6000)), "The SAME again " * 40]
    rng.shuffle(texts)
    rows = [(i, t, rng.choice(["en", "fr", None]), rng.choice(["a", "b", "c", None]), None if t is None else len(t)) for i, t in enumerate(texts)]
    return rows + [rows[3], rows[3]] + [(None, "no id at all", "en", "a", 12), (None, None, None, None, None)]


def frame(spark, rows=None):
    return spark.createDataFrame(corpus() if rows is None else rows, SCHEMA)


def ids_once(rows):
    """Rows with an id, each id once."""
    return list({r[0]: r for r in rows if r[0] is not None}.values())


def clashing(df, *names):
    """The frame with columns of the names an operator adds, in another case too."""
    from pyspark.sql import functions as F

    for k, name in enumerate(names):
        df = df.withColumn(name.upper() if k % 2 else name, F.lit("theirs"))
    return df
