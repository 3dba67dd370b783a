import zlib

from pyspark.sql import functions as F

from ordermill.llm import sharding
from tests.llm import cases


def check(rows, placed, shards, near=None):
    assert sorted((r[0] is None, r[0], r[1] or "") for r in rows) == sorted((p.doc_id is None, p.doc_id, p.text or "") for p in placed)
    by = {}
    for p in placed:
        by.setdefault(p.shard, []).append(p)
    assert set(by) <= set(range(shards))
    for ps in by.values():
        assert sorted(p.slot for p in ps) == list(range(len(ps)))
    size = lambda t: len((t or "").encode()) + 1
    total, most = sum(size(r[1]) for r in rows), max((size(r[1]) for r in rows), default=0)
    for s in range(shards):  # an edge lies within one row, or the tolerance, of its target
        assert abs(sum(size(p.text) for p in by.get(s, [])) - total / shards) <= most + 0.01 * total + 1
    return by


def test_shards_are_near_equal_and_whole(spark):
    rows = cases.corpus(2, 300)
    df = cases.clashing(cases.frame(spark, rows), "slot", "shard", "_key")
    for shards, piece in ((16, 1 << 20), (4, 3_000), (1, 1 << 20)):
        placed = sharding.shard(df, shards, piece_bytes=piece).collect()
        check(rows, placed, shards)
        assert placed[0].asDict().keys() & {"shard", "slot"} == {"shard", "slot"}


def test_equal_texts_lie_side_by_side_and_a_large_group_is_split(spark):
    rows = [(i, "the same text " * 5, "en", "a", 1) for i in range(400)] + [(1000 + i, f"text {i} " * 9, "en", "a", 1) for i in range(600)]
    by = check(rows, sharding.shard(cases.frame(spark, rows), 8, tolerance=0.0).collect(), 8)
    holding = [s for s, ps in by.items() if any(p.doc_id < 1000 for p in ps)]
    assert 2 < len(holding) < 8
    for s in holding:
        slots = sorted(p.slot for p in by[s] if p.doc_id < 1000)
        assert slots == list(range(slots[0], slots[0] + len(slots)))


def test_wholly_equal_rows_are_split_too(spark):
    rows = [(7, "equal", "en", "a", 5)] * 320
    by = check(rows, sharding.shard(cases.frame(spark, rows), 16, tolerance=0.0).collect(), 16)
    assert {len(ps) for ps in by.values()} == {20}


def test_order_follows_the_key(spark):
    rows = cases.corpus(6, 120)
    placed = sharding.shard(cases.frame(spark, rows), 5).withColumn("h", F.lpad(F.hex(F.xxhash64(F.coalesce("text", F.lit("")))), 16, "0")).collect()
    ordered = [p.h for p in sorted(placed, key=lambda p: (p.shard, p.slot))]
    assert ordered == sorted(ordered)


def test_few_and_no_rows(spark):
    assert sharding.shard(cases.frame(spark, []), 16).count() == 0
    check([(1, "a", "en", "a", 1)], sharding.shard(cases.frame(spark, [(1, "a", "en", "a", 1)]), 16).collect(), 16)


def test_checksum_of_the_query():
    assert zlib.crc32(b"") == 0


def test_few_sums_reach_the_driver(spark, monkeypatch):
    counted = []
    original = sharding._below
    monkeypatch.setattr(sharding, "_below", lambda *given: (counted.append(original(*given)), counted[-1])[1])
    rows = spark.range(60_000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'a copy', repeat('x', cast(id % 40 AS int)) || id) AS text")
    placed = sharding.shard(rows, 16, piece_bytes=2_000)
    sums = placed.groupBy("shard").agg(F.sum(sharding.size_of(F.col("text"))).alias("b"), F.count("*").alias("n"), F.max("slot").alias("last")).collect()
    assert max(r.b for r in sums) - min(r.b for r in sums) <= 100 and all(r.last == r.n - 1 for r in sums) and sum(r.n for r in sums) == 60_000
    assert sum(map(len, counted)) < 20_000 and placed.select("shard", "slot").distinct().count() == 60_000


def test_the_query(spark, tmp_path):
    """Columns of the registered query against their definitions, and no Python in its plan."""
    import zlib

    from ordermill.llm.queries import REGISTRY

    rows = cases.corpus(5)
    cases.frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    out = REGISTRY["op2_histogram_sharding"](spark, str(tmp_path))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
    data = lambda t: (t or "").encode()
    assert sorted(((r.doc_id, r.size, r.text_crc32, r.law, r.grown_shard) for r in out.collect()), key=repr) == sorted(
        ((r[0], len(data(r[1])) + 1, zlib.crc32(data(r[1])), "bytes", None) for r in rows), key=repr)
    assert dict(out.dtypes) == {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"}
