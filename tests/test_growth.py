from datetime import datetime

import pytest
from conftest import message
from pyspark.sql import functions as F

from ordermill.operators import lookup
from ordermill.plans import queries


class Messages:
    """Stands for the retail tables: messages alone."""

    def __init__(self, spark, texts, parts=1):
        self.spark, self.texts, self.parts = spark, texts, parts

    def order_messages(self):
        rows = [("orders.web", i, t) for i, t in enumerate(self.texts)]
        return self.spark.createDataFrame(rows, "topic string, arrival long, value string").repartition(self.parts)


@pytest.mark.parametrize("parts", (1, 15))
def test_deduplicated_stream_has_as_many_files_as_the_messages_have_parts(spark, monkeypatch, parts):
    seen = []
    replay = queries.captured_orders

    def spied(session, folder, schema, files_per_batch):
        seen.append((len(session.read.schema(schema).parquet(folder).inputFiles()), files_per_batch))
        return replay(session, folder, schema, files_per_batch)

    monkeypatch.setattr(queries, "captured_orders", spied)
    texts = [message(order_id=f"WEB-{i % 30}") for i in range(60)]
    kept = queries.stream_deduplicated(Messages(spark, texts, parts))
    assert sorted(r.order_id for r in kept.collect()) == sorted({f"WEB-{i}" for i in range(30)})
    assert seen == [(parts, -(-parts // 3))]


def test_judged_table_holds_the_text_of_rejects_alone(spark):
    stored = queries.judged_once(Messages(spark, [message(), message(channel="phone"), "{bad"]))
    texts = {r.error_code: r.payload for r in stored.collect()}
    assert texts[None] is None and texts["bad_json"] == "{bad" and '"phone"' in texts["channel"]


def test_monthly_counts_store_no_text_of_accepted_messages(spark, monkeypatch):
    stored = []
    keep = queries.materialise
    monkeypatch.setattr(queries, "materialise", lambda df, label: stored.append(keep(df, label)) or stored[-1])
    counts = queries.monthly_counts(Messages(spark, [message(), message(), message(channel="phone")])).collect()
    assert [tuple(r) for r in counts] == [(datetime(2026, 6, 1).date(), 3, 1, 1)]
    assert stored[0].filter(F.col("error_code").isNull() & F.col("payload").isNotNull()).count() == 0


def test_keys_are_counted_by_hash_before_they_are_shuffled(spark):
    rows = spark.range(3000).select(F.when(F.col("id") < 900, "busy").when(F.col("id") % 5 > 0, F.col("id").cast("string")).alias("k"))
    hot = lookup.hot_keys(rows, "k", rows_per_salt=100)
    assert "hashpartitioning(_group" in hot._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in hot.collect()] == [("busy", 9)]
