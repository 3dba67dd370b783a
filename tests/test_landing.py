from conftest import frame, message

from ordermill.functions.events import parse_events
from ordermill.operators import landing, rules


def judged(spark, texts):
    return rules.judge(parse_events(frame(spark, texts)))


def test_first_arrival_wins(spark):
    landed = landing.land(judged(spark, [message(quantity=1, amount_eur=41.30), message(), message()])).collect()
    assert [(r["order_id"], r["quantity"]) for r in landed] == [("WEB-1", 1)]


def test_reject_does_not_block_a_later_valid_event(spark):
    landed = landing.land(judged(spark, [message(channel="phone"), message()])).collect()
    assert [r["channel"] for r in landed] == ["web"]


def test_counters_add_up(spark):
    texts = [message(), message(), message(order_id="B"), message(channel="phone"), "{bad"]
    row = landing.batch_counters(judged(spark, texts)).first()
    assert row.asDict() == {"messages_read": 5, "events_failed": 2, "events_consumed": 2, "events_duplicate": 1}


def test_not_yet_landed(spark):
    batch = landing.land(judged(spark, [message(order_id=f"A{i}") for i in range(20)]))
    before = spark.createDataFrame([(f"A{i}",) for i in range(5, 50)], "order_id string")
    assert sorted(r["order_id"] for r in landing.not_yet_landed(batch, before).collect()) == sorted(f"A{i}" for i in range(5))


def test_hot_order_is_cut_down_before_the_shuffle(spark):
    plan = landing.land(judged(spark, [message()] * 3))._jdf.queryExecution().executedPlan().toString()
    partial, exchange = plan.index("row_number(), 1, Partial"), plan.index("Exchange hashpartitioning(order_id")
    assert exchange < partial  # printed top-down: the limit lies below the exchange


def test_failed_events_keep_text_and_reason(spark):
    rows = landing.failed_events(judged(spark, [message(channel="phone"), "{bad", message()])).collect()
    assert sorted((r["error_code"], r["payload"][:4]) for r in rows) == [("bad_json", "{bad"), ("channel", '{"or')]
    assert len({r["failed_id"] for r in rows}) == 2


def test_dead_letters(spark):
    failed = landing.failed_events(judged(spark, [message(channel="phone"), "{bad"]))
    read = landing.dead_letters(failed).selectExpr(
        "get_json_object(value, '$.original.channel') channel", "get_json_object(value, '$.original.text') text",
        "get_json_object(value, '$.error') error").collect()
    assert sorted(map(tuple, read), key=str) == sorted(
        [("phone", None, "Canal inconnu: phone"), (None, "{bad", "JSON illisible")], key=str)
