import pytest
from conftest import ABSENT, frame, message

from ordermill.functions.events import parse_events
from ordermill.operators import rules

CASES = [
    (message(), None),
    (message(channel="store", store_code="PAR01"), None),
    (message(channel="app"), None),
    (message(customer_email="not-an-email", product_ref="INVALID", quantity=0, unit_price_eur=-10, amount_eur=-10), "email"),
    (message(amount_eur=10.00), "amount"),
    *[(message(**{f: v}), f"missing_{f}")
      for f in ("order_id", "customer_email", "channel", "product_ref", "quantity", "unit_price_eur", "amount_eur",
                "order_timestamp")
      for v in (ABSENT, None, "")],
    # whitespace is content: it passes the required rule and fails the pattern
    (message(customer_email="  "), "email"),
    (message(order_id=" "), None),
    (message(order_id=None, customer_email=None), "missing_order_id"),
    (message(product_ref="UC-QK-01"), "product"),
    (message(product_ref="uc-ts-001"), "product"),
    (message(product_ref="UC-QK-١٢٣"), "product"),
    (message(product_ref="UC-QK-001\n"), None),
    (message(quantity=0, amount_eur=0), "quantity"),
    (message(quantity=-1), "quantity"),
    (message(unit_price_eur=0), "price"),
    (message(unit_price_eur=-1, amount_eur=-2), "price"),
    (message(quantity=1, unit_price_eur=41.30, amount_eur=41.25), None),
    (message(quantity=1, unit_price_eur=82.60, amount_eur=82.65), "amount"),
    (message(channel="phone"), "channel"),
    (message(channel="store"), "store"),
    (message(channel="store", store_code=""), "store"),
    (message(channel="store", store_code=" "), None),
    (message(amount_eur="82.60"), None),
    (message(amount_eur="much"), "amount_type"),
    (message(unit_price_eur="29,90"), "unit_price_type"),
    (message(unit_price_eur="x", amount_eur="y", quantity="z"), "unit_price_type"),
    (message(quantity="2"), "quantity_type"),
    (message(quantity=True), "quantity_type"),
    (message(quantity=1.5, amount_eur=61.95), "quantity_integer"),
    (message(quantity=2.0), None),
    (message(quantity=3_000_000_000, unit_price_eur=0.01, amount_eur=30_000_000), "quantity_integer"),
    (message(order_timestamp="yesterday"), "timestamp"),
    (message(order_timestamp="12:30"), "timestamp"),
    (message(order_timestamp="2026-06-20T10:00:00Z"), None),
    (message(order_timestamp="2026-06-20T10:00:00.123456+02:00"), None),
    (message(quantity=1, unit_price_eur=1e9, amount_eur=1e9), "money_range"),
    (message(order_id="x" * 51), "length_order_id"),
    (message(order_id="x" * 50), None),
    (message(amount_eur=float("nan")), "amount_type"),
    # faults are judged in order, type faults where a reader would meet them
    (message(customer_email="bad", amount_eur="y"), "email"),
    (message(quantity=1.5, channel="phone", amount_eur=61.95), "channel"),
    (message(order_timestamp="junk", channel="phone"), "channel"),
    ('{"order_id": "x", ', "bad_json"),
    ("", "bad_json"),
    (None, "bad_json"),
    ("[1, 2]", "bad_json"),
    ('"text"', "bad_json"),
    ("{}", "missing_order_id"),
]


@pytest.fixture(scope="module")
def verdicts(spark):
    judged = rules.judge(parse_events(frame(spark, [text for text, _ in CASES])))
    rows = judged.select("arrival", "error_code", rules.error_message().alias("reason")).collect()
    return {r["arrival"]: r for r in rows}


@pytest.mark.parametrize("number", range(len(CASES)))
def test_first_failing_rule(verdicts, number):
    assert verdicts[number]["error_code"] == CASES[number][1], CASES[number][0]


def test_every_reject_has_a_reason(verdicts):
    assert all((r["error_code"] is None) == (r["reason"] is None) for r in verdicts.values())


def test_reason_texts(spark):
    texts = [message(amount_eur=10.0), message(channel="phone"), message(product_ref=None)]
    judged = rules.judge(parse_events(frame(spark, texts)))
    found = [r[0] for r in judged.orderBy("arrival").select(rules.error_message()).collect()]
    assert found == ["Incoherence montant: attendu 82.6, recu 10.0", "Canal inconnu: phone",
                     "Champ obligatoire manquant: product_ref"]


def test_exact_tolerance_accepts_five_cents(spark):
    texts = [message(quantity=1, unit_price_eur=82.60, amount_eur=82.65),
             message(quantity=1, unit_price_eur=82.60, amount_eur=82.66)]
    judged = rules.judge(parse_events(frame(spark, texts)), rules.order_rules(exact=True))
    assert [r[0] for r in judged.orderBy("arrival").select("error_code").collect()] == [None, "amount"]


def test_offset_is_converted_to_utc(spark):
    parsed = parse_events(frame(spark, [message(order_timestamp="2026-06-20T10:00:00+02:00")]))
    assert parsed.selectExpr("cast(order_timestamp as string)").first()[0] == "2026-06-20 08:00:00"


def test_parser_runs_once_per_message(spark):
    """Neither filters nor projections may copy the JSON parser."""
    judged = rules.accepted(rules.judge(parse_events(frame(spark, [message()]))))
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
