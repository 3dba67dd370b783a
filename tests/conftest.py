import json
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from ordermill.session import local_session  # noqa: E402

VALID = {
    "order_id": "WEB-1",
    "customer_email": "ann@shop.com",
    "channel": "web",
    "store_code": None,
    "product_ref": "UC-QK-001",
    "quantity": 2,
    "unit_price_eur": 41.30,
    "amount_eur": 82.60,
    "order_timestamp": "2026-06-20T08:25:00+00:00",
}
ABSENT = object()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("ordermill-tests", cores="4", shuffle_partitions="4", memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    return session


def message(**changes) -> str:
    """A valid order message with changes; ABSENT leaves the field out."""
    fields = {**VALID, **changes}
    return json.dumps({k: v for k, v in fields.items() if v is not ABSENT})


def frame(spark, texts, topic="orders.web"):
    """Messages arriving in the given order."""
    rows = [(topic, i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "topic string, arrival long, value string")
