import pytest
from conftest import message
from test_batch import house, run, seed  # noqa: F401

from ordermill import session
from ordermill.plans import batch
from ordermill.sources.retail import Retail
from ordermill.sources.tables import Warehouse


def plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def first_parts(spark):
    return spark.conf.get(session.FIRST_PARTS_SETTING, None)


@pytest.fixture()
def written(monkeypatch):
    """Plans of the slices and snapshots a load writes, by table."""
    plans = {}
    write, commit = Warehouse.write_slice, Warehouse.commit

    def spied_slice(self, df, layer, table, *more, **options):
        plans[table] = plan(df)
        return write(self, df, layer, table, *more, **options)

    def spied_commit(self, df, layer, table, *more, **options):
        plans[table] = plan(df)
        return commit(self, df, layer, table, *more, **options)

    monkeypatch.setattr(Warehouse, "write_slice", spied_slice)
    monkeypatch.setattr(Warehouse, "commit", spied_commit)
    return plans


def test_shuffles_of_a_load_begin_with_parts_for_its_rows(house, written, monkeypatch):  # noqa: F811
    monkeypatch.setattr(session, "TASK_ROWS", 5)
    run(house, [message(order_id=f"N{i}") for i in range(60)], 0)
    assert ", 12)" in written["streaming_orders"].split("hashpartitioning(order_id")[1].splitlines()[0]
    assert ", 12)" in written["fact_sales"].split("rangepartitioning(sales_month")[1].splitlines()[0]
    batch.rebuild_facts(house)
    assert ", 12)" in written["fact_sales"].split("rangepartitioning(load_id")[1].splitlines()[0]
    assert first_parts(house.spark) is None


def test_small_loads_keep_the_session_s_parts(house, written):  # noqa: F811
    run(house, [message(), message(order_id="B")], 0)
    assert ", 4)" in written["streaming_orders"].split("hashpartitioning(order_id")[1].splitlines()[0]


def test_parts_are_never_fewer_and_are_given_back(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 10)
    with session.sized(spark, 200):
        assert first_parts(spark) == "20"
        with session.sized(spark, 50):
            assert first_parts(spark) == "20"
        with pytest.raises(ValueError), session.sized(spark, 300):
            assert first_parts(spark) == "30"
            raise ValueError
        assert first_parts(spark) == "20"
    assert first_parts(spark) is None


def test_order_lines_are_spread_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 5)
    retail = Retail(spark, "none")
    retail._tables = {
        "lineitem": spark.sql("""SELECT id AS l_orderkey, 1 AS l_linenumber, id % 7 AS l_partkey, id % 3 AS l_suppkey, 2.0D AS l_quantity,
            9.0D AS l_extendedprice, 0D AS l_discount, 0D AS l_tax, 'N' AS l_returnflag, 'O' AS l_linestatus,
            timestamp'2026-06-20' AS l_shipdate FROM range(60)"""),
        "orders": spark.sql("SELECT id AS o_orderkey, id AS o_custkey FROM range(60)"),
        "part": spark.sql("SELECT id AS p_partkey, 'QK' AS p_type FROM range(7)"),
    }
    lines = retail.order_lines()
    assert "hashpartitioning(l_orderkey" in plan(lines)
    assert ", 12)" in plan(lines).split("hashpartitioning(l_orderkey")[1].splitlines()[0]
    assert lines.count() == 60
