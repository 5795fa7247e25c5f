"""D2 over all edges: cycles that an order with status P closes, and declared dimensions without any edge."""

import datetime
import os

import __spark_entry__ as entry

from conftest import SF01


def test_all_cyclic_dimensions_are_found(spark):
    rows = entry.queries()["edge_table_validity_all"](spark, SF01).collect()
    assert len(rows) == 1500 and sum(r.n_edges for r in rows) == 14698
    assert sum(r.reason == "CYCLE" for r in rows) == sum(not r.valid for r in rows) == 867


def test_dropped_order_closes_a_cycle_and_a_customer_without_orders_is_empty(spark, scratch):
    day = datetime.date(2000, 1, 1)
    # L1 -> L2 (order 33), L2 -> L1 (order 18, status P); customer 8 has no order
    orders = [(33, 4, "O", day), (18, 4, "P", day), (33, 5, "O", day)]
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate date").write.parquet(os.path.join(scratch, "orders.parquet"))
    spark.createDataFrame([(4,), (5,), (8,)], "c_custkey bigint").write.parquet(os.path.join(scratch, "customer.parquet"))
    got = {r.dimension_id: (r.n_edges, r.n_residue, r.reason, r.valid) for r in entry.queries()["edge_table_validity_all"](spark, scratch).collect()}
    assert got == {"D4": (2, 2, "CYCLE", False), "D5": (1, 0, None, True), "D8": (0, 0, None, True)}
