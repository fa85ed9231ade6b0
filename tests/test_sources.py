"""CSV source and result sink round trips (O1, O3)."""

from outcomelab.plans.prepare import fixture_items
from outcomelab.sources.tables import read_csv, read_table, write_result

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_csv_round_trip_equals_the_parquet_table(spark, tmp_path):
    orders = read_table(spark, SF, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    path = str(tmp_path / "orders_csv")
    orders.write.option("header", True).csv(path)
    back = read_csv(spark, path, orders.schema)
    assert back.schema.simpleString() == orders.schema.simpleString()
    assert _rows(back) == _rows(orders)
    customers = read_table(spark, SF, "customer").select("c_custkey", "c_name")
    joined = [o.join(customers, o["o_custkey"] == customers["c_custkey"]).select("o_orderkey", "c_name") for o in (back, orders)]
    assert _rows(joined[0]) == _rows(joined[1])


def test_write_result_round_trip(spark, tmp_path):
    items = fixture_items(spark, SF)
    path = str(tmp_path / "result")
    write_result(items, path)
    assert _rows(spark.read.parquet(path).select(*items.columns)) == _rows(items)
    write_result(items, path, partition_by=["state"])      # overwritten, not appended
    assert spark.read.parquet(path).count() == items.count()
