"""The walk of nested containers as a query."""

from pagewright.plans import catalogue


def test_walk_goes_below_twelve_levels(spark, tmp_path):
    keys = [3**i for i in range(15)]
    spark.createDataFrame([(k,) for k in keys], "c_custkey long").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(1,)], "n_nationkey int").write.parquet(f"{tmp_path}/nation.parquet")
    got = {(r.node, r.depth) for r in catalogue.container_walk(spark, str(tmp_path)).collect()}
    assert got == {(k, i) for i, k in enumerate(keys)}
