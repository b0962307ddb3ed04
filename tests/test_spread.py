"""Forms made from a file of one row group are made by all cores, and the rows are the same."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from fieldtally.driver import raw_forms as raw

CUSTOMERS = pa.table({
    "c_custkey": pa.array([1, 2, 2, None, *range(5, 400)], pa.int64()), "c_name": [f"c{i}" for i in range(399)],
    "c_nationkey": pa.array([i % 25 for i in range(399)], pa.int32()), "c_acctbal": [0.5] * 399,
    "c_mktsegment": ["BUILDING"] * 399})


@pytest.mark.parametrize("form", ["readiness", "monitoring"])
def test_forms_of_one_row_group(spark, tmp_path, form):
    pq.write_table(CUSTOMERS, tmp_path / "customer.parquet")
    rows = raw.LANDED[form](spark, str(tmp_path)).select("_id", F.spark_partition_id().alias("task")).collect()
    assert len({r.task for r in rows}) >= spark.sparkContext.defaultParallelism
    assert sorted(r._id or "" for r in rows) == sorted("" if k is None else str(k) for k in CUSTOMERS["c_custkey"].to_pylist())
