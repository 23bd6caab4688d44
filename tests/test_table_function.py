"""The row-wise table function: its calls spread over the cores whatever the files."""

from millrace.plans import REGISTRY
from tests.conftest import SMALL


def test_table_function_is_spread_and_row_wise(spark):
    plan = REGISTRY["udf_04_table_function"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPythonUDTF" in plan and "RoundRobinPartitioning" in plan
