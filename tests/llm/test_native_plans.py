import re

import pytest

from bioobs.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op8_source_mix", "op9_url_filter"])
def test_native_queries_plan_no_python_and_no_cross_join(spark, name):
    text = QUERIES[name](spark, FOLDER)._jdf.queryExecution().toString()
    assert not re.search("InPandas|EvalPython|PythonUDF|InArrow", text)
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
