import subprocess
import sys
from pathlib import Path

import pytest

from siteloom.plans import catalogue

REPO = Path(__file__).parents[1]


@pytest.mark.parametrize("name", list(catalogue.queries()))
def test_same_rows_as_sql(name, same):
    same(catalogue.queries()[name], catalogue.oracle_sql()[name])


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 1
    assert set(e.oracle_sql()) <= set(e.queries())


def test_entry_without_the_training_data_package():
    """As if the folders were deleted: their names can't be found."""
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('siteloom.llm'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert 'regen_kpis' in e.queries() and 'pipeline' not in e.queries() and e.oracle_sql()"
    )
    subprocess.run([sys.executable, "-c", code], cwd=REPO, check=True)


def test_plans_have_no_python_and_prune_columns(spark):
    from tests.conftest import DATA

    plan = catalogue.queries()["full_cascade"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    plan = catalogue.queries()["confidence_band"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "l_shipdate" not in plan and "Exchange" not in plan
