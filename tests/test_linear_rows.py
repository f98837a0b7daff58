"""The registered rows of the linear preparation cover every feature of the mart."""

import pytest

import __spark_entry__ as entry
from conftest import TESTDATA
from workload import applicant

pytestmark = pytest.mark.skipif(not TESTDATA.exists(), reason="no test data")


def test_linear_rows_hold_every_feature_of_the_mart(spark):
    queries = entry.queries()
    held = [c for name in ("linear_numbers", "linear_levels") for c in queries[name](spark, str(TESTDATA)).columns]
    features = set(applicant.mart(spark, str(TESTDATA)).columns) - {"sk_id_curr", "target", "is_train"}
    assert len(features) == 132
    assert sorted(held) == sorted([*features, "sk_id_curr", "sk_id_curr"])
