import re

import pytest

from townlens.plans import staffing  # noqa: F401
from townlens.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["recovery_plan", "recovery_outcomes"])
def test_windows_of_a_plan_hold_no_texts(spark, name):
    lines = plan(QUERIES[name](spark, SF)).splitlines()
    below = lines[max(i for i, x in enumerate(lines) if "Window [" in x) + 1]
    assert "Project [" in below
    assert not re.search(r"(?:AS |\[|, )(?:text|url|path|category|content_type|contacts)#\d+L?(?:,|\])", below)
