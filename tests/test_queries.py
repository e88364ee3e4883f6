import oracle
import pytest

from townlens.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_twin(spark, duck, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        assert oracle.differences(df, duck, ORACLES[name]) == ""
    else:
        df.count()
