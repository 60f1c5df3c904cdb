import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from compare import difference, duck

from perkline.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14)) and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, name):
    assert difference(spark, duck(SF), SF, QUERIES[name], ORACLE[name]) is None
