import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from oracle import compare, connection  # noqa: E402

from cohortloom.llm.registry import QUERIES, SQL  # noqa: E402


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, small, name):
    compare(QUERIES[name](spark, small), connection(small), SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, small, name):
    df = QUERIES[name](spark, small)
    assert df.columns and df.count() > 0


def test_columns_of_found(spark, small):
    want = {
        "p3_found": "entered_value string canonical_name string", "p4_found": "trial_id_a string trial_id_b string", "p5_found": "sponsor_a string sponsor_b string",
        "p6_found": "name_id bigint group_id bigint", "p7_ids": "doc_id bigint ids array<int>", "p9_found": "doc_id bigint reading_level int",
    }
    for name, cols in want.items():
        assert " ".join(f"{c} {t}" for c, t in QUERIES[name](spark, small).dtypes) == cols
