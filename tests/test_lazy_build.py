"""Building a relational query runs nothing but reads of Parquet schemas."""

import pytest

from conftest import SF0001

EAGER = ("forest", "kmeans", "silhouette", "feature_table", "one_hot", "fact_sample")


def test_relational_queries_build_without_jobs(spark, queries):
    from vialflow.plans.explain import jobs_while_built
    found = {}
    for name, q in queries.items():
        if not name.startswith(EAGER):
            _, jobs = jobs_while_built(spark, lambda q=q: q(spark, SF0001))
            if jobs:
                found[name] = jobs
    assert not found


@pytest.mark.parametrize("name", ["feature_table"])
def test_eager_work_is_counted(spark, queries, name):
    from vialflow.plans.explain import jobs_while_built
    assert jobs_while_built(spark, lambda: queries[name](spark, SF0001))[1] > 0
