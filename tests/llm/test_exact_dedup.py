"""Exact deduplication against plain Python, with copies across many ranges."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from vialflow.llm.exact_dedup import content_sort, drop_copies

SCHEMA = "doc_id long, text string"


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    return sorted((i, min(groups[norm(t)]), len(groups[norm(t)]), i == min(groups[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest())
                  for i, t in rows)


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_like_plain_python(spark, ranges):
    random.seed(ranges)
    words = ["a", "b", "ab", "é", "漢", " ", "\n", "\t ", "x" * 60]
    rows = [(i, "hot  text\nof all" if i % 3 == 0 else "".join(random.choices(words, k=random.randrange(6)))) for i in range(900)]
    rows += [(1000, None), (1001, ""), (1002, " "), (1003, "x" * 60 + "1"), (1004, "x" * 60 + "2"), (-5, "hot text of all"), (1005, "long " * 30000)]
    random.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    got = sorted(tuple(r) for r in content_sort(df, ranges=ranges).collect())
    assert got == expected(rows)
    kept = sorted(r.doc_id for r in drop_copies(df).collect())
    assert kept == sorted(i for i, k, *_ in expected(rows) if i == k)


def test_odd_rows(spark):
    rows = [(None, "same"), (2, "same"), (2, "same"), (None, "alone"), (None, "alone"), (3, None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("norm", F.lit("n")).withColumn("bucket", F.lit(1)).withColumn("row", F.lit(2))
    got = content_sort(df).collect()
    assert len(got) == 6 and sum(r.kept for r in got) == 3
    assert {(r.doc_id, r.keep_id, r.group_size) for r in got} == {(None, 2, 3), (2, 2, 3), (None, None, 2), (3, 3, 1)}
    out = drop_copies(df)
    assert out.columns == df.columns and sorted(map(str, (r.doc_id for r in out.collect()))) == ["2", "3", "None"]
    assert content_sort(spark.createDataFrame([], SCHEMA)).count() == 0


def test_all_pass_with_the_oracle(spark):
    from vialflow.llm.queries import SQL, op7_content_sort
    from vialflow.plans.compare import duck
    root = "/root/testdata/sf0.001"
    want = sorted(duck(root).execute(SQL["op7_content_sort"]).fetchall())
    assert sorted(tuple(r) for r in op7_content_sort(spark, root).collect()) == want
