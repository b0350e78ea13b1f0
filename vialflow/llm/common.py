"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, ship_package

# ASCII white space of the contracts: space and 0x09-0x0D
SPACE = r"[\x20\x09-\x0D]"
# shuffle files go when the write that made them ends, not when the driver collects its garbage
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return table(spark, sf_dir, "documents")


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting for the writes within."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back: lineage is cut
    and every later use sees the same rows, also after a lost executor. The shuffle files of the
    write go with its end: the disk holds stored tables and one write's shuffles."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/vialflow-{name}-{uuid.uuid4().hex}"
    with setting(spark, CLEANUP, "true"):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Delete the files of a table made by ``stored`` that no later plan reads."""
    spark = df.sparkSession
    jvm = spark._jvm
    for f in df.inputFiles()[:1]:
        path = jvm.org.apache.hadoop.fs.Path(f).getParent()
        if path.getName().startswith("vialflow-"):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def normal_space(text: Column) -> Column:
    """Replace each run of ASCII white space by one space. The pattern skips runs that are
    one space already, so ordinary text is copied in long stretches."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def ordered_id(col: Column) -> Column:
    """A 16-character key that sorts like the long ``col`` (nulls last)."""
    return F.coalesce(F.lpad(F.hex(col.cast("long").bitwiseXOR(F.lit(-2**63))), 16, "0"), F.lit("G"))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket_of(key: Column, splitters: list[str], below: bool = False) -> Column:
    """Number of splitters not above ``key`` (``below``: under it); splitters ascending. Looks
    up in two levels, so a row compares with about 2 * sqrt(n) splitters."""
    if not splitters:
        return F.lit(0)
    m = max(1, int(len(splitters) ** 0.5))
    groups = [splitters[i:i + m] for i in range(0, len(splitters), m)]

    def lits(xs):
        return F.array(*[F.lit(x) for x in xs])

    def at_most(arr):
        return F.size(F.filter(arr, lambda s: (s < key) if below else (s <= key)))

    heads = lits([g[0] for g in groups])
    top = at_most(heads)
    inner = at_most(F.element_at(F.array(*[lits(g) for g in groups]), F.greatest(top, F.lit(1))))
    return F.when(top == 0, F.lit(0)).otherwise((top - 1) * F.lit(m) + inner)


def sampled_splitters(keys: DataFrame, n: int, rows: int, per_bucket: int = 40) -> list[str]:
    """At most n-1 ascending splitters of the string column ``k``, from a sample of about
    ``per_bucket * n`` rows (the documented bound on what reaches the driver). The sample
    decides only where ranges are cut; no row is dropped."""
    if n <= 1 or rows == 0:
        return []
    share = min(1.0, per_bucket * n / rows)
    got = sorted((r[0] for r in keys.sample(False, share, seed=7).collect()), key=lambda s: s.encode("utf-8", "surrogatepass"))
    cuts = sorted({got[i * len(got) // n] for i in range(1, n)} if got else set(), key=lambda s: s.encode("utf-8", "surrogatepass"))
    return cuts
