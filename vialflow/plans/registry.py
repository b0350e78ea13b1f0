"""Name -> query function registry shared by the catalogue modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        CATALOG[name] = fn
        return fn
    return deco


def all_queries() -> dict[str, Query]:
    # importing the modules registers their queries
    from . import catalog, mining, warehouse, warehouse_page  # noqa: F401
    return dict(CATALOG)


_SEEN: dict = {}


def files_of(spark, root: str) -> int:
    """A number for the files under ``root``: their paths, lengths and times."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    found, it = [], path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
    while it.hasNext():
        f = it.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return hash(tuple(sorted(found)))


def fresh(spark, root: str) -> str:
    """The application, after releasing what it keeps of ``root`` if the files there are not
    those it was built from (S10: a cached view is as old as its files)."""
    app, now = spark.sparkContext.applicationId, files_of(spark, root)
    if _SEEN.get((app, root), now) != now:
        release_caches(spark, root)
    _SEEN[(app, root)] = now
    return app


def release_caches(spark, root: str | None = None) -> int:
    """Unpersist everything the catalogue keeps for this application (analysis view, shared
    roll-up, fitted-model predictions, samples), or what it keeps of one data folder. Returns
    the number of cached frames released."""
    from . import catalog, mining, warehouse
    app = spark.sparkContext.applicationId
    n = 0
    for cache in (warehouse._VIEWS, catalog._ROLLUPS, mining._MODELS):
        for key in [k for k in cache if k[0] == app and root in (None, k[1])]:
            value = cache.pop(key)
            for obj in (value if isinstance(value, tuple) else (value,)):
                df = getattr(obj, "df", obj)
                if hasattr(df, "unpersist"):
                    df.unpersist()
                    n += 1
    return n
