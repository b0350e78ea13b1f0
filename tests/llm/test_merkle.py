"""The Merkle manifest against a plain tree, its layout, and its SQL."""

import hashlib
import zlib

import numpy as np
import pytest

from vialflow.llm import merkle


def sha(x: str) -> str:
    return hashlib.sha256(x.encode()).hexdigest()


def plain_levels(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        x = levels[-1]
        levels.append([sha("".join(x[i:i + 2])) for i in range(0, len(x), 2)])
    return levels


def plain_path(levels, i):
    """(sibling or None, it stands left) up to the root."""
    out = []
    for x in levels[:-1]:
        j = i ^ 1
        out.append((x[j], j < i) if j < len(x) else (None, False))
        i //= 2
    return out


def plain_leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_audit(rows):
    """rows: (doc_id, source, lang, n_chars, text)"""
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append((plain_leaf(r), r))
    langs = sorted(by, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in langs:
        by[g].sort(key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0]))
        trees[g] = plain_levels([x[0] for x in by[g]])
    top = plain_levels([trees[g][-1][0] for g in langs]) if langs else []
    out = []
    for n, g in enumerate(langs):
        for i, (leaf, r) in enumerate(by[g]):
            path = plain_path(trees[g], i) + plain_path(top, n)
            x = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None:
                x = plain_leaf((*r[:3], r[3] + 1, r[4]))
            for s, left in path:
                x = sha((s or "") + x if left else x + (s or ""))
            out.append((r[0], leaf, trees[g][-1][0], top[-1][0], sha("".join(s or "" for s, _ in path)), x, x == top[-1][0]))
    return out


def sort_key(r):
    return tuple("" if v is None else str(v) for v in r)


@pytest.mark.parametrize("levels", range(1, 12))
def test_layout_is_a_permutation_with_close_lower_trees(levels):
    places = [merkle.address(d, np.arange(1 << d), levels) for d in range(levels)]
    assert sorted(np.concatenate(places).tolist()) == list(range((1 << levels) - 1))
    upper = levels // 2
    if upper:
        assert max(p.max() for p in places[:upper]) == (1 << upper) - 2       # the upper part stands first
        size = (1 << (levels - upper)) - 1
        for t in range(1 << upper):     # every lower tree is one stretch, rooted at its first place
            own = [p[(t << (d - upper)):((t + 1) << (d - upper))] for d, p in enumerate(places) if d >= upper]
            at = np.sort(np.concatenate(own))
            assert at[0] == (1 << upper) - 1 + t * size == own[0][0] and at[-1] - at[0] == size - 1


@pytest.mark.parametrize("n", [1, 2, 3, 5, 31, 64, 100])
def test_subtree_root_and_paths(n):
    leaves = [sha(str(i)) for i in range(n)]
    levels = plain_levels(leaves)
    up = merkle.height(n, True)
    nodes, root = merkle.plant(leaves, up)
    assert root == levels[-1][0]
    for i in range(n):
        path = merkle.siblings(nodes, n, up, i)
        assert [x[1:] for x in path] == [s or "" for s, _ in plain_path(levels, i)]
        assert merkle.fold(leaves[i], path) == root


def rows_of(spark, n):
    langs = ["de", "en", None, "Z", "é", ""]
    return [(None if i % 97 == 5 else i // 2 if i % 50 == 0 else i, None if i % 11 == 3 else f"s{i % 3}", "en" if i % 3 else langs[i % 6],
             None if i % 13 == 4 else i, None if i % 17 == 2 else "" if i % 17 == 3 else f"té xt {i}\n") for i in range(n)]


@pytest.mark.parametrize("n, height", [(0, 10), (1, 10), (300, 3), (300, 10), (2500, 3)])
def test_like_a_plain_tree(spark, monkeypatch, n, height):
    rows = rows_of(spark, n)
    rows += rows[:7]        # repeated rows
    df = spark.createDataFrame([(*r, i, "x") for i, r in enumerate(rows)],
                               "doc_id long, source string, lang string, n_chars long, text string, leaf int, `a.b` string")
    if height != merkle.HEIGHT:
        monkeypatch.setattr(merkle, "HEIGHT", height)
        got = [tuple(r) for r in audited_here(df, height).collect()]
    else:
        got = [tuple(r) for r in merkle.audited(df).collect()]
    assert sorted(got, key=sort_key) == sorted(plain_audit(rows), key=sort_key)


def audited_here(df, height):
    """Workers import the module anew, so the smaller height goes with the functions."""
    import types

    def bound(f):
        space = dict(f.__globals__, HEIGHT=height)
        for k, v in list(space.items()):
            if isinstance(v, types.FunctionType) and v.__module__ == merkle.__name__ and k in ("height", "siblings", "plant", "fold", "proof", "h"):
                space[k] = types.FunctionType(v.__code__, space, v.__name__, v.__defaults__)
        g = types.FunctionType(f.__code__, space, f.__name__, f.__defaults__)
        g.__module__ = "__main__"
        return g
    saved = {k: getattr(merkle, k) for k in ("_build", "_paths", "_audit", "_crowns")}
    try:
        for k, f in saved.items():
            setattr(merkle, k, bound(f))
        return merkle.audited(df)
    finally:
        for k, f in saved.items():
            setattr(merkle, k, f)


def test_query_on_the_given_table(spark):
    from conftest import SF0001
    from vialflow.llm.queries import QUERIES
    got = [tuple(r) for r in QUERIES["op11_merkle_manifest"](spark, SF0001).collect()]
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()
    assert sorted(got, key=sort_key) == sorted(plain_audit([tuple(r) for r in docs]), key=sort_key)
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


def test_query_matches_sql(spark):
    from conftest import SF001
    from vialflow.llm.queries import QUERIES, SQL
    from vialflow.plans.compare import duck
    name = "op11_merkle_manifest"
    got = QUERIES[name](spark, SF001).toArrow()
    want = duck(SF001).sql(SQL[name]).to_arrow_table()
    assert {f.name: str(f.type) for f in got.schema} == {f.name: str(f.type) for f in want.schema}
    cols = sorted(got.column_names)
    assert sorted(map(sort_key, zip(*[got.column(c).to_pylist() for c in cols]))) == sorted(
        map(sort_key, zip(*[want.column(c).to_pylist() for c in cols])))
