from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from utxolake.functions.lists import ordered_list, split_long_list
from utxolake.functions.ordinal import global_ordinal


def test_split_golden(spark):
    """The reference's only unit test: 10 items split by 3 -> 3, 3, 3, 1."""
    df = spark.createDataFrame([(1, "a", [f"({i},0,0)" for i in range(10)])], "e INT, address STRING, outputs ARRAY<STRING>")
    rows = split_long_list(df, "outputs", 3).orderBy("part").collect()
    assert [len(r["outputs"]) for r in rows] == [3, 3, 3, 1]
    assert [x for r in rows for x in r["outputs"]] == [f"({i},0,0)" for i in range(10)]


def test_split_keeps_short_empty_null_and_scalar(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, []), (3, None)], "k INT, l ARRAY<INT>")
    out = {r["k"]: r["l"] for r in split_long_list(df, "l", 3).collect()}
    assert out == {1: [1, 2], 2: [], 3: None}
    s = spark.createDataFrame([(1, "x")], "k INT, l STRING")
    assert [r["l"] for r in split_long_list(s, "l", 3).collect()] == [["x"]]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=1, max_size=6), st.integers(1, 7))
def test_split_property(spark, sizes, n):
    df = spark.createDataFrame([(i, list(range(s))) for i, s in enumerate(sizes)], "k INT, l ARRAY<INT>")
    got = sorted((r["k"], r["part"], tuple(r["l"])) for r in split_long_list(df, "l", n).collect())
    want = []
    for i, s in enumerate(sizes):
        items = list(range(s))
        chunks = [items[j:j + n] for j in range(0, s, n)] if s > n else [items]
        want += [(i, p, tuple(c)) for p, c in enumerate(chunks)]
    assert got == sorted(want)


def test_global_ordinal_equals_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("a"), (F.col("id") % 3).alias("b"))
    got = global_ordinal(df, ["a", "b"], num_partitions=6).select("a", "b", "g").collect()
    want = sorted((r["a"], r["b"]) for r in df.collect())
    assert sorted((r["a"], r["b"], r["g"]) for r in got) == [(a, b, i + 1) for i, (a, b) in enumerate(want)]


def test_ordered_list(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (2, 1, "z")], "k INT, o INT, v STRING")
    got = {r["k"]: r["l"] for r in df.groupBy("k").agg(ordered_list([F.col("o")], F.col("v")).alias("l")).collect()}
    assert got == {1: ["a", "b", "c"], 2: ["z"]}


def test_bounded_lists_concatenate_to_the_whole_list(spark, src):
    import json

    from utxolake.operators.assets import ma_minting
    from utxolake.operators.staking import delegation

    for fn, key, col in ((delegation, "stake_addr_hash", "delegations"), (ma_minting, "fingerprint", "minting")):
        whole = {(r["epoch_no"], r[key]): json.loads(r[col]) for r in fn(src).collect()}
        parts: dict = {}
        for r in fn(src, max_list=2).collect():
            items = json.loads(r[col])
            assert 1 <= len(items) <= 2
            parts.setdefault((r["epoch_no"], r[key]), []).append(items)
        assert set(parts) == set(whole)
        for k, lists in parts.items():
            lists.sort(key=lambda l: (l[0].get("active_epoch_no", 0), l[0]["slot_no"], l[0]["txidx"]))
            assert [x for l in lists for x in l] == whole[k]
