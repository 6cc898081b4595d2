"""The table of current rows that streams replace part by part."""

import os

from tallyweave.streaming.current import CurrentTable


def put(spark, table, batch, values, rounds=1):
    """One batch of key and value pairs, a round for each value of a key."""
    for number in range(1, rounds + 1):
        rows = spark.createDataFrame([(k, vs[number - 1]) for k, vs in values.items()
                                      if len(vs) >= number], "k string, v int")
        step, touched = batch * 100 + number, table.touched(rows)
        before = table.read(step, touched)
        if before is not None:
            rows = rows.unionByName(before.join(rows.select("k"), "k", "left_anti"))
        table.replace(step, rows, touched, batch * 100)


def content(table, below=None):
    rows = table.read(below)
    return None if rows is None else sorted((r.k, r.v) for r in rows.collect())


def files(folder):
    return sum(f.endswith(".parquet") for _, _, names in os.walk(folder) for f in names)


def test_batches_replace_rows_and_may_run_again(spark, tmp_path):
    table = CurrentTable(spark, str(tmp_path / "t"), ["k"], parts=4)
    assert content(table) is None
    put(spark, table, 1, {"a": [1], "b": [1]})
    put(spark, table, 2, {"a": [2, 3], "c": [2]}, rounds=2)
    want = [("a", 3), ("b", 1), ("c", 2)]
    assert content(table) == want and content(table, 200) == [("a", 1), ("b", 1)]
    put(spark, table, 2, {"a": [2, 3], "c": [2]}, rounds=2)
    assert content(table) == want and content(table, 200) == [("a", 1), ("b", 1)]
    table.replace(301, spark.createDataFrame([], "k string, v int"), [], 300)
    assert content(table) == want


def test_old_versions_are_deleted(spark, tmp_path):
    folder = str(tmp_path / "t")
    table = CurrentTable(spark, folder, ["k"], parts=4)
    counts = []
    for batch in range(1, 9):
        put(spark, table, batch, {f"k{i}": [batch] for i in range(20) if i % batch == 0})
        counts.append(files(folder))
    assert content(table) == sorted(
        (f"k{i}", max(b for b in range(1, 9) if i % b == 0)) for i in range(20))
    assert max(counts[2:]) <= 2 * max(counts[:2])
    assert len(os.listdir(f"{folder}/pointers")) <= 4  # two, and their checksums
