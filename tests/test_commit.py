"""Sinks that may run again."""

import os

from tallyweave.sources import commit, registry


def folders(path):
    return sorted(n for n in os.listdir(path) if n.startswith("rows="))


def test_rows_written_again_are_one_copy(spark, tmp_path):
    folder = str(tmp_path / "t")
    assert commit.committed(spark, folder) is None
    one = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    for df in (one, one.repartition(3), one.orderBy("v")):
        commit.add_rows(df, folder)
    assert len(folders(folder)) == 1
    commit.add_rows(one.filter("k = 1"), folder)
    assert sorted(r.k for r in commit.committed(spark, folder).collect()) == [1, 1, 2]
    assert commit.altered(spark, folder).count() == 0
    assert not [n for n in os.listdir(folder) if n.startswith("_staged")]


def test_the_last_replacement_counts_and_altered_rows_are_found(spark, tmp_path):
    folder = str(tmp_path / "t")
    for values in ([1, 2], [3], [3]):
        commit.replace_rows(spark.createDataFrame([(v,) for v in values], "k int"), folder, "json")
    assert [r.k for r in commit.committed(spark, folder).collect()] == [3]
    name, = folders(folder)
    part = next(n for n in os.listdir(f"{folder}/{name}") if n.startswith("part-") and os.path.getsize(
        f"{folder}/{name}/{n}"))
    os.remove(f"{folder}/{name}/.{part}.crc")
    with open(f"{folder}/{name}/{part}", "w") as out:
        out.write('{"k":4}\n')
    assert [r["name"] for r in commit.altered(spark, folder).collect()] == [name]


def test_registry_rows_keep_their_order_and_quotes(spark, tmp_path):
    folder = str(tmp_path / "r")
    rows = [(i, f'n "{i}", {i}\nx' if i % 2 else None) for i in range(50)]
    registry.write_registry(spark.createDataFrame(rows, "k int, v string").repartition(5), folder, ["k"])
    got = [(int(r.k), r.v) for r in commit.committed(spark, folder).collect()]
    assert sorted(got) == rows
    name, = folders(folder)
    kept = "".join(open(f"{folder}/{name}/{n}").read() for n in sorted(os.listdir(f"{folder}/{name}"))
                   if n.startswith("part-"))
    assert kept.index('"n ""7""') < kept.index('"n ""9""') < kept.index('"n ""41""')
