"""The split scan of multi-line CSV equals the one-task scan, with borders inside quotes everywhere."""

import random

import pytest

from demandlens.sources import csv_split, files

SCHEMA = "id string, note string, more string"


def awkward_rows(n, seed=3):
    rng = random.Random(seed)
    alphabet = ["a", "é", " ", ",", '"', '""', "\n", "\n\n", "\r\n", '\n"', '",\n"', "x\ny", "", "word"]

    def value():
        kind = rng.random()
        return None if kind < 0.1 else "" if kind < 0.2 else "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 12)))

    return [(str(i), value(), value()) for i in range(n)]


def text_of(rows, end="\n"):
    def field(v):
        return "" if v is None else '"' + v.replace('"', '""') + '"'
    return "id,note,more" + end + "".join(",".join(map(field, r)) + end for r in rows)


def both(spark, path):
    return (sorted(map(tuple, files.scan_csv(spark, path, SCHEMA, split=True).collect()), key=repr),
            sorted(map(tuple, files.scan_csv(spark, path, SCHEMA).collect()), key=repr))


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda size: [spark.conf.set(k, str(size)) for k in old]
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("size", [37, 211, 4096])
def test_a_split_may_end_anywhere(spark, tmp_path, small_splits, size):
    rows = awkward_rows(120)
    (tmp_path / "a.csv").write_bytes(text_of(rows).encode())
    (tmp_path / "b.csv").write_bytes(text_of(awkward_rows(20, 8)).encode())
    small_splits(size)
    got, want = both(spark, str(tmp_path))
    assert got == want and len(got) == 140
    tasks = csv_split.split_lines(spark, str(tmp_path)).select("file", "block").distinct().count()
    assert tasks >= (tmp_path / "a.csv").stat().st_size // size  # one file is many splits
    assert sorted(r for r in got if int(r[0]) >= 20) == sorted(r for r in rows if int(r[0]) >= 20)


def test_every_border_of_one_file(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_bytes(b'id,note,more\n1,"a\nb""\n,",x\n2,"\n\n",\n3,,"c"\n')
    for size in (1, 2, 3, 5, 7, 11, 19):  # 1: a border at every byte
        small_splits(size)
        got, want = both(spark, str(tmp_path))
        assert got == want == [("1", 'a\nb"\n,', "x"), ("2", "\n\n", None), ("3", None, "c")]


def test_line_ends_of_two_characters_and_no_last_one(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_bytes(text_of(awkward_rows(60, 5), "\r\n").encode())
    (tmp_path / "b.csv").write_bytes(text_of([("x", "last", "line")]).encode()[:-1])
    small_splits(64)
    got, want = both(spark, str(tmp_path))
    # in such a file the one-task scan also turns the two characters inside quotes to one; the split scan keeps them
    shorter = sorted((tuple(v and v.replace("\r\n", "\n") for v in r) for r in got), key=repr)
    assert shorter == want and ("x", "last", "line") in got
    assert [r for r in got if r[0] != "x"] == sorted(awkward_rows(60, 5), key=repr)


def test_a_field_longer_than_splits_and_empty_files(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_bytes(text_of([("1", "line\n" * 500, None), ("2", "b", "c")]).encode())
    (tmp_path / "b.csv").write_bytes(b"")
    (tmp_path / "c.csv").write_bytes(b"id,note,more\n")
    small_splits(100)
    got, want = both(spark, str(tmp_path))
    assert got == want == [("1", "line\n" * 500, None), ("2", "b", "c")]
