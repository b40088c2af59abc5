"""Record-aware CSV: the multi-line reader's rows from many splits of one file."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from starsift.sources import csv_records, files

SCHEMA = "Id bigint, Name string, Score int, Text string"
HEAD = "Id,Name,Score,Text\n"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def plain(spark, path, schema=SCHEMA, **options):
    return spark.read.csv(str(path), schema=schema, header=True, multiLine=True, escape='"', **options)


def written(path, seed, n):
    pick = random.Random(seed)
    parts = ['a', ',', '\n', '"', '""', '\n\n', ' ', 'é', '漢', '",', ',"', '"\n"', '1,x\n2']
    with open(path, "w", newline="") as f:
        out = csv.writer(f, lineterminator="\n")
        out.writerow(["Id", "Name", "Score", "Text"])
        for i in range(n):
            text = "".join(pick.choices(parts, k=pick.choice([0, 1, 3, 12, 60])))
            out.writerow([i, pick.choice(["n", "o,p", "q\nr"]), i % 5, text])
    return str(path)


@pytest.mark.parametrize("split", [7, 64, 1000, 1 << 20])
def test_equals_multi_line_reader(spark, tmp_path, split):
    path = written(tmp_path / "a.csv", split, 25 if split == 7 else 120)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    got = csv_records.read_csv(spark, path, SCHEMA, split_bytes=split)
    assert got.rdd.getNumPartitions() >= min(8, -(-len(open(path, "rb").read()) // split))
    assert rows_of(got) == rows_of(plain(spark, path))
    assert rows_of(csv_records.read_csv(spark, path, SCHEMA, ["Score", "Id"], split_bytes=split)) == rows_of(plain(spark, path).select("Score", "Id"))


def test_states_by_brute_force(tmp_path):
    """Both effects of every split, and the records they give, against a walk over single bytes."""
    pick = random.Random(3)
    for _ in range(400):
        data = "".join(pick.choices(['"', '""', ',', '\n', 'a'], k=pick.randrange(1, 40))).encode() + b"\n"
        for inside in (False, True):
            state, found, start, i = ("in" if inside else "field"), [], (None if inside else 0), 0
            while i < len(data):
                c = data[i : i + 1]
                if state == "in":
                    if c == b'"' and data[i + 1 : i + 2] == b'"':
                        i += 1
                    elif c == b'"':
                        state = "out"
                elif c == b"\n":
                    if start is not None:
                        found.append(data[start:i])
                    start, state = i + 1, "field"
                elif c == b'"' and state == "field":
                    state = "in"
                else:
                    state = "field" if c == b"," else "out"
                i += 1
            if start is not None and start < len(data):
                found.append(data[start:])
            assert csv_records.ends_inside(data, inside) == (state == "in"), (data, inside)
            assert list(csv_records.records(data, inside)) == found, (data, inside)


@pytest.mark.parametrize("text", ["", HEAD, HEAD + "\n\n", HEAD + '1,a,2,"open\n2,b,3,c\n' * 2, HEAD + "1,a,2,last", HEAD.replace("\n", "\r\n") + '1,a,2,"x"\r\n2,b,3,\r\n', HEAD + '1,,,""\n2,"",3,"a""b"\n', HEAD + '1,a"b,2,c"d\n2,"e",3,f\n'])
def test_odd_files(spark, tmp_path, text):
    (tmp_path / "odd.csv").write_bytes(text.encode())
    for split in (5, 1000):
        assert rows_of(csv_records.read_csv(spark, str(tmp_path / "odd.csv"), SCHEMA, split_bytes=split)) == rows_of(plain(spark, tmp_path / "odd.csv"))


def test_malformed_records_and_folders(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(HEAD + '1,a,2,"x\ny"\nbad,a,2,"p\nq"\n3,a,five,z\n4,short\n')
    (tmp_path / "in" / "b.csv").write_text(HEAD + "5,b,3,t,extra\n6,b,3,t\n")
    got = csv_records.read_csv(spark, str(tmp_path / "in"), SCHEMA, corrupt=files.CORRUPT, split_bytes=9).cache()
    assert got.filter(F.col(files.CORRUPT).isNull()).orderBy("Id").select("Id").collect() == [(1,), (6,)]
    bad = [r[0] for r in got.select(files.CORRUPT).dropna().collect()]
    assert sorted(bad) == ['3,a,five,z', '4,short', '5,b,3,t,extra', 'bad,a,2,"p\nq"']
    # a column that is not wanted makes no record malformed
    some = csv_records.read_csv(spark, str(tmp_path / "in"), SCHEMA, ["Id"], files.CORRUPT, split_bytes=9)
    assert '3,a,five,z' not in [r[1] for r in some.collect()]
