"""CSV in splits against the standard library's reader, with files cut into blocks of a few bytes."""

import csv
import io
import os
import random

import pytest

from streamcurate.operators import validate as va
from streamcurate.sources import csv_splits, files
from streamcurate.specs import IMU


def plain(folder, name):
    with open(f"{folder}/{name}", encoding="utf-8", newline="") as f:
        reader = csv.DictReader(f)
        rows = []
        for i, row in enumerate(reader, 1):
            extra = row.pop(None, None)
            rows.append((i, row, extra))
        return list(reader.fieldnames or []), rows


@pytest.fixture(params=["300b", "128m"])
def cut(spark, request):
    """Files are read in blocks of so many bytes."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


TEXTS = {
    "quoted.csv": 'a,b\n1,"x\ny"\n2,"say ""hi"", x"\n3,"c\\"\n\n4,\n"5\n\n\n",z\n',
    "order.csv": "b,a\nB1,A1\r\nB2,A2\r\n\r\nB3\r\n",
    "extra.csv": 'a,b\n1,2,3\n4,"5",6,7\n8\n',
    "odd.csv": 'a,b\nx"y,z"w\n"p"q,"r" s\n ,"t"\n"",""\n',
    "returns.csv": 'a,b\r1,2\r"3\r4",5\r\r6,7',
    "twice.csv": "a,b,a\n1,2,3\n4\n",
    "header.csv": '"a","b\n"\n1,2\n',
    "open.csv": 'a,b\n1,"2\n3,4\n',
    "blank.csv": "\na,b\n1,2\n",
    "only.csv": "a,b\n",
}


def test_like_the_standard_reader(spark, tmp_path, cut):
    for name, text in TEXTS.items():
        (tmp_path / name).write_bytes(text.encode())
    rng = random.Random(3)
    pieces = ['"', '""', ",", "\n", "x" * 9, "é", "\\", "\r\n", " ", '","', '"\n"', "\n" * 3, "plain,row\n" * 20]
    for k in range(6):
        (tmp_path / f"random{k}.csv").write_bytes(("a,b\n" + "".join(rng.choice(pieces) for _ in range(150)) + '\nend,"1"\n').encode())
    found = csv_splits.split_csv(spark, str(tmp_path))
    heads = {os.path.basename(r.file): r.header for r in found.headers.collect()}
    rows = {}
    for r in csv_splits.named(found, ["a", "b"]).collect():
        rows.setdefault(os.path.basename(r.file), []).append((r.record_number, r.a, r.b))
    none = [n for n in os.listdir(tmp_path) if n.endswith(".csv")]
    for name in none:
        head, want = plain(tmp_path, name)
        assert heads[name] == head, name
        assert sorted(rows.get(name, []), key=lambda r: r[0]) == [(i, row.get("a"), row.get("b")) for i, row, _ in want], name
    wide = {(os.path.basename(r.file), r.record) for r in va.invalid_csv(found.records, found.headers, ["file"]).collect()}
    assert wide == {(name, i) for name in none for i, _, extra in plain(tmp_path, name)[1] if extra}


def test_headers_and_empty_files(spark, tmp_path):
    (tmp_path / "none.csv").write_bytes(b"")
    (tmp_path / "imu.csv").write_bytes(b"timestamp,accel_x,accel_y,temp\n1,2,3,4\n")
    found = csv_splits.split_csv(spark, str(tmp_path))
    issues = va.header_issues(found.headers, IMU, ["file"]).collect()
    assert sorted((r.field, r.code) for r in issues) == [("accel_z", "MISSING_REQUIRED_FIELD"), ("temp", "UNEXPECTED_FIELD")]
    assert files.read_csv(spark, f"{tmp_path}/imu.csv", ["accel_y", "device_id"]).drop("file").collect() == [(1, "3", None)]
    assert csv_splits.split_csv(spark, f"{tmp_path}/none.csv").records.collect() == []


def test_long_record(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(csv_splits, "MOST_CHARS", 50)
    (tmp_path / "a.csv").write_bytes(b'a\n"x\ny"\n"' + b"z\n" * 60 + b'"\nlast\n')
    found = csv_splits.split_csv(spark, str(tmp_path))
    assert sorted((r.record_number, r.cells) for r in found.records.collect()) == [(1, ["x\ny"]), (2, None), (3, ["last"])]
    assert [r.record for r in va.invalid_csv(found.records, found.headers, ["file"]).collect()] == [2]
