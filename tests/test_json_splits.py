"""JSON arrays in splits against the standard library, with files cut into blocks of some bytes."""

import json
import os
import random

import pytest

from streamcurate.sources import files


@pytest.fixture(params=["300b", "128m"])
def cut(spark, request):
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def made(rng, depth=0):
    kind = rng.randrange(8 if depth < 3 else 4)
    if kind >= 4 and depth == 0 or kind in (4, 5, 6):
        return {f"k{i}": made(rng, depth + 1) for i in range(rng.randrange(4))}
    if kind == 7:
        return [made(rng, depth + 1) for _ in range(rng.randrange(3))]
    return [rng.randrange(1000), None, 'a } " \\ { [ ], é\n', 1.5][kind]


GOOD = {"empty.json": "[]", "space.json": " [ ] \n", "one.json": '{"a": {"b": [1, "}"]}}', "number.json": "12", "nested.json": '[[1, {"a": 2}], "x}", {}]', "lines.json": '[\n{"a":1},\n{"a":2}\n]\n', "nan.json": '[{"a": NaN}]'}
BAD = ["[1,,2]", '[{"a":1} {"a":2}]', '[{"a":1},]', '[{"a":1}', '[{"a":1}] x', '{"a":1}{"b":2}', "garbage", '[{"a":1},{broken}]', '[{"a":"open]', '[{"a":1}, nope]', "[1]]"]


def test_like_the_standard_reader(spark, tmp_path, cut):
    rng = random.Random(7)
    for name, text in GOOD.items():
        (tmp_path / name).write_bytes(text.encode())
    for k in range(4):
        items = [made(rng) for _ in range(40)]
        (tmp_path / f"random{k}.json").write_bytes(json.dumps(items, ensure_ascii=bool(k % 2), indent=[None, 1, None, 2][k]).encode())
    (tmp_path / "wide.json").write_bytes(json.dumps([{"a": {"b": "}" * 900}}, {"c": [{}] * 300}, 5]).encode())
    for k, text in enumerate(BAD):
        (tmp_path / f"bad{k}.json").write_bytes(text.encode())
    (tmp_path / "none.json").write_bytes(b"")
    rows = {}
    for r in files.read_json(spark, str(tmp_path)).collect():
        rows.setdefault(os.path.basename(r.file), []).append((r.record_number, r.value))
    for name in os.listdir(tmp_path):
        if not name.endswith(".json") or name == "none.json":
            continue
        found = sorted(rows.get(name, []))
        if name.startswith("bad"):
            assert [n for n, _ in found] == [1], (name, found)
            with pytest.raises(ValueError):
                json.loads(found[0][1])
            continue
        whole = json.loads((tmp_path / name).read_text())
        want = whole if isinstance(whole, list) else [whole]
        assert [n for n, _ in found] == list(range(1, len(want) + 1)), name
        assert [repr(json.loads(v)) for _, v in found] == [repr(x) for x in want], name
    assert "none.json" not in rows
