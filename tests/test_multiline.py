import random

import pytest
from pyspark.sql import types as T

from siltworks.sources import multiline as ml
from siltworks.sources.delimited import CORRUPT, scan_delimited

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("a", "b", "c")])


def field(rng):
    if rng.random() < 0.5:
        return rng.choice(["x", "5'", "plain text", " ", 'say "hi"', "é日本", "1^2|3~"])
    inner = "".join(rng.choice(["w", " ", "\n", "\n\n", "^|~", '\\"', "line", "é", ",", "\n\n\n", "tail"]) for _ in range(rng.randrange(0, 14)))
    return f'"{inner}"'


def write(path, rng, n, ending="\n"):
    lines = ["A^|~B^|~C"]
    for i in range(n):
        lines.append("^|~".join([str(i), field(rng), field(rng)]) if rng.random() < 0.97 else rng.choice(["short", "1^|~2^|~3^|~4"]))
    path.write_bytes((ending.join(lines) + rng.choice(["", ending])).encode())


@pytest.fixture
def splits(spark):
    """Splits of a few hundred bytes."""
    keys = {"spark.sql.files.maxPartitionBytes": "400", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def rows(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_whole_files(spark, tmp_path, splits, seed):
    rng = random.Random(seed)
    for name, n in (("a.txt", 300), ("b.txt", 40), ("c.TXT", 0), ("skipped.csv", 9)):
        write(tmp_path / name, rng, n)
    lines = ml._lines(spark, [str(tmp_path)], "*.[tT][xX][tT]")
    begins = ml.split_states(lines).collect()
    assert len(begins) > 20 and sum(r["begins"] for r in begins) > 5
    for keep in (False, True):
        got = ml.scan_multiline(spark, str(tmp_path), SCHEMA, keep_corrupt=keep)
        want = scan_delimited(spark, str(tmp_path), SCHEMA, keep_corrupt=keep, multi_line=True)
        columns = ["a", "b", "c", *([CORRUPT] if keep else [])]
        assert rows(got.select("a", "b", "c")) == rows(want.select(*columns).select("a", "b", "c"))
        if keep:
            assert got.where(f"{CORRUPT} is not null").count() == want.select(*columns).cache().where(f"{CORRUPT} is not null").count()


def test_carriage_returns(spark, tmp_path, splits):
    write(tmp_path / "a.txt", random.Random(5), 120, "\r\n")
    got = ml.scan_multiline(spark, str(tmp_path), SCHEMA)
    assert rows(got.select("a", "b", "c")) == rows(scan_delimited(spark, str(tmp_path), SCHEMA, multi_line=True))


def test_a_record_over_many_splits_and_one_that_never_ends(spark, tmp_path, splits):
    long = "\n".join(f"line {i} of a long field" for i in range(300))
    (tmp_path / "a.txt").write_text(f'A^|~B^|~C\n1^|~"{long}"^|~z\n2^|~y^|~z\n3^|~"open\nto the end\n')
    got = {r["a"]: (r["b"], r["c"]) for r in ml.scan_multiline(spark, str(tmp_path), SCHEMA).collect()}
    assert got["1"] == (long, "z") and got["2"] == ("y", "z") and got["3"][0].startswith("open\nto the end")


def test_states():
    s = ml.state_after
    assert s('a^|~"b', 0) == 1 and s('b"^|~c', 1) == 0 and s('b"', 1) == 0 and s('5" pipe', 0) == 0
    assert s('"a"^|~"b', 0) == 1 and s('\\"', 1) == 1 and s('\\\\"', 1) == 0 and s('"a"b^|~"c', 0) == 1 and s('"a" ^|~x', 0) == 0
    assert s("no quote", 1) == 1 and s("", 0) == 0
