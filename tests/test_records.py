"""CSV read by byte ranges against Spark's own reader of whole files."""

import csv
import io
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from veraz.sources import files, records


@pytest.fixture
def tiny_ranges(spark):
    """Files are cut every few bytes."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def cut(size):
        for k in before:
            spark.conf.set(k, str(size))

    yield cut
    for k, v in before.items():
        spark.conf.set(k, v)


def _text(rows, end="\n", **how):
    out = io.StringIO()
    csv.writer(out, lineterminator=end, **how).writerows(rows)
    return out.getvalue()


def _both(spark, path):
    want = files.read_whole_csv(spark, path)
    got = records.read_records(spark, path, want.columns)
    return got, sorted(map(str, got.collect())), sorted(map(str, want.collect()))


@pytest.mark.parametrize("size", [7, 64, 300])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_borders_anywhere(spark, tmp_path, tiny_ranges, size, end):
    rnd = random.Random(size)
    value = lambda: "".join(rnd.choice(['"', ",", "\n", "\r\n", "a", "é", " ", "", '""', '",', ',"', '"\n']) for _ in range(rnd.randrange(7)))
    rows = [["id", "te,xt", 'o"ther']] + [[str(i), value(), value()] for i in range(30)]
    p = tmp_path / "x.csv"
    p.write_bytes(_text(rows, end, quoting=rnd.choice([csv.QUOTE_ALL, csv.QUOTE_MINIMAL])).encode())
    tiny_ranges(size)
    got, mine, spark_s = _both(spark, str(p))
    assert mine == spark_s and len(mine) == 30
    assert spark.read.text(str(p)).rdd.getNumPartitions() > 1
    by_id = {r.id: (r["te,xt"] or "", r['o"ther'] or "") for r in got.collect()}
    assert by_id == {r[0]: tuple(x.replace(end, "\n") for x in r[1:]) for r in rows[1:]}  # as Spark's reader has it


@pytest.mark.parametrize("text", [
    "a,b\n1,x\n", "a,b\n1,x", "a,b\n", "﻿a,b\n1,\"x\ny\"\n", "﻿\"a\",b\n1,2\n", "a,b\n\n\n1,2\n\n", "a,b\n1\n1,2,3\n,\n", 'a,b\n5" pipe,7" pipe\n"x"y,z\n', 'a,b\n1,"open\nto the end',
    '"a\nx",b\n"1\n\n2","3"\n', 'a,b\n"","\n"\n"""",""""""\n', 'a,b\n "x",1\nx "y\nz,2\n', 'a,b\r\n"x\r\ny",1\r\n\r\n2,\r\n',
])
def test_odd_files(spark, tmp_path, tiny_ranges, text):
    (tmp_path / "x.csv").write_bytes(text.encode())
    tiny_ranges(5)
    _, mine, spark_s = _both(spark, str(tmp_path / "x.csv"))
    assert mine == spark_s


def test_a_value_across_many_ranges(spark, tmp_path, tiny_ranges):
    long = "\n".join(f"line {i}, \"{i}\"" for i in range(200))
    for name in "xy":
        (tmp_path / f"{name}.csv").write_text(_text([["id", "t"], [name + "1", "s"], [name + "2", long], [name + "3", "e"]]))
    tiny_ranges(50)
    got = records.read_records(spark, str(tmp_path), ["id", "t"], file_column="from")
    assert {r.id: (r.t, r["from"].rpartition("/")[2]) for r in got.collect()} == {f"{x}{k}": (t, f"{x}.csv") for x in "xy" for k, t in (("1", "s"), ("2", long), ("3", "e"))}


def test_long_lines_dont_overflow(spark):
    many = ",".join(['"a"'] * 50_000)
    doubled = '"' + '""' * 50_000
    rows = spark.createDataFrame([(many, records.START), (doubled, records.SWAP), ("x" * 100_000, records.KEEP), ('a,"b', records.SWAP), ('a"b', records.START), ('"a"', records.START)], "t string, e int")
    wrong = rows.withColumn("got", records.effect(F.col("t"))).where("got <> e")
    assert not wrong.select(F.substring("t", 1, 20), "e", "got").collect()


def test_states():
    e = np.array([records.KEEP, records.SWAP, records.KEEP, records.SWAP, records.START, records.SWAP, records.INSIDE, records.SWAP])
    for inside in (False, True):
        want = [inside]
        for x in e:
            want.append({records.KEEP: want[-1], records.SWAP: not want[-1], records.START: False, records.INSIDE: True}[int(x)])
        assert records.states(e, inside).tolist() == want
    assert records.states(e[:0], True).tolist() == [True]


def test_readers_agree_on_both_sides_of_the_size(spark, tmp_path, tiny_ranges, monkeypatch):
    for name in ("a b", "é"):
        (tmp_path / f"{name}-itens-1.csv").write_text(_text([["id", "t"], [name, 'x\n"y"'], ["2", "z"]]))
    manifests = [{"arquivo": str(p), "source_file_id": p.name, "run_id": "r"} for p in tmp_path.iterdir()]
    tiny_ranges(9)
    out = []
    for limit in (1 << 30, 0):
        monkeypatch.setattr(files, "RANGES_FROM", limit)
        out.append([sorted(map(str, df.collect())) for df in (files.read_csv(spark, str(tmp_path)), files.read_csv(spark, f"{tmp_path}/*.csv"), files.read_with_provenance(spark, manifests, "itens"))])
    assert out[0] == out[1] and len(out[0][2]) == 4 and "é-itens-1.csv" in str(out[0][2])
