"""ZIP sources: streamed rows, bounded memory, what they refuse."""

import io
import json
import tracemalloc
import zipfile

import pytest

from veraz.sources import zipped

WANTED = {"places": [0, 2], "names": ["a", "c"], "delimiter": ";", "encoding": "latin-1", "header": False, "number": False}


def _zip(path, text, member="rows.csv"):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(member, text.encode("latin-1"))


def test_rows_of_several_archives(spark, tmp_path):
    folder = tmp_path / "with blank é"
    folder.mkdir()
    _zip(folder / "a 1.zip", '"1";"x";"ção; ""q""\nnext"\n\n2;y\n')
    _zip(folder / "b.zip", "")
    (folder / "_SUCCESS").write_text("")
    for path in (str(folder), f"{folder}/*.zip", f"file://{folder}/a 1.zip"):
        out = zipped.read_zipped_csv(spark, path, ["k", "name", "v"], ["k", "v"], number="place")
        assert sorted(map(tuple, out.collect())) == [("1", 'ção; "q"\nnext', "a 1.zip:1"), ("2", "", "a 1.zip:3")]
    headed = zipped.read_zipped_csv(spark, str(folder), ["k", "name", "v"], ["v"], header=True)
    assert [tuple(r) for r in headed.collect()] == [("",)]
    plan = headed._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_the_other_way_gives_the_same(spark, tmp_path, monkeypatch):
    for i in range(3):
        _zip(tmp_path / f"{i}.zip", "".join(f"{i};{j};x{j}\n" for j in range(25_000)))
    read = lambda: sorted(map(tuple, zipped.read_zipped_csv(spark, str(tmp_path), ["a", "b", "c"], ["c", "a"], number="n").collect()))
    streamed = read()
    monkeypatch.setattr(zipped, "STREAMED", ())
    assert streamed == read() and len(streamed) == 75_000


def test_refusals(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "two.zip", "w") as z:
        z.writestr("a", "1")
        z.writestr("b", "2")
    with pytest.raises(Exception, match="one member"):
        zipped.read_zipped_csv(spark, str(tmp_path / "two.zip"), ["a"], ["a"]).collect()
    with pytest.raises(FileNotFoundError):
        zipped.read_zipped_csv(spark, str(tmp_path / "none*.zip"), ["a"], ["a"])


def test_memory_does_not_follow_the_member(tmp_path):
    """Members of 5 and 40 MB take the same room; so do rows of 1 MB."""
    peaks = []
    for rows, width in ((50_000, 100), (400_000, 100), (40, 1_000_000)):
        _zip(tmp_path / "x.zip", f"1;{'n' * 10};{'v' * width}\n" * rows)
        reader = zipped.ZippedReader({"files": json.dumps([f"file://{tmp_path}/x.zip"]), "wanted": json.dumps(WANTED)})
        tracemalloc.start()
        (part,) = reader.partitions()
        assert sum(b.num_rows for b in reader.read(part)) == rows
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert max(peaks) < 30 << 20 and peaks[1] < 1.2 * peaks[0]


def test_batches_are_bounded_in_bytes():
    data = io.BytesIO()
    _zip(data, f"1;2;{'v' * 1_000_000}\n" * 12)
    assert max(b.nbytes for b in zipped.batches(data, "x", WANTED)) < 2 * zipped.BATCH_BYTES
