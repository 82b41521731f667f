"""Files brought and summed by the executors."""

import hashlib
import os

from screenloom.sources import downloads, files

FILES = "source string, target string, md5 string"


def md5(data: bytes) -> str:
    return hashlib.md5(data).hexdigest()


def ran(spark, rows):
    return {(r.source.rsplit("/", 1)[1], r.target.rsplit("/", 1)[1]): r for r in downloads.fetched(spark.createDataFrame(rows, FILES)).collect()}


def test_fetch_states(spark, tmp_path):
    src, dst = tmp_path / "from here", tmp_path / "to" / "deep"
    src.mkdir()
    a, b = os.urandom(3000), b""
    (src / "a.fastq.gz").write_bytes(a)  # not unpacked, whatever its name says
    (src / "b").write_bytes(b)
    rows = [
        (f"{src}/a.fastq.gz", f"{dst}/a", md5(a).upper()),
        (f"file:{src}/b", f"file://{dst}/b", None),
        (f"{src}/a.fastq.gz", f"{dst}/wrong", md5(b"x")),
        (f"{src}/none", f"{dst}/none", md5(b"x")),
        (None, f"{dst}/no-source", None),
    ]
    got = ran(spark, rows)
    assert {k: r.status for k, r in got.items()} == {("a.fastq.gz", "a"): "fetched", ("b", "b"): "fetched", ("a.fastq.gz", "wrong"): "mismatch", ("none", "none"): "missing"}
    assert (dst / "a").read_bytes() == a and (dst / "b").read_bytes() == b
    assert got["a.fastq.gz", "a"]["size"] == 3000 and got["a.fastq.gz", "a"].md5 == md5(a) and got["none", "none"]["size"] is None
    # neither a wrong file nor a part of one is left
    assert sorted(f.name for f in dst.iterdir()) == ["a", "a.md5", "b", "b.md5"]
    again = ran(spark, rows[:2])
    assert again["a.fastq.gz", "a"].status == "kept" and again["b", "b"].status == "unverified"


def test_goes_on_where_it_ended(spark, tmp_path):
    """What was brought isn't read again; a target that changed is summed anew and replaced, and an old one outlives a bad source."""
    (tmp_path / "s").write_bytes(b"right")
    row = (f"{tmp_path}/s", f"{tmp_path}/t", md5(b"right"))
    assert ran(spark, [row])["s", "t"].status == "fetched"
    (tmp_path / "s").unlink()
    assert ran(spark, [row])["s", "t"].status == "kept" and downloads.noted(f"{tmp_path}/t") == md5(b"right")
    (tmp_path / "t").write_bytes(b"damaged")
    assert downloads.noted(f"{tmp_path}/t") is None
    assert ran(spark, [row])["s", "t"].status == "missing" and (tmp_path / "t").read_bytes() == b"damaged"
    (tmp_path / "s").write_bytes(b"right")
    assert ran(spark, [row])["s", "t"].status == "fetched" and (tmp_path / "t").read_bytes() == b"right"
    # a note without the file's present size and time isn't believed
    (tmp_path / "t.md5").write_text(f"{md5(b'other')} 5 1\n")
    assert ran(spark, [row])["s", "t"].status == "kept"


def test_pieces(spark, tmp_path, monkeypatch):
    data = os.urandom(100_001)
    (tmp_path / "big").write_bytes(data)
    (tmp_path / "small").write_bytes(b"s")
    monkeypatch.setattr(downloads, "PIECE", 1000)
    assert downloads.digest(f"{tmp_path}/big", f"{tmp_path}/copy") == md5(data) and (tmp_path / "copy").read_bytes() == data
    got = {r.path.rsplit("/", 1)[1]: r.md5 for r in files.md5_of(spark, f"{tmp_path}/*", whole=10).collect()}
    assert got == {"big": md5(data), "copy": md5(data), "small": md5(b"s")}
    sheet = spark.createDataFrame([(f"{tmp_path}/big", md5(data)), (f"{tmp_path}/gone", "0")], "path string, md5 string")
    assert {r.path.rsplit("/", 1)[1]: r.matches for r in files.verified(sheet).collect()} == {"big": True, "gone": False}


def test_paths_of_a_sheet(spark):
    sheet = spark.createDataFrame([(1, "x", "y"), (2, "z", None)], "lane int, R1_path string, R2_path string")
    brought = spark.createDataFrame([("x", "/t/x", None, 1, "kept"), ("y", "/t/y", None, 1, "fetched"), ("z", "/t/z", None, None, "mismatch")], downloads.FETCHED)
    got = downloads.with_targets(sheet, brought, "R1_path", "R2_path")
    assert got.columns == sheet.columns and {tuple(r) for r in got.collect()} == {(1, "/t/x", "/t/y"), (2, "z", None)}


def test_no_files(spark):
    empty = spark.createDataFrame([], FILES)
    assert downloads.fetched(empty).count() == 0 and downloads.streamed_sums(spark.createDataFrame([], "path string")).count() == 0
