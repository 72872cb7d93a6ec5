import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from veclode.sources import file_tree
from veclode.sources.documents import read_documents
from veclode.sources.file_tree import list_files, read_files, write_files


def names(df, root):
    return sorted(r["path"].removeprefix(f"file://{root}") for r in df.collect())


def test_listing(spark, write, tmp_path):
    made = ["a/1", "a/_2", "a/.b/_c/3", "a/x y%é#.txt", "d/4"]
    for name in [*made, "a/.1.crc", "a/.DS_Store", ".DS_Store/5"]:
        write(name, name)
    os.makedirs(tmp_path / "empty/_deep")
    root = f"{tmp_path}/"
    listed = list_files(spark, str(tmp_path))
    assert listed.columns == ["path", "length"]
    assert names(listed, root) == sorted(m.replace(" ", "%20").replace("%é#", "%25%C3%A9%23") for m in made)
    assert {r["length"] for r in listed.filter("path LIKE '%/_c/3'").collect()} == {len("a/.b/_c/3")}
    read = {r["path"]: bytes(r["value"]).decode() for r in read_files(spark, str(tmp_path)).collect()}
    assert sorted(read.values()) == sorted(made)
    assert names(list_files(spark, f"{tmp_path}/?/[0-9]"), root) == ["a/1", "d/4"]
    assert names(list_files(spark, f"{tmp_path}/a/_2"), root) == ["a/_2"]
    assert list_files(spark, f"{tmp_path}/empty").collect() == []
    assert read_files(spark, f"{tmp_path}/empty").collect() == []
    with pytest.raises(PySparkException):
        list_files(spark, f"{tmp_path}/none").collect()


def test_deep_and_wide_trees_are_listed_in_tasks(spark, tmp_path, monkeypatch):
    """Planning opens folders only; 10,000 files are told of by the tasks."""
    for i in range(10_000):
        folder = tmp_path / f"_{i % 7}" / f".{i % 13}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{'_.x'[i % 3]}{i}").write_text(f"line of {i}\nx")
    reader = file_tree.FileTreeReader(f"file://{tmp_path}", 16)
    parts = reader.partitions()
    assert 16 <= len(parts) <= 16 + 7 * 13 + 8 and not any(p.path[-1] == "9" and not p.deep for p in parts)
    docs = read_documents(spark, str(tmp_path))
    assert docs.rdd.getNumPartitions() >= 4
    rows = docs.select(F.regexp_extract("doc_id", r"/[_.x](\d+)$", 1).cast("int").alias("i"), "content")
    found = {r["i"]: r["content"] for r in rows.collect()}
    assert found == {i: f"line of {i} " for i in range(10_000)}


def test_planning_stops_opening_folders(tmp_path, monkeypatch):
    for i in range(30):
        (tmp_path / f"a{i}/b").mkdir(parents=True)
        (tmp_path / f"a{i}/b/f").write_text("")
    monkeypatch.setattr(file_tree, "PLANNED_FOLDERS", 3)
    reader = file_tree.FileTreeReader(f"file://{tmp_path}", 1000)
    parts = reader.partitions()
    assert sum(not p.deep for p in parts) == 3
    assert sum(b.num_rows for p in parts for b in reader.read(p)) == 30


def test_files_written_come_back(spark, tmp_path):
    rows = [("a/_1", "one"), ("a/.b/2", ""), ("3", None)]
    df = spark.createDataFrame(rows, "name string, text string").repartition(2)
    assert write_files(df, str(tmp_path / "w"), "name", "text") == 3
    read = {r["path"].split("/w/")[1]: bytes(r["value"]) for r in read_files(spark, str(tmp_path / "w")).collect()}
    assert read == {"a/_1": b"one", "a/.b/2": b"", "3": b""}


def test_a_folder_is_given_out_in_pieces(tmp_path, monkeypatch):
    for i in range(25):
        (tmp_path / f"f{i:02}").write_text("x")
    monkeypatch.setattr(file_tree, "LISTED_FILES", 10, raising=False)
    reader = file_tree.FileTreeReader(tmp_path.as_uri(), 1)
    batches = [b for part in reader.partitions() for b in reader.read(part)]
    assert max(b.num_rows for b in batches) <= 10
    names = [p.rpartition("/")[2] for b in batches for p in b.column(0).to_pylist()]
    assert names == [f"f{i:02}" for i in range(25)]
