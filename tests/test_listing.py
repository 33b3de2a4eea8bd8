import os

import pytest
from pyspark.sql import DataFrame

from docloom.sources import files, listing

NAMES = [
    "a.txt",
    "b c.txt",
    "100%20.txt",
    "é.txt",
    "x.TXT",
    "c.md",
    "[d].txt",
    "e{1}.txt",
    "_hidden.txt",
    "_k=v.txt",
    ".dot.txt",
    "sub/a.txt",
    "sub/deep/er/z.txt",
    "_off/a.txt",
    ".off/a.txt",
]


@pytest.fixture
def tree(folder):
    """Each name twice: a file with a text, and in front of it ``0-``, an empty one."""
    for name in NAMES:
        head, _, tail = name.rpartition("/")
        os.makedirs(os.path.join(folder, head), exist_ok=True)
        with open(os.path.join(folder, name), "w") as out:
            out.write("text of " + name)
        hidden = tail[0] in "._" and "=" not in tail
        empty = tail[0] + "0-" + tail if hidden or tail[0] == "_" else "0-" + tail
        open(os.path.join(folder, head, empty), "w").close()
    return folder


@pytest.mark.parametrize("recursive", [False, True])
@pytest.mark.parametrize("glob", ["*", "*.txt", "?.txt", "*.[tT][xX][tT]", "[^a]*.txt", "{a,b*}.txt", "*.{md,txt}", "\\[d\\].txt"])
def test_names_are_those_of_the_scans(spark, tree, glob, recursive):
    scanned = files._binary(spark, tree, glob, recursive).select(files._file_name(tree, recursive), "length")
    listed = listing.list_files(spark, tree, glob, recursive)
    got = sorted((r.below, r.length) for r in listed.collect() if r.length)
    assert got == sorted((r.source_file, r.length) for r in scanned.collect())


@pytest.mark.parametrize("recursive", [False, True])
def test_empty_files_are_found_without_a_list_on_the_driver(spark, tree, recursive, monkeypatch):
    def names(*_):
        raise AssertionError("names of files on the driver")

    monkeypatch.setattr(DataFrame, "inputFiles", names)
    good, rejects = files.read_texts(spark, tree, recursive=recursive)
    got = {r.source_file: r.text for r in good.collect()}
    assert rejects.count() == 0
    empty = {n for n, t in got.items() if not t}
    expected = {"0-a.txt", "0-b c.txt", "0-100%20.txt", "0-é.txt", "0-[d].txt", "0-e{1}.txt", "_0-_k=v.txt"}
    if recursive:
        expected |= {"sub/0-a.txt", "sub/deep/er/0-z.txt"}
    assert empty == expected
    assert all(t == "text of " + n for n, t in got.items() if t)


def test_same_files_by_the_scans_index(spark, tree, monkeypatch):
    def rows():
        good, _ = files.read_texts(spark, tree, recursive=True)
        return sorted((r.source_file, r.text) for r in good.collect())

    expected = rows()
    monkeypatch.setattr(listing, "reaches", lambda *_: False)
    assert rows() == expected


def test_what_is_reached(spark, tree):
    assert listing.reaches(spark, tree)
    assert listing.reaches(spark, f"file://{tree}") and listing.reaches(spark, f"file:{tree}")
    assert not listing.reaches(spark, tree + "/a.txt")
    assert not listing.reaches(spark, tree + "/*")
    assert not listing.reaches(spark, tree + "/none")
    assert not listing.reaches(spark, "nostore://a/b")


def test_many_folders_are_many_tasks(spark, folder):
    for i in range(40):
        os.makedirs(f"{folder}/{i % 7}/{i}")
        open(f"{folder}/{i % 7}/{i}/f.txt", "w").close()
    listed = listing.list_files(spark, folder, "*.txt", recursive=True)
    assert sorted(r.below for r in listed.collect()) == sorted(f"{i % 7}/{i}/f.txt" for i in range(40))
    assert listed.where("length > 0").count() == 0


def test_an_empty_folder(spark, folder):
    assert listing.list_files(spark, folder).count() == 0
    assert listing.list_files(spark, folder, recursive=True).count() == 0
