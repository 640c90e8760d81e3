"""Listing by tasks gives what Spark's own listing gives."""

import pytest

from batchloom.plans import enrich
from batchloom.sources import files, tree


@pytest.fixture
def root(tmp_path):
    names = ["a.txt", "b/ü x.PNG", "b/c/d/e.jpg", "b/c/%41.txt", "b/_hidden/f.txt", "b/.git/g.txt", "_k=1/h.txt", "b/_i.txt", "z/j.txt._COPYING_"]
    names += [f"wide/{i}/{i}.txt" for i in range(30)] + [f"flat/{i:03}.jpg" for i in range(50)]
    for i, name in enumerate(names):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"x" * i)
    (tmp_path / "empty" / "folder").mkdir(parents=True)
    return tmp_path


def rows(df):
    return sorted(map(tuple, df.select("relative_path", "size").collect()))


@pytest.mark.parametrize("uri", ["{}", "file:{}", "file://{}/"])
def test_tree_equals_sparks_listing(spark, root, uri, monkeypatch):
    monkeypatch.setattr(tree, "BATCH_ROWS", 7)
    listed = tree.list_tree(spark, uri.format(root), tasks=3)
    empty = [("a.txt", 0)]  # Spark's listing leaves out files without bytes
    assert rows(listed) == sorted(rows(files.list_files(spark, str(root))) + empty)
    assert len(rows(listed)) == 85 and ("_k=1/h.txt", 6) in rows(listed)


def test_prefix_and_extensions(spark, root):
    everything = files.list_files(spark, str(root))
    for prefix in ("b", "b/", "b/c/d", "wide/1", "nothing", "b/c/%41.txt"):
        expected = rows(files.filter_prefix(everything, prefix))
        assert rows(tree.list_tree(spark, str(root), prefix)) == expected
    assert rows(tree.list_tree(spark, str(root), extensions=["PNG", ".jpg"])) == rows(files.filter_extensions(everything, ["png", "jpg"]))


def test_new_files_by_tasks(spark, root):
    known = spark.createDataFrame([("b/c/d/e.jpg",)], "file_path string")
    found = enrich.discover_files(spark, str(root), known, ["jpg"], "b/", lister=tree.list_folder)
    assert rows(found) == []
    found = enrich.discover_files(spark, str(root), known, ["jpg"], "flat/", limit=3, lister=tree.list_folder)
    assert [p for p, _ in rows(found)] == ["flat/000.jpg", "flat/001.jpg", "flat/002.jpg"]


def test_folders_outside_the_prefix_are_not_entered(spark):
    held = {"": [(True, "a"), (True, "ab"), (False, "f")], "a": [(True, "b"), (False, "g")], "a/b": [(False, "h")]}

    def lister(folder):
        entries = held[folder.removeprefix("s://root").strip("/")]  # a KeyError for what must not be read
        return [(is_folder, name, 5) for is_folder, name in entries]

    assert rows(tree.list_tree(spark, "s://root", "a/b/", lister=lister)) == [("a/b/h", 5)]


def test_missing_root_is_an_error_and_vanished_folders_are_empty(spark, tmp_path):
    with pytest.raises(Exception, match="No such file"):
        tree.list_tree(spark, str(tmp_path / "none"))

    def lister(folder):
        if folder.endswith("gone"):
            raise FileNotFoundError(folder)
        return [(True, "gone", 0), (False, "here", 1)]

    assert rows(tree.list_tree(spark, "x://", lister=lister)) == [("here", 1)]


def test_empty_root(spark, tmp_path):
    assert rows(tree.list_tree(spark, str(tmp_path))) == []
