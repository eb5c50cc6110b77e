"""The distributed listing against Spark's own, and T1 / T2 over it."""

import os
from itertools import islice

import pytest

from vellum.operators.catalog import PROCESSED_SCHEMA, RAW_SCHEMA, read_table
from vellum.sources.stage import list_stage, read_file_bytes
from vellum.sources.walk import folder_entries, hidden, walk_stage
from vellum.streaming import steps

HTML = "<!DOCTYPE html><html><body>x</body></html>"


def _put(path, content=HTML, mtime=1_700_000_000.123):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(content)
    os.utime(path, (mtime, mtime))


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _tree(root):
    for folder in ("", "a/", "a/b/c/", "d e/ü/", "year=2024/"):
        for i in range(3):
            _put(f"{root}/{folder}file {i}.pdf", HTML + "x" * i, 1_700_000_000 + i + 0.25)
    _put(f"{root}/a/_hidden/x.pdf")
    _put(f"{root}/a/.x.pdf")
    _put(f"{root}/a/_y.pdf")
    _put(f"{root}/a/z.pdf._COPYING_")
    os.makedirs(f"{root}/nothing/inside")


def test_walk_equals_sparks_listing(spark, tmp_path):
    root = str(tmp_path / "stage")
    _tree(root)
    want = _rows(list_stage(spark, root))
    assert len(want) == 15
    assert _rows(walk_stage(spark, root)) == want
    assert _rows(walk_stage(spark, f"file:{root}/")) == want


def test_walk_property(spark, tmp_path):
    from hypothesis import given, settings, strategies as st

    part = st.sampled_from(["a", "b", "_c", ".d", "k=v", "_k=v", "_metadata", "e._COPYING_"])
    runs = iter(range(1000))

    @settings(max_examples=6, deadline=None)
    @given(st.lists(st.lists(part, min_size=1, max_size=4), max_size=8))
    def check(paths):
        root = str(tmp_path / f"run{next(runs)}")
        os.makedirs(root)
        for i, p in enumerate(paths):
            _put(f"{root}/{'/'.join(p)}/f{i}.txt")
        assert _rows(walk_stage(spark, root)) == _rows(list_stage(spark, root))

    check()


def test_empty_files_are_listed_registered_and_have_no_text(spark, tmp_path):
    stage, root = str(tmp_path / "stage"), steps.PipelineRoot(str(tmp_path / "root"))
    _put(f"{stage}/m/A_Manual-1.pdf")
    _put(f"{stage}/m/B_Manual-1.pdf", "")
    assert [r[0] for r in _rows(list_stage(spark, stage))] == ["m/A_Manual-1.pdf"]
    for added in (2, 0):
        assert steps.t1_register(spark, walk_stage(spark, stage), root) == added
    steps.t2_incremental(spark, root, lambda todo: todo.withColumn("content", read_file_bytes("scoped_url")))
    texts = {r.pdf_id: r.extracted_text.strip() for r in read_table(spark, root.processed, PROCESSED_SCHEMA).collect()}
    assert texts == {"A_Manual-1": "x", "B_Manual-1": ""}
    assert read_table(spark, root.raw, RAW_SCHEMA).count() == 2


def test_rewritten_file_is_a_new_version(spark, tmp_path):
    stage, root = str(tmp_path / "stage"), steps.PipelineRoot(str(tmp_path / "root"))
    _put(f"{stage}/A_Manual-1.pdf", mtime=1_700_000_000.001)
    assert steps.t1_register(spark, walk_stage(spark, stage), root) == 1
    _put(f"{stage}/A_Manual-1.pdf", mtime=1_700_000_000.002)
    assert steps.t1_register(spark, walk_stage(spark, stage), root) == 1


def test_large_sparse_files_and_many_folders_list_in_few_tasks(spark, tmp_path):
    root = str(tmp_path / "stage")
    for i in range(40):
        os.makedirs(f"{root}/f{i % 20}", exist_ok=True)
        with open(f"{root}/f{i % 20}/{i}.pdf", "wb") as f:
            f.truncate(200 << 20)
    files = walk_stage(spark, root)
    assert files.rdd.getNumPartitions() <= 8
    assert [r["size"] for r in files.collect()] == [200 << 20] * 40
    assert _rows(files) == _rows(list_stage(spark, root))


def test_edges(spark, tmp_path):
    os.makedirs(tmp_path / "empty")
    assert walk_stage(spark, str(tmp_path / "empty")).collect() == []
    with pytest.raises(Exception, match="FileNotFoundError"):
        walk_stage(spark, str(tmp_path / "absent")).collect()
    assert list(folder_entries(f"file:{tmp_path}", "gone")) == []  # vanished during the walk
    with pytest.raises(ValueError, match="no reader for wasbs"):
        list(folder_entries("wasbs://x@y/z", "a"))
    os.symlink(tmp_path / "target-that-is-not", tmp_path / "empty" / "dangling")
    assert walk_stage(spark, str(tmp_path / "empty")).collect() == []


def test_a_folder_streams(tmp_path):
    for i in range(50):
        _put(f"{tmp_path}/{i}.txt")
    assert len(list(islice(folder_entries(str(tmp_path), ""), 7))) == 7
    assert [hidden(n) for n in ("a", "_a", "_a=1", ".a", "a._COPYING_", "_metadata")] == [False, True, False, True, True, False]
