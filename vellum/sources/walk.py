"""DIRECTORY(@stage) walked on the executors: one row per file, folder level by folder level.

The folders of one level are dealt to tasks, and each task lists its own.  What a
level holds, files and folders, is written to a table of the walk; its folders are the
next level's work.  The driver holds one count per level, never a file's status, and no
task depends on how large the files are.  A level is committed as a whole, so a lost
executor lists its folders again and nothing twice.

Against ``stage.list_stage`` (Spark's own listing, through the driver): the same columns
and rows, and files of zero bytes too, which that one skips.  Names that Spark hides
(``_x``, ``.x``, ``x._COPYING_``) are hidden here as well.  A folder that vanishes during
the walk has no files; a root that isn't there, a folder that can't be read and a scheme
without a reader stop the walk.

One folder is listed by one task.  Local and mounted folders stream their entries;
stores that Arrow opens give a folder's names, sizes and times at once.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import batched

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.session import new_workspace, qualified
from vellum.sources.stage import ARROW_SCHEMES, _local, utc_time

ENTRIES = "folder boolean, relative_path string, size long, modified_ms long"
CHUNK = 10_000

Entry = tuple[bool, str, int, int]


def hidden(name: str) -> bool:
    """Spark's rule for file names that no reader sees."""
    if name.startswith(("_metadata", "_common_metadata")):
        return False
    return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)


def _local_entries(folder: str) -> Iterator[Entry]:
    with os.scandir(folder) as found:
        for e in found:
            try:
                is_folder, about = e.is_dir(), e.stat()
            except FileNotFoundError:  # gone since, or a link to nothing
                continue
            yield is_folder, e.name, 0 if is_folder else about.st_size, about.st_mtime_ns // 1_000_000


def _arrow_entries(url: str) -> Iterator[Entry]:
    import pyarrow.fs as pafs

    scheme = url.split(":", 1)[0]
    if scheme not in ARROW_SCHEMES:
        raise ValueError(f"no reader for {scheme}: folders")
    fs, path = pafs.FileSystem.from_uri(ARROW_SCHEMES[scheme] + url[len(scheme):])
    for info in fs.get_file_info(pafs.FileSelector(path)):
        is_folder = info.type == pafs.FileType.Directory
        yield is_folder, info.base_name, info.size or 0, (info.mtime_ns or 0) // 1_000_000


def folder_entries(root: str, folder: str) -> Iterator[Entry]:
    """(is a folder, path below the root, size, modified in ms) of everything directly in ``folder``."""
    url = f"{root}/{folder}" if folder else root
    local = _local(url)
    try:
        for is_folder, name, size, modified in _arrow_entries(url) if local is None else _local_entries(local):
            if not hidden(name):
                yield is_folder, f"{folder}/{name}" if folder else name, size, modified
    except FileNotFoundError:
        if not folder:
            raise


def walk_stage(spark: SparkSession, stage_dir: str) -> DataFrame:
    """Every file under ``stage_dir``, listed afresh: relative_path, file_url, scoped_url, size, last_modified."""
    root = qualified(spark, stage_dir).rstrip("/")
    tables = new_workspace(spark, "listing")

    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for folders in batches:
            for folder in folders["relative_path"]:
                for chunk in batched(folder_entries(root, folder), CHUNK):
                    yield pd.DataFrame(chunk, columns=["folder", "relative_path", "size", "modified_ms"])

    most = 4 * spark.sparkContext.defaultParallelism
    levels: list[str] = []
    folders, n = spark.createDataFrame([("",)], "relative_path string"), 1
    while n:
        levels.append(f"{tables}/level-{len(levels)}")
        # a stated number of tasks: the few bytes of folder names say nothing about the work
        folders.repartition(min(n, most)).mapInPandas(entries, ENTRIES).write.parquet(levels[-1])
        folders = spark.read.schema(ENTRIES).parquet(levels[-1]).where("folder").select("relative_path")
        n = folders.count()
    url = F.concat(F.lit(root + "/"), "relative_path")
    return spark.read.schema(ENTRIES).parquet(*levels).where("not folder").select(
        "relative_path", url.alias("file_url"), url.alias("scoped_url"), "size",
        utc_time(F.timestamp_millis("modified_ms")).alias("last_modified"))
