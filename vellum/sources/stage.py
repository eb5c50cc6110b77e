"""A stage is a folder of files.  Its directory listing is one row per file:
(relative_path, file_url, scoped_url, size, last_modified).

The listing reads file metadata only: ``content`` of the binaryFile source is
never selected, so Spark does not open the files (ReadSchema has no content).
File bytes are read later, on executors, only for files that need parsing.
"""

from __future__ import annotations

import os
import posixpath
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


TASKS_PER_CORE = 4
SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?"


def _root_path(stage_dir: str) -> str:
    """Stage folder as listed paths begin: no scheme or authority, absolute, normalized."""
    path = re.sub(SCHEME, "", stage_dir)
    if path == stage_dir and not path.startswith("/"):
        path = os.path.abspath(path)
    return posixpath.normpath("/" + path.lstrip("/")).rstrip("/")


def utc_time(instant: F.Column) -> F.Column:
    """An instant as UTC wall-clock time; counted from the epoch, so no session zone or repeated hour touches it."""
    seconds = (F.unix_micros(instant).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def list_stage(spark: SparkSession, stage_dir: str) -> DataFrame:
    """DIRECTORY(@stage): every file under ``stage_dir``, listed afresh on each call.

    A listed path that isn't below the stage's root stops the listing: a file
    must never drop out of it silently.
    """
    root = _root_path(stage_dir) + "/"
    files = (spark.read.format("binaryFile")
             .option("recursiveFileLookup", "true")
             .load(stage_dir))
    path = F.regexp_replace("path", SCHEME, "")
    below = F.when(path.startswith(root), F.substring(path, F.lit(len(root) + 1), F.length(path)))
    listed = files.select(
        F.coalesce(below, F.raise_error(F.concat(F.lit(f"listed outside the stage {root}: "), F.col("path")))).alias("relative_path"),
        F.col("path").alias("file_url"),
        F.col("path").alias("scoped_url"),
        F.col("length").cast("bigint").alias("size"),
        utc_time(F.col("modificationTime")).alias("last_modified"),
    )
    # Spark plans a task for 32 files or fewer, as if it opened them; their metadata need no more tasks than keep all cores busy
    return listed.coalesce(TASKS_PER_CORE * spark.sparkContext.defaultParallelism)


# Schemes of Hadoop listings and the Arrow file systems that open them.
ARROW_SCHEMES = {"s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "hdfs": "hdfs", "viewfs": "viewfs",
                 "abfs": "abfs", "abfss": "abfss"}


def _open_bytes(url: str | None) -> bytes | None:
    """The file's bytes; None if there is no such file.

    A scheme without a reader raises ValueError and a file that is there but
    can't be read OSError: neither may pass for an absent file.
    """
    import pyarrow.fs as pafs

    if url is None:
        return None
    local = _local(url)
    if local is None:
        scheme = url.split(":", 1)[0]
        if scheme not in ARROW_SCHEMES:
            raise ValueError(f"no reader for {scheme}: files")
        fs, path = pafs.FileSystem.from_uri(ARROW_SCHEMES[scheme] + url[len(scheme):])
    else:
        fs, path = pafs.LocalFileSystem(), local
    try:
        with fs.open_input_stream(path) as f:
            return f.read()
    except FileNotFoundError:
        return None


@F.pandas_udf(T.BinaryType())
def read_file_bytes(urls: pd.Series) -> pd.Series:
    """Bytes of each file, read on the executor that parses it; absent -> NULL."""
    return pd.Series([_open_bytes(u) for u in urls], dtype=object)


def _local(url: str) -> str | None:
    if url.startswith("file:"):
        return re.sub(r"^file:(//)?", "", url)
    return None if re.match(SCHEME, url) else url


def upload(files: DataFrame, stage_dir: str) -> int:
    """PUT files into a stage: each row's ``content`` becomes ``stage_dir/relative_path``.

    Executors write their own rows (no bytes pass through the driver); a
    retried task rewrites the same paths.  On a local or mounted folder the
    file's mtime is set to ``last_modified`` when given.  Returns the number of
    files written.
    """
    root = stage_dir.rstrip("/")

    def write(batches):
        import os

        import pyarrow.fs as pafs

        for pdf in batches:
            n = 0
            for rel, content, mtime in zip(pdf["relative_path"], pdf["content"], pdf["last_modified"]):
                target = f"{root}/{rel}"
                data = content.encode("utf-8") if isinstance(content, str) else bytes(content)
                local = _local(target)
                if local is not None:
                    os.makedirs(os.path.dirname(local), exist_ok=True)
                    with open(local, "wb") as f:
                        f.write(data)
                    if mtime is not None and not pd.isna(mtime):
                        secs = (pd.Timestamp(mtime) - pd.Timestamp("1970-01-01")).total_seconds()
                        os.utime(local, (secs, secs))
                else:
                    fs, path = pafs.FileSystem.from_uri(target)
                    with fs.open_output_stream(path) as f:
                        f.write(data)
                n += 1
            yield pd.DataFrame({"n": [n]})

    rows = files.select("relative_path", "content", F.col("last_modified").cast("timestamp_ntz"))
    return rows.mapInPandas(write, "n long").agg(F.sum("n")).collect()[0][0] or 0
