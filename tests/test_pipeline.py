"""T1/T2 against a real folder stage (binaryFile listing, bytes read by path)."""

import datetime as dt
import os
import time

from pyspark.sql import functions as F

from vellum.operators.catalog import PROCESSED_SCHEMA, QUARANTINE_SCHEMA, RAW_SCHEMA, read_table
from vellum.sources.stage import list_stage, read_file_bytes
from vellum.streaming import steps

HTML = "<!DOCTYPE html><html><head><title>{t}</title></head><body><p>{b}</p></body></html>"


def _write(path, text, mtime=None):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text if isinstance(text, bytes) else text.encode())
    if mtime is not None:
        os.utime(path, (mtime, mtime))


def _by_path(spark):
    return lambda todo: todo.withColumn("content", read_file_bytes("scoped_url"))


def _count(spark, path, schema):
    return read_table(spark, path, schema).count()


def test_stage_pipeline(spark, tmp_path):
    stage = str(tmp_path / "stage")
    root = steps.PipelineRoot(str(tmp_path / "root"))
    now = time.time() - 3600
    _write(f"{stage}/manuals/A-1_Manual-1.pdf", HTML.format(t="A", b="one"), now)
    _write(f"{stage}/manuals/B-2_Manual-1.PDF", HTML.format(t="B", b="two"), now)
    _write(f"{stage}/notes.txt", "not a pdf", now)
    _write(f"{stage}/junk.pdf", b"%PDF-1.4 not really", now)

    listing = list_stage(spark, stage)
    assert sorted(r.relative_path for r in listing.collect()) == [
        "junk.pdf", "manuals/A-1_Manual-1.pdf", "manuals/B-2_Manual-1.PDF", "notes.txt"]

    steps.t1_register(spark, list_stage(spark, stage), root)
    assert _count(spark, root.raw, RAW_SCHEMA) == 3
    steps.t2_incremental(spark, root, _by_path(spark))
    proc = read_table(spark, root.processed, PROCESSED_SCHEMA)
    assert sorted(r.pdf_id for r in proc.collect()) == ["A-1_Manual-1", "B-2_Manual-1"]
    q = read_table(spark, root.quarantine, QUARANTINE_SCHEMA).collect()
    assert [r.relative_path for r in q] == ["junk.pdf"]

    # overwrite A with an mtime 100 s newer -> a new version; a new file 10 days old -> registered
    _write(f"{stage}/manuals/A-1_Manual-1.pdf", HTML.format(t="A2", b="one again"), now + 100)
    _write(f"{stage}/manuals/C-3_Manual-1.pdf", HTML.format(t="C", b="three"), now - 10 * 86400)
    steps.t1_register(spark, list_stage(spark, stage), root)
    assert _count(spark, root.raw, RAW_SCHEMA) == 5
    steps.t2_incremental(spark, root, _by_path(spark))
    proc = read_table(spark, root.processed, PROCESSED_SCHEMA)
    assert proc.count() == 4
    assert proc.where(F.col("pdf_id") == "A-1_Manual-1").count() == 2

    # replay everything: nothing new anywhere
    steps.t1_register(spark, list_stage(spark, stage), root)
    steps.t2_incremental(spark, root, _by_path(spark))
    steps.t2_incremental(spark, root, _by_path(spark), checkpoint=str(tmp_path / "fresh_ckpt"))
    assert _count(spark, root.raw, RAW_SCHEMA) == 5
    assert _count(spark, root.processed, PROCESSED_SCHEMA) == 4
    assert _count(spark, root.quarantine, QUARANTINE_SCHEMA) == 1


def test_t2_opens_files_by_path(spark, tmp_path):
    stage = str(tmp_path / "stage")
    root = steps.PipelineRoot(str(tmp_path / "root"))
    _write(f"{stage}/m/A_Manual-1.pdf", HTML.format(t="A", b="one"))
    _write(f"{stage}/gone.pdf", HTML.format(t="G", b="gone"))
    steps.t1_register(spark, list_stage(spark, stage), root)
    os.remove(f"{stage}/gone.pdf")          # registered, then deleted before parsing
    steps.t2_incremental(spark, root, lambda todo: todo)
    proc = read_table(spark, root.processed, PROCESSED_SCHEMA).collect()
    assert [(r.pdf_id, r.extracted_text.split()) for r in proc] == [("A_Manual-1", ["A", "one"])]
    q = read_table(spark, root.quarantine, QUARANTINE_SCHEMA).collect()
    assert [(r.relative_path, r.reason) for r in q] == [("gone.pdf", "no such file")]


def test_null_key_and_duplicates(spark, tmp_path):
    root = steps.PipelineRoot(str(tmp_path / "root"))
    t = dt.datetime(2024, 1, 1)
    rows = [("a.pdf", "u1", "s1", 1, t), ("a.pdf", "u1", "s1", 1, t), ("b.pdf", "u2", "s2", 2, None)]
    listing = spark.createDataFrame(
        rows, "relative_path string, file_url string, scoped_url string, size bigint, last_modified timestamp_ntz")
    steps.t1_register(spark, listing, root)
    steps.t1_register(spark, listing, root)
    raw = read_table(spark, root.raw, RAW_SCHEMA).collect()
    assert [(r.relative_path, r.last_modified) for r in raw] == [("a.pdf", t)]
    q = read_table(spark, root.quarantine, QUARANTINE_SCHEMA).collect()
    assert [(r.relative_path, r.reason) for r in q] == [("b.pdf", "NULL version key")]


def test_listing_never_reads_content_and_t1_is_anti_join(spark, tmp_path):
    stage = str(tmp_path / "stage")
    _write(f"{stage}/x.pdf", HTML.format(t="x", b="y"))
    plan = list_stage(spark, stage)._jdf.queryExecution().executedPlan().toString()
    read_schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert read_schema.startswith("struct<path:string") and "content" not in read_schema
    root = steps.PipelineRoot(str(tmp_path / "root"))
    from vellum.operators.catalog import create_table
    create_table(spark, root.raw, RAW_SCHEMA)
    diff = steps.detect_new_files(list_stage(spark, stage), read_table(spark, root.raw, RAW_SCHEMA))
    assert "LeftAnti" in diff._jdf.queryExecution().executedPlan().toString()


def test_run_once_twice_logs_rows_added(spark, sf_small, tmp_path):
    from vellum.plans import fixtures as fx
    from vellum.plans import queries as Q
    from vellum.plans.warehouse import curated_for

    root = steps.PipelineRoot(str(tmp_path / "root"))
    args = (fx.stage_listing(spark, sf_small), Q._content_fixture(spark, sf_small), curated_for(spark, sf_small),
            {"final_integrated_part": Q._stats_part(spark, sf_small)})
    views = steps.run_once(spark, root, *args)
    assert views["final_integrated_part"].count() == 61
    steps.run_once(spark, root, *args)
    hist = steps.run_history(spark, root).collect()
    assert len(hist) == 6 and all(r.state == "SUCCEEDED" for r in hist)
    added = sorted((r.name, r.rows_added) for r in hist)
    assert added == [("t1_register", 0), ("t1_register", 34), ("t2_extract", 0), ("t2_extract", 34),
                     ("t3_model", 0), ("t3_model", 0)]


def test_replayed_batch_appends_nothing(spark, tmp_path):
    """A micro-batch delivered again (crash between append and checkpoint commit)."""
    stage = str(tmp_path / "stage")
    root = steps.PipelineRoot(str(tmp_path / "root"))
    for i in range(3):
        _write(f"{stage}/d{i}.pdf", HTML.format(t=f"t{i}", b="x"))
    steps.t1_register(spark, list_stage(spark, stage), root)
    batch = read_table(spark, root.raw, RAW_SCHEMA)
    steps._process_batch(spark, root, lambda todo: todo, batch)
    steps._process_batch(spark, root, lambda todo: todo, batch)
    assert _count(spark, root.processed, PROCESSED_SCHEMA) == 3


def test_standing_schedule_picks_up_new_rows(spark, tmp_path):
    stage = str(tmp_path / "stage")
    root = steps.PipelineRoot(str(tmp_path / "root"))
    _write(f"{stage}/a.pdf", HTML.format(t="a", b="x"))
    steps.t1_register(spark, list_stage(spark, stage), root)
    q = steps.t2_incremental(spark, root, lambda todo: todo, every="1 second")
    try:
        q.processAllAvailable()
        assert _count(spark, root.processed, PROCESSED_SCHEMA) == 1
        _write(f"{stage}/b.pdf", HTML.format(t="b", b="y"))
        steps.t1_register(spark, list_stage(spark, stage), root)
        q.processAllAvailable()
        assert _count(spark, root.processed, PROCESSED_SCHEMA) == 2
    finally:
        q.stop()


def test_append_new_keeps_one_row_per_version_property(spark, tmp_path):
    from hypothesis import given, settings, strategies as st
    from vellum.operators.catalog import append_new, raw_rows

    t0 = dt.datetime(2024, 1, 1)
    event = st.tuples(st.sampled_from(["a.pdf", "b.PDF", "c.pdf", "d.txt"]),
                      st.one_of(st.none(), st.integers(0, 2)))
    counter = iter(range(10_000))

    @settings(max_examples=8, deadline=None)
    @given(st.lists(st.lists(event, max_size=6), min_size=1, max_size=3))
    def check(batches):
        root = steps.PipelineRoot(str(tmp_path / f"r{next(counter)}"))
        schema = "relative_path string, file_url string, scoped_url string, size bigint, last_modified timestamp_ntz"
        for batch in batches + batches:          # every batch delivered twice
            rows = [(p, p, p, 1, None if d is None else t0 + dt.timedelta(days=d)) for p, d in batch]
            append_new(spark, raw_rows(spark.createDataFrame(rows, schema)), root.raw, RAW_SCHEMA,
                       quarantine_path=root.quarantine)
        want = {(p, t0 + dt.timedelta(days=d)) for b in batches for p, d in b
                if d is not None and not p.endswith(".txt")}
        got = [(r.relative_path, r.last_modified) for r in read_table(spark, root.raw, RAW_SCHEMA).collect()]
        assert sorted(got) == sorted(want)

    check()


def test_listing_survives_unnormalized_roots_and_uris(spark, tmp_path):
    _write(str(tmp_path / "docs" / "a" / "x.pdf"), "t")
    for stage in (f"{tmp_path}//docs", f"{tmp_path}/./docs/", f"file://{tmp_path}/docs", f"file:{tmp_path}/docs/../docs"):
        assert [r.relative_path for r in list_stage(spark, stage).collect()] == ["a/x.pdf"], stage


def test_version_key_tells_the_repeated_hour_apart(spark, tmp_path):
    zone = spark.conf.get("spark.sql.session.timeZone")
    first = dt.datetime(2024, 11, 3, 5, 30, tzinfo=dt.timezone.utc).timestamp()
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        _write(str(tmp_path / "a.pdf"), "t", first)
        _write(str(tmp_path / "b.pdf"), "t", first + 3600)
        times = {r.last_modified for r in list_stage(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert times == {dt.datetime(2024, 11, 3, 5, 30), dt.datetime(2024, 11, 3, 6, 30)}


def test_unknown_scheme_raises_and_is_not_an_absent_file():
    import pytest

    from vellum.sources.stage import _open_bytes
    with pytest.raises(ValueError):
        _open_bytes("nosuch://bucket/a.pdf")
    assert _open_bytes("/no/such/file.pdf") is None


def test_unopened_file_stays_on_the_work_list(spark, tmp_path):
    stage, root = str(tmp_path / "stage"), steps.PipelineRoot(str(tmp_path / "root"))
    _write(f"{stage}/a.pdf", "good")
    _write(f"{stage}/b.pdf", "later")
    steps.t1_register(spark, list_stage(spark, stage), root)
    os.rename(f"{stage}/b.pdf", f"{stage}/b.bak")
    os.makedirs(f"{stage}/b.pdf")  # there, but it can't be read
    assert steps.t2_incremental(spark, root, lambda todo: todo) == 1
    os.rmdir(f"{stage}/b.pdf")
    os.rename(f"{stage}/b.bak", f"{stage}/b.pdf")
    assert steps.t2_incremental(spark, root, lambda todo: todo) == 1
    assert steps.t2_incremental(spark, root, lambda todo: todo) == 0
    assert sorted(r.pdf_id for r in read_table(spark, root.processed, PROCESSED_SCHEMA).collect()) == ["a", "b"]


def test_runs_without_news_write_nothing(spark, tmp_path):
    stage, root = str(tmp_path / "stage"), steps.PipelineRoot(str(tmp_path / "root"))
    _write(f"{stage}/a.pdf", "good")

    def state():
        files = sorted(f for d, _, fs in os.walk(root.root) for f in fs if f.endswith(".parquet"))
        return files, sorted(os.listdir(f"{root.t2_checkpoint}/commits"))

    seen = []
    for _ in range(3):
        steps.t1_register(spark, list_stage(spark, stage), root)
        steps.t2_incremental(spark, root, lambda todo: todo)
        seen.append(state())
    assert seen[0] == seen[1] == seen[2]


def test_waves_are_bounded_by_files_and_bytes(spark):
    from vellum.operators.admission import admitted, dealt_by_size
    t0 = dt.datetime(2024, 1, 1)
    sizes = [(f"f{i}", t0, 10 ** 9 if i % 50 == 0 else (i * 37) % 1000) for i in range(1200)] + [("null", t0, None)]
    files = spark.createDataFrame(sizes, "relative_path string, last_modified timestamp_ntz, size bigint")
    rows = sorted(admitted(files, 40, 5000).collect(), key=lambda r: r.place)
    assert [r.place for r in rows] == list(range(1201)) and [r.wave for r in rows] == sorted(r.wave for r in rows)
    waves = {}
    for r in rows:
        waves.setdefault(r.wave, []).append(r["size"] or 0)
    assert all(len(w) <= 40 and sum(w[:-1]) <= 5000 for w in waves.values())
    assert max(len(w) for w in waves.values()) > 5
    even = files.where("size < 1000 or size is null")
    parts = dealt_by_size(even, 20_000).select(F.spark_partition_id().alias("p"), "size").groupBy("p").agg(F.sum("size").alias("b")).collect()
    total = sum(r.b for r in parts)
    assert len(parts) == -(-total // 20_000) and max(r.b for r in parts) <= total / len(parts) + 1000


def test_a_backlog_in_one_raw_file_is_extracted_in_waves(spark, tmp_path):
    stage, root = str(tmp_path / "stage"), steps.PipelineRoot(str(tmp_path / "root"))
    for i in range(23):
        _write(f"{stage}/d{i}.pdf", "x" * (i + 1))
    steps.t1_register(spark, list_stage(spark, stage).coalesce(1), root)
    assert steps.t2_incremental(spark, root, lambda todo: todo, max_files=5) == 23
    done = read_table(spark, root.processed, PROCESSED_SCHEMA)
    assert sorted(r["count"] for r in done.groupBy("insert_ts").count().collect()) == [3, 5, 5, 5, 5]
    assert done.select("relative_path").distinct().count() == 23


def test_a_file_that_kills_its_worker_is_found_and_nobody_else_loses(spark, tmp_path, monkeypatch):
    from vellum.operators import extract
    stage, root = str(tmp_path / "stage"), steps.PipelineRoot(str(tmp_path / "root"))
    for i in range(6):
        _write(f"{stage}/d{i}.pdf", "KILL" if i == 3 else f"text {i}")
    decode = extract.decode

    def deadly(raw):
        if raw == b"KILL":
            os._exit(1)
        return decode(raw)

    monkeypatch.setattr(extract, "decode", deadly)
    steps.t1_register(spark, list_stage(spark, stage), root)
    assert steps.t2_incremental(spark, root, lambda todo: todo) == 5
    q = read_table(spark, root.quarantine, QUARANTINE_SCHEMA).collect()
    assert [(r.relative_path, r.reason.startswith(steps.KILLED)) for r in q] == [("d3.pdf", True)]
    # refused for good: a replay from the start doesn't touch it
    assert steps.t2_incremental(spark, root, lambda todo: todo, checkpoint=str(tmp_path / "again")) == 0
    assert _count(spark, root.processed, PROCESSED_SCHEMA) == 5


def test_the_schedule_registers_and_extracts(spark, tmp_path):
    stage, root = str(tmp_path / "stage"), steps.PipelineRoot(str(tmp_path / "root"))
    _write(f"{stage}/a.pdf", "one")

    def processed(n):
        for _ in range(120):
            if _count(spark, root.processed, PROCESSED_SCHEMA) == n:
                return True
            time.sleep(0.5)

    clock = steps.run_every(spark, root, lambda: list_stage(spark, stage), lambda todo: todo, every="1 second")
    try:
        assert processed(1)
        _write(f"{stage}/b.pdf", "two")  # nobody calls T1 for it
        assert processed(2)
    finally:
        clock.stop()
    assert clock.exception() is None


def test_extraction_reads_its_input_once(spark, tmp_path):
    from vellum.operators.extract import extract_documents
    spark.createDataFrame([("a.pdf", "a.pdf", "u", 1, None, b"%PDF-1.4 broken"), ("b.pdf", "b.pdf", "u", 1, None, b"plain"),
                           ("c.pdf", "c.pdf", "u", 1, None, None)],
                          "file_name string, relative_path string, file_url string, size bigint, last_modified timestamp_ntz, content binary"
                          ).write.parquet(str(tmp_path / "in"))
    out = extract_documents(spark.read.parquet(str(tmp_path / "in")))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and plan.count("ArrowEvalPython") == 1
    got = {r.pdf_id: (r.extracted_text, (r.parse_error or "")[:6]) for r in out.collect()}
    assert got["b"] == ("plain", "") and got["c"] == (None, "retry:") and got["a"][0] is None and got["a"][1] in ("no PDF", "cannot")


def test_contents_of_a_table_are_joined_once_for_all_waves(spark, tmp_path):
    stage, root = str(tmp_path / "stage"), steps.PipelineRoot(str(tmp_path / "root"))
    for i in range(12):
        _write(f"{stage}/d{i}.pdf", "x")
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    # d3 has no content; d4 has two rows
    rows = [(f"d{i}.pdf", f"text {i}") for i in range(12) if i != 3] + [("d4.pdf", "text 4")]
    contents = spark.createDataFrame(rows, "relative_path string, content string")
    table = steps.ContentTable(contents.mapInArrow(counted, contents.schema))
    steps.t1_register(spark, list_stage(spark, stage), root)
    assert steps.t2_incremental(spark, root, table, max_files=5) == 11
    assert reads.value == len(rows)
    done = read_table(spark, root.processed, PROCESSED_SCHEMA)
    assert sorted(r.extracted_text for r in done.collect()) == sorted(text for _, text in rows)
    assert [r.relative_path for r in read_table(spark, root.quarantine, QUARANTINE_SCHEMA).collect()] == ["d3.pdf"]
    assert not [f for _, _, files in os.walk(f"{root.root}/_work") for f in files]  # the copy goes with the batch


def test_a_fact_table_is_built_when_it_is_read(spark, sf_small):
    from vellum.plans.warehouse import build_lake
    lake = build_lake(spark, sf_small)
    n = lake.facts_part().count()
    assert os.path.isdir(lake.part.replace("file:", "")) and not os.path.isdir(lake.nopart.replace("file:", ""))
    assert lake.csv_facts_nopart().count() == n and not os.path.isdir(lake.csv_part.replace("file:", ""))
    assert lake.csv_facts_nopart().schema == lake.facts_part().schema


def test_a_listing_takes_few_tasks(spark, tmp_path):
    from vellum.sources import stage
    most = stage.TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    for i in range(33 * most):
        (tmp_path / f"{i}.pdf").write_bytes(b"x")
    listing = stage.list_stage(spark, str(tmp_path))
    assert listing.count() == 33 * most and listing.rdd.getNumPartitions() <= most


def test_small_waves_run_beside_each_other_and_append_in_order(spark, tmp_path, monkeypatch):
    import threading
    stage, root = str(tmp_path / "stage"), steps.PipelineRoot(str(tmp_path / "root"))
    for i in range(12):
        _write(f"{stage}/d{i}.pdf", "x")
    steps.t1_register(spark, list_stage(spark, stage), root)
    write, lock, under_way, most, order = steps._write_parsed, threading.Lock(), [], [], []
    together = threading.Barrier(2, timeout=60)  # breaks where a wave begins only when the one before has ended

    def watched(batch, files, stamp):
        with lock:
            under_way.append(stamp)
            most.append(len(under_way))
            order.append((files.first().place, stamp))
        if len(order) <= 2:
            together.wait()
        try:
            return write(batch, files, stamp)
        finally:
            under_way.remove(stamp)

    monkeypatch.setattr(steps, "_write_parsed", watched)
    monkeypatch.setattr(steps, "MAX_FILES", 8)  # two waves of four fill it
    assert steps.t2_incremental(spark, root, lambda todo: todo, max_files=4) == 12
    assert max(most) == 2 and sorted(order) == sorted(order, key=lambda x: x[1])
    done = read_table(spark, root.processed, PROCESSED_SCHEMA)
    assert [r["count"] for r in done.groupBy("insert_ts").count().collect()] == [4, 4, 4]
    assert sorted(r.pdf_id for r in done.collect()) == sorted(f"d{i}" for i in range(12))


def test_failures_of_all_waves_are_quarantined_once_and_those_before_an_error_too(spark, tmp_path, monkeypatch):
    import pytest
    stage, root = str(tmp_path / "stage"), steps.PipelineRoot(str(tmp_path / "root"))
    for i in range(9):
        _write(f"{stage}/d{i}.pdf", "x")
    table = lambda broken: steps.ContentTable(spark.createDataFrame(
        [(f"d{i}.pdf", "x") for i in range(9) if not broken or i % 2], "relative_path string, content string"))
    steps.t1_register(spark, list_stage(spark, stage), root)
    calls, quarantine, write = [], steps.quarantine, steps._write_parsed
    monkeypatch.setattr(steps, "quarantine", lambda spark, bad, path: (calls.append(bad.count()), quarantine(spark, bad, path)))
    assert steps.t2_incremental(spark, root, table(True), max_files=3) == 4
    assert calls == [5] and _count(spark, root.quarantine, QUARANTINE_SCHEMA) == 5
    assert steps.t2_incremental(spark, root, table(False), max_files=3) == 5

    other, done = steps.PipelineRoot(str(tmp_path / "other")), []
    monkeypatch.setattr(steps, "MAX_FILES", 3)  # one wave at a time

    def second_raises(batch, files, stamp):
        if done:
            raise ValueError("a fault of the step")
        done.append(write(batch, files, stamp))
        return done[0]

    steps.t1_register(spark, list_stage(spark, stage), other)
    monkeypatch.setattr(steps, "_write_parsed", second_raises)
    batch = read_table(spark, other.raw, RAW_SCHEMA)
    with pytest.raises(ValueError, match="a fault of the step"):
        steps._process_batch(spark, other, table(True), batch, max_files=3)
    assert _count(spark, other.quarantine, QUARANTINE_SCHEMA) == done[0]
    assert _count(spark, other.processed, PROCESSED_SCHEMA) == 3 - done[0]
    monkeypatch.setattr(steps, "_write_parsed", write)
    steps._process_batch(spark, other, table(False), batch, max_files=3)
    assert _count(spark, other.processed, PROCESSED_SCHEMA) == 9
