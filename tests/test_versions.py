"""The bucketed index of version keys: equal rows to the plain anti-join, no exchange of what is stored."""

import datetime as dt

from pyspark.sql import functions as F

from vellum.operators.catalog import RAW_SCHEMA, VERSION_KEY, conform, new_versions, read_table
from vellum.operators.published import current
from vellum.operators.versions import compact, unseen
from vellum.streaming import steps

DAY = dt.datetime(2024, 1, 1)


def _listing(spark, numbers, days=0):
    rows = [(f"m/{i}_Manual-1.pdf", f"file:/m/{i}", f"file:/m/{i}", i, DAY + dt.timedelta(days=days)) for i in numbers]
    return spark.createDataFrame(rows, "relative_path string, file_url string, scoped_url string, size long, last_modified timestamp_ntz")


def _keys(df):
    return sorted((r.relative_path, r.last_modified) for r in df.select(*VERSION_KEY).collect())


def _raw(spark, root):
    return read_table(spark, root.raw, RAW_SCHEMA)


def test_register_with_index_equals_without(spark, tmp_path):
    plain, indexed = (steps.PipelineRoot(str(tmp_path / n)) for n in ("plain", "indexed"))
    uploads = [_listing(spark, range(40)), _listing(spark, range(60)), _listing(spark, range(60)),
               _listing(spark, range(20), days=1).unionByName(_listing(spark, range(90)))]
    for i, listing in enumerate(uploads):
        assert steps.t1_register(spark, listing, indexed, index=True) == steps.t1_register(spark, listing, plain)
        if i < 2:  # the last two runs meet an index that is one upload old, or exact
            steps.compact_raw(spark, indexed)
    assert _keys(_raw(spark, indexed)) == _keys(_raw(spark, plain)) and _raw(spark, plain).count() == 110


def test_stored_keys_are_not_shuffled(spark, tmp_path):
    root = steps.PipelineRoot(str(tmp_path / "root"))
    steps.t1_register(spark, _listing(spark, range(200)), root)
    compact(spark, _raw(spark, root), root.raw_versions)
    steps.t1_register(spark, _listing(spark, range(210)), root)  # the tail
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        candidates = _listing(spark, range(300))
        got = unseen(spark, candidates, _raw(spark, root), root.raw_versions, slack=0)
        assert _keys(got) == _keys(new_versions(candidates, _raw(spark, root), VERSION_KEY))
        assert len(_keys(got)) == 90
        lines = got._jdf.queryExecution().executedPlan().toString().splitlines()
        at = next(i for i, x in enumerate(lines) if "vellum_versions" in x or "Bucketed: true" in x)
        depth = len(lines[at]) - len(lines[at].lstrip(" :+-*()0123456789"))
        above = []
        for x in reversed(lines[:at]):  # from the index's scan up to the join that it feeds
            d = len(x) - len(x.lstrip(" :+-*()0123456789"))
            if d < depth:
                above.append(x)
                depth = d
            if "Join" in above[-1] if above else False:
                break
        assert "SortMergeJoin" in above[-1] and not any("Exchange" in x for x in above), "\n".join(lines)
        assert "SelectedBucketsCount" in lines[at], lines[at]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_another_session_reads_the_index(spark, tmp_path):
    root = steps.PipelineRoot(str(tmp_path / "it's here"))
    steps.t1_register(spark, _listing(spark, range(30)), root)
    compact(spark, _raw(spark, root), root.raw_versions, rows_per_bucket=3)
    assert current(spark, root.raw_versions).mark.startswith("10|")
    spark.sql("DROP TABLE default.vellum_versions_" + current(spark, root.raw_versions).folder.rsplit("-", 1)[1])
    other = spark.newSession()
    left = unseen(other, _listing(other, range(35)), _raw(other, root).limit(0), root.raw_versions)
    assert [k for k, _ in _keys(left)] == sorted(f"m/{i}_Manual-1.pdf" for i in range(30, 35))


def test_edges(spark, tmp_path):
    root = steps.PipelineRoot(str(tmp_path / "root"))
    assert steps.t1_register(spark, _listing(spark, range(0)), root, index=True) == 0
    steps.compact_raw(spark, root)  # an empty catalog
    no_time = _listing(spark, [7]).withColumn("last_modified", F.lit(None).cast("timestamp_ntz"))
    assert steps.t1_register(spark, _listing(spark, [1, 1, 2]).unionByName(no_time), root, index=True) == 2
    steps.compact_raw(spark, root)
    stamped = conform(_raw(spark, root), RAW_SCHEMA).withColumn("insert_ts", F.lit(None).cast("timestamp"))  # unknown times are tail
    assert unseen(spark, _listing(spark, [1, 2, 3]), stamped, root.raw_versions, slack=0).count() == 1
    assert steps.t1_register(spark, _listing(spark, [1, 2, 3]), root, index=True) == 1
