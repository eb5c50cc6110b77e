"""Stored definitions and reset of a deployment."""

import uuid

import pytest
from pyspark.sql import functions as F

from vellum.operators.catalog import RAW_SCHEMA, read_table
from vellum.plans import fixtures as fx
from vellum.streaming import deployment as dp
from vellum.streaming import steps


@pytest.fixture
def d(tmp_path):
    return dp.Deployment(str(tmp_path / "root"), f"docs_{uuid.uuid4().hex[:8]}")


def content_of(spark, sf):
    return lambda todo: todo.join(fx.stage_content(spark, sf), "relative_path", "left")


VERSIONS = "SELECT relative_path, size FROM {schema}.pdf_raw_file_catalog"
TOTALS = "SELECT count(*) AS files, sum(size) AS bytes FROM {schema}.versions"


def test_a_second_session_finds_the_views_and_reset_equals_a_fresh_run(spark, sf_small, d):
    listing, content = fx.stage_listing(spark, sf_small), content_of(spark, sf_small)

    def run(root):
        steps.t1_register(spark, listing, root)
        assert steps.t2_incremental(spark, root, content) > 0  # an old checkpoint would append nothing
        return dp.read_view(spark, d, "totals").first()

    first = dp.open_deployment(spark, d)
    dp.define_view(spark, d, "versions", VERSIONS)
    dp.define_view(spark, d, "totals", TOTALS, needs=("versions",))
    fresh = run(first)
    assert fresh.files == read_table(spark, first.raw, RAW_SCHEMA).count() > 0
    # the catalog forgets everything, as a new application's does
    spark.sql(f"DROP DATABASE `{d.schema}` CASCADE")
    other = spark.newSession()
    assert dp.open_deployment(other, d) == first and dp.read_view(other, d, "totals").first() == fresh
    second = dp.reset(spark, d)
    assert second != first and dp.read_view(spark, d, "totals").first().files == 0
    assert run(second) == fresh
    assert read_table(spark, first.raw, RAW_SCHEMA).count() == fresh.files  # nothing is deleted


def test_a_reset_that_dies_changes_no_data(spark, sf_small, d, monkeypatch):
    root = dp.open_deployment(spark, d)
    dp.define_view(spark, d, "versions", VERSIONS)
    steps.t1_register(spark, fx.stage_listing(spark, sf_small), root)
    before = dp.read_view(spark, d, "versions").count()

    def dies(*_):
        raise RuntimeError("died")

    monkeypatch.setattr(dp, "publish", dies)
    with pytest.raises(RuntimeError):
        dp.reset(spark, d)
    monkeypatch.undo()
    assert dp.open_deployment(spark, d) == root and dp.read_view(spark, d, "versions").count() == before > 0


def test_definitions_keep_their_rules(spark, d, tmp_path):
    dp.open_deployment(spark, d)
    dp.define_view(spark, d, "versions", VERSIONS)
    dp.define_view(spark, d, "totals", TOTALS, needs=("versions",))
    dp.define_view(spark, d, "versions", VERSIONS + " WHERE size > 0")  # replaced, still before what needs it
    assert list(dp.views(spark, d)) == ["versions", "totals"] and dp.views(spark, d)["versions"][0].endswith("> 0")
    with pytest.raises(ValueError, match="need itself"):
        dp.define_view(spark, d, "versions", TOTALS, needs=("totals",))
    with pytest.raises(ValueError, match="not defined"):
        dp.define_view(spark, d, "x", TOTALS, needs=("nowhere",))
    with pytest.raises(Exception, match="no_such_column"):
        dp.define_view(spark, d, "x", "SELECT no_such_column FROM {schema}.versions", needs=("versions",))
    with pytest.raises(ValueError, match="needed by"):
        dp.drop_view(spark, d, "versions")
    dp.drop_view(spark, d, "totals")
    assert list(dp.views(spark, d)) == ["versions"]
    with pytest.raises(ValueError, match="lies at"):
        dp.open_deployment(spark, dp.Deployment(str(tmp_path / "elsewhere"), d.schema))
    with pytest.raises(ValueError):
        dp.Deployment("r", "a b")
