from collections import Counter

from pyspark.sql import functions as F

from vellum.operators import lake
from vellum.operators.curate import curated_feedback, flatten_json, product_media
from vellum.operators.joins import left_join_hot_safe, left_join_single_row


def _rows(df):
    return Counter(tuple(sorted(r.asDict().items(), key=lambda kv: kv[0])) for r in df.collect())


def test_hot_safe_left_join_equals_left_join(spark):
    left = spark.createDataFrame([(1, "hot"), (2, "hot"), (3, "cold"), (4, "none"), (5, None)], "lid int, k string")
    right = spark.createDataFrame([("hot", i) for i in range(50)] + [("cold", 7)], "rk string, v int")
    got = left_join_hot_safe(left, right, "k", "rk")
    want = left.join(right, F.col("k") == F.col("rk"), "left")
    assert _rows(got) == _rows(want)
    assert got.count() == 50 * 2 + 1 + 2


def _right_third_hot(spark, path):
    """30,000 rows of 2,000 keys in a table, a third of them on one key."""
    n = F.col("id")
    spark.range(30_000).select(F.when(n % 3 == 0, "hot").otherwise((n % 2_000).cast("string")).alias("rk"), n.alias("v"),
                               F.repeat(F.lit("text "), 20).alias("review")).write.parquet(f"{path}/right")
    spark.range(2_500).select(n.cast("string").alias("k"), n.alias("lid")).unionByName(
        spark.createDataFrame([("hot", -1), ("hot", -2), (None, -3)], "k string, lid long")).write.parquet(f"{path}/left")
    return spark.read.parquet(f"{path}/left"), spark.read.parquet(f"{path}/right")


def test_hot_key_is_dealt_over_tasks_and_each_side_read_once(spark, tmp_path):
    left, right = _right_third_hot(spark, str(tmp_path))
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = left_join_hot_safe(left, right, "k", "rk", spread_by=("v",))
        want = left.join(right, F.col("k") == F.col("rk"), "left")
        assert _rows(got) == _rows(want)
        per_task = [r["count"] for r in got.where("k is not null").groupBy(F.spark_partition_id()).count().collect()]
        plain = [r["count"] for r in want.groupBy(F.spark_partition_id()).count().collect()]
        assert max(plain) > 5 * sorted(plain)[8] and max(per_task) <= 5 * sorted(per_task)[len(per_task) // 2]
        plan = got._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        schemas = [x for x in plan.splitlines() if x.startswith("ReadSchema")]
        assert sorted(schemas) == sorted(["ReadSchema: struct<k:string,lid:bigint>", "ReadSchema: struct<rk:string,v:bigint,review:string>",
                                          "ReadSchema: struct<rk:string>"]), schemas
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_hot_safe_left_join_edges(spark):
    left = spark.createDataFrame([(1, 7), (2, None), (3, 8)], "lid int, k int")
    for right in ([], [(None, 1)] * 20, [(7, i) for i in range(40)] + [(None, 0)], [(7, 0)] * 40):
        r = spark.createDataFrame(right, "rk int, v int")
        assert _rows(left_join_hot_safe(left, r, "k", "rk")) == _rows(left.join(r, F.col("k") == F.col("rk"), "left"))


def test_left_join_on_truth_keeps_rows_when_stats_empty(spark):
    left = spark.createDataFrame([(i,) for i in range(5)], "i int")
    empty = spark.createDataFrame([], "avg_arr_delay double, cancel_rate double")
    out = left_join_single_row(left, empty)
    assert out.count() == 5 and out.where(F.col("avg_arr_delay").isNull()).count() == 5
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" in plan and "Join" not in plan


def test_single_row_attach_rejects_two_rows(spark):
    import pytest
    left = spark.createDataFrame([(i,) for i in range(3)], "i int")
    two = spark.createDataFrame([(1.0,), (2.0,)], "a double")
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        left_join_single_row(left, two).collect()


def test_flatten_eight_levels_keeps_childless_parent(spark):
    leaf = '[{"value": 1}, {"value": 2}]'
    doc = leaf
    for lvl in range(8, 1, -1):
        doc = f'[{{"level": {lvl - 1}, "l{lvl}": {doc}}}]'
    full = f'{{"l1": {doc}}}'
    missing = '{"l1": [{"level": 1, "l2": []}]}'
    df = spark.createDataFrame([(1, full), (2, missing)], "id int, j string")
    out = flatten_json(df, "j", [f"l{i}" for i in range(1, 9)], keep=["id"])
    got = sorted((r.id, r.pos8, None if r.node is None else r.node.toJson()) for r in out.collect())
    assert got == [(1, 0, '{"value":1}'), (1, 1, '{"value":2}'), (2, None, None)]


def _facts(spark):
    rows = [(1999, 3, m, d, c) for m, d, c in [(7, 10, 0), (7, 20, 1), (8, 30, 0), (9, None, 1)]]
    rows += [(1999, 2, 4, 5, 0), (2000, 1, 1, 7, 1)]
    return spark.createDataFrame(rows, "year int, quarter int, month int, arr_delay int, cancelled int")


def test_partitioned_unload_prunes_and_mv_rolls_up(spark, tmp_path):
    facts = _facts(spark)
    part, mv = str(tmp_path / "part"), str(tmp_path / "mv")
    lake.unload(facts, part, "parquet", partitioned=True)
    t = lake.external_table(spark, part)
    stats = lake.quarter_stats(t, 1999, 3)
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan or "PartitionFilters" in plan
    r = stats.collect()[0]
    assert r.avg_arr_delay == 20.0 and r.cancel_rate == 0.5
    lake.refresh_monthly_aggregate(spark, t, mv)
    q = lake.quarter_stats_from_mv(lake.external_table(spark, mv), 1999, 3).collect()[0]
    assert q.avg_arr_delay == r.avg_arr_delay and q.cancel_rate == r.cancel_rate


def test_mv_partial_refresh_replaces_only_given_months(spark, tmp_path):
    part, mv = str(tmp_path / "part"), str(tmp_path / "mv")
    lake.unload(_facts(spark), part, "parquet", partitioned=True)
    lake.refresh_monthly_aggregate(spark, lake.external_table(spark, part), mv)
    extra = spark.createDataFrame([(1999, 3, 7, 40, 0)], "year int, quarter int, month int, arr_delay int, cancelled int")
    lake.unload(_facts(spark).unionByName(extra).where("month = 7"), part, "parquet", partitioned=True)
    lake.refresh_monthly_aggregate(spark, lake.external_table(spark, part), mv, months=[(1999, 3, 7)])
    got = {(r.year, r.month): r.n_flights for r in lake.external_table(spark, mv).collect()}
    assert got[(1999, 7)] == 3 and got[(1999, 8)] == 1 and got[(2000, 1)] == 1


def test_csv_unload_needs_schema(spark, tmp_path):
    facts = _facts(spark)
    root = str(tmp_path / "csv")
    lake.unload(facts, root, "csv", partitioned=True)
    back = lake.external_table(spark, root, "csv", schema=facts.schema)
    assert back.where("year = 1999 and quarter = 3").count() == 4
    import pytest
    with pytest.raises(ValueError):
        lake.external_table(spark, root, "csv")


def test_product_media_keeps_every_url_of_a_hot_product(spark):
    rows = [("hot", f"http://m/{i:03d}") for i in range(2500)] + [("hot", "http://m/000"), ("cold", "http://c/1"), (None, "u")]
    out = product_media(spark.createDataFrame(rows, "product_id string, url string")).collect()
    assert {(r.product_id, r.url) for r in out} == set(rows) and sum(r.n_files for r in out) == len(rows)


def test_curated_keeps_reviews_of_unknown_products(spark):
    make = spark.createDataFrame
    out = curated_feedback(
        make([(1, "p", 10, "good"), (2, "x", 11, "lost?"), (3, None, None, "none")], "review_id long, product_id string, order_id long, review_text string"),
        make([("p", "b", "m", "c")], "product_id string, brand string, model_name string, category string"),
        make([(10, None, 5)], "order_id long, review_date date, customer_id long"),
        make([(1, 4)], "review_id long, rating int"),
        make([(5, "FRANCE", None)], "customer_id long, reviewer_location_name string, reviewer_geo_point struct<lon:double,lat:double>"),
        make([("x", "u1"), ("x", "u2")], "product_id string, url string"),
        make([("p", 2.0), ("p", 3.0)], "product_id string, qty double")).collect()
    got = {r.review_id: (r.product_id, r.brand, r.media_count, r.first_media_url, r.return_count, r.return_qty) for r in out}
    assert got == {1: ("p", "b", 0, "NO MEDIA", 2, 5.0), 2: ("x", None, 2, "u1", 0, 0.0), 3: (None, None, 0, "NO MEDIA", 0, 0.0)}


def test_a_file_is_loaded_once_and_a_corrected_record_wins(spark, tmp_path):
    import os

    from vellum.operators import layers
    from vellum.sources import domains
    d = {x.name: x for x in domains.DOMAINS}
    sales, back = tmp_path / "sales", tmp_path / "returns"
    sales.mkdir()
    back.mkdir()
    (sales / "a.csv").write_text("order_id,customer_id,order_date,total_price\n1,7,2024-01-01T00:00:00,1.0\n,9,2024-01-01T00:00:00,1.0\n")
    (back / "a.csv").write_text("order_id,product_id,quantity\n1,p,2.0\n1,p,3.0\n")
    os.utime(sales / "a.csv", (1_700_000_000,) * 2)
    raw = {n: str(tmp_path / "raw" / n) for n in ("sales_transactions", "returns_issues")}
    for _ in range(2):
        loaded = [domains.copy_into(spark, d[n], str(p), raw[n]) for n, p in (("sales_transactions", sales), ("returns_issues", back))]
    assert loaded == [0, 0]
    assert sorted(r.qty for r in layers.stg_returns(spark.read.parquet(raw["returns_issues"])).collect()) == [2.0, 3.0]
    (sales / "b.csv").write_text("order_id,customer_id,order_date,total_price\n1,8,2024-01-02T00:00:00,1.0\n")
    assert domains.copy_into(spark, d["sales_transactions"], str(sales), raw["sales_transactions"]) == 1
    table = spark.read.parquet(raw["sales_transactions"])
    assert [r.customer_id for r in layers.stg_sales(table).collect()] == [8]
    assert layers.without_key(table, "order_id").count() == 1


def test_partial_refresh_drops_vanished_months_and_an_empty_one_changes_nothing(spark, tmp_path):
    facts = spark.createDataFrame([(2020, 1, 1, 5, 0), (2020, 1, 2, 7, 1)], "year int, quarter int, month int, arr_delay int, cancelled int")
    root = str(tmp_path / "mv")
    lake.refresh_monthly_aggregate(spark, facts, root)
    lake.refresh_monthly_aggregate(spark, facts, root, [])
    assert spark.read.parquet(root).count() == 2
    lake.refresh_monthly_aggregate(spark, facts.where("month = 1"), root, [(2020, 1, 2)])
    assert [(r.month, r.sum_arr_delay) for r in spark.read.parquet(root).collect()] == [(1, 5)]


def test_copy_into_loads_files_of_any_name(spark, tmp_path):
    import gzip

    from vellum.sources import domains

    d = next(x for x in domains.DOMAINS if x.name == "media_metadata")
    stage = tmp_path / "stage"
    stage.mkdir()
    (stage / "a.csv").write_text("media_id,product_id,url\n1,p,u\n")
    (stage / "b.csv.gz").write_bytes(gzip.compress(b"media_id,product_id,url\n2,p,u\n"))
    (stage / "c.export").write_text("media_id,product_id,url\n3,p,u\n")
    (stage / "_SUCCESS").write_text("")
    raw = str(tmp_path / "raw")
    assert domains.copy_into(spark, d, str(stage), raw) == 3
    assert sorted(r.media_id for r in spark.read.parquet(raw).collect()) == [1, 2, 3]
    assert domains.copy_into(spark, d, str(stage), raw) == 0


def test_copy_into_keeps_bad_rows_visible(spark, tmp_path):
    from vellum.sources import domains
    stage = tmp_path / "media"
    stage.mkdir()
    (stage / "part-0.csv").write_text("media_id,product_id,url\n1,7,http://a\nnot-a-number,7,http://b\n2,8,http://c\n")
    d = [x for x in domains.DOMAINS if x.name == "media_metadata"][0]
    domains.copy_into(spark, d, str(stage), str(tmp_path / "raw"))
    out = domains.load_counts(spark, {"media_metadata": str(tmp_path / "raw")}).collect()[0]
    assert (out.n_rows, out.n_rejected) == (3, 1)


def test_hot_safe_left_join_property(spark):
    from hypothesis import given, settings, strategies as st

    keys = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d"]))

    @settings(max_examples=12, deadline=None)
    @given(st.lists(keys, max_size=12), st.lists(st.tuples(keys, st.integers(0, 5)), max_size=15))
    def check(left_keys, right_rows):
        left = spark.createDataFrame([(i, k) for i, k in enumerate(left_keys)], "lid int, k string")
        right = spark.createDataFrame(right_rows, "rk string, v int")
        got = left_join_hot_safe(left, right, "k", "rk")
        want = left.join(right, F.col("k") == F.col("rk"), "left")
        assert _rows(got) == _rows(want)

    check()


def _returns_domain():
    from vellum.sources import domains
    return next(x for x in domains.DOMAINS if x.name == "returns_issues")


def test_a_corrected_file_replaces_its_rows_and_a_dead_load_adds_none(spark, tmp_path):
    import os

    import pytest

    from vellum.operators import layers
    from vellum.sources import domains
    d, stage, raw = _returns_domain(), tmp_path / "returns", str(tmp_path / "raw")
    stage.mkdir()

    def drop(name, text, at):
        (stage / name).write_text("order_id,product_id,quantity\n" + text)
        os.utime(stage / name, (at,) * 2)

    def quantities():
        return sorted(r.qty for r in layers.stg_returns(domains.loaded(spark, raw)).collect())

    drop("a b.csv", "1,p,2.0\n1,p,9.0\n", 1_700_000_000)
    drop("c.csv", "2,,5.0\n", 1_700_000_000)
    assert domains.copy_into(spark, d, str(stage), raw) == 2 and quantities() == [2.0, 5.0, 9.0]
    drop("a b.csv", "1,p,2.0\n1,p,4.0\n", 1_700_000_500)
    publish = domains.publish
    with pytest.MonkeyPatch.context() as m:
        m.setattr(domains, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError):
            domains.copy_into(spark, d, str(stage), raw)
    assert domains.publish is publish and quantities() == [2.0, 5.0, 9.0]  # the dead load's rows don't count
    assert domains.copy_into(spark, d, str(stage), raw) == 1
    assert domains.copy_into(spark, d, str(stage), raw) == 0
    assert quantities() == [2.0, 4.0, 5.0]
    # keyless rows are replaced like the others
    drop("c.csv", "2,q,6.0\n", 1_700_000_900)
    assert domains.copy_into(spark, d, str(stage), raw) == 1 and quantities() == [2.0, 4.0, 6.0]
    assert domains.load_counts(spark, {"returns_issues": raw}).first().n_rows == 3


def test_refresh_publishes_whole_versions_of_changed_months(spark, tmp_path, monkeypatch):
    import pytest

    from vellum.operators.published import read_published
    root, facts = str(tmp_path / "monthly"), str(tmp_path / "facts")
    columns = "year int, quarter int, month int, arr_delay int, cancelled int, load_number int"

    def add(*rows):
        spark.createDataFrame(list(rows), columns).write.mode("append").parquet(facts)

    def refresh():
        return lake.refresh_published(spark, spark.read.parquet(facts), root, "load_number")

    def now():
        return {(r.month, r.n_flights, r.sum_arr_delay) for r in read_published(spark, root).collect()}

    add((2020, 1, 1, 5, 0, 1), (2020, 1, 2, 7, 1, 1))
    assert refresh() == 2 and now() == {(1, 1, 5), (2, 1, 7)}
    reader = read_published(spark, root)  # opened before the next refresh
    add((2020, 1, 2, 3, 0, 2), (2020, 1, 3, 4, 0, 2))
    with monkeypatch.context() as m:  # dies before the pointer moves
        m.setattr(lake, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError):
            refresh()
    assert now() == {(1, 1, 5), (2, 1, 7)}
    assert refresh() == 2 and now() == {(1, 1, 5), (2, 2, 10), (3, 1, 4)}
    assert {(r.month, r.n_flights) for r in reader.collect()} == {(1, 1), (2, 1)}
    assert refresh() == 0
    want = {(r.month, r.n_flights, r.sum_arr_delay) for r in lake.monthly_aggregate(spark.read.parquet(facts)).collect()}
    assert now() == want


def test_review_texts_pass_one_join_and_repeated_or_null_keys_keep_their_rows(spark):
    make = spark.createDataFrame
    reviews = make([(1, "p", 10, "a"), (1, "p", 10, "b"), (1, "p", None, "c"), (None, "p", 10, "d"), (None, "p", 10, "d"), (2, None, 11, None)],
                   "review_id long, product_id string, order_id long, review_text string")
    out = curated_feedback(
        reviews, make([("p", "b", "m", "c"), ("p", "b2", "m2", "c2")], "product_id string, brand string, model_name string, category string"),
        make([(10, None, 5), (11, None, None)], "order_id long, review_date date, customer_id long"),
        make([(1, 4), (1, 5)], "review_id long, rating int"),
        make([(5, "FRANCE", None)], "customer_id long, reviewer_location_name string, reviewer_geo_point struct<lon:double,lat:double>"),
        make([], "product_id string, url string"), make([], "product_id string, qty double"))
    got = sorted((r.review_id or 0, r.review_text or "", r.brand or "", r.rating or 0) for r in out.collect())
    assert got == sorted([(1, t, b, s) for t in "abc" for b in ("b", "b2") for s in (4, 5)]
                         + [(0, "d", b, 0) for b in ("b", "b2")] * 2 + [(2, "", "", 0)])
    nodes, joins = [out._jdf.queryExecution().optimizedPlan()], 0
    while nodes:
        node = nodes.pop()
        joins += node.nodeName() == "Join" and "review_text" in node.output().mkString(",")
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    assert joins == 1


def test_only_rows_of_repeated_keys_are_exchanged(spark):
    import datetime as dt

    from vellum.operators import layers
    late, early = dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 1)
    schema = "review_id long, product_id string, order_id long, rating int, review_text string, _corrupt_record string, load_file string, load_time timestamp"
    rows = [(1, "p", 1, 1, "old", None, "b", early), (1, "p", 1, 1, "new", None, "a", late), (2, None, None, None, None, None, "a", late),
            (3, "p", 1, 1, "x", "bad", "a", late), (None, "p", 1, 1, "no key", None, "a", late), (4, "q", 2, 5, "z", None, "a", early)]

    def kept(of):
        return sorted((r.review_id, r.review_text) for r in layers.stg_reviews(spark.createDataFrame(of, schema)).collect())

    want = [(1, "new"), (2, None), (4, "z")]
    assert kept(rows) == want and kept([*rows, *rows]) == want and kept(rows[1:]) == want
    plan = layers.stg_reviews(spark.createDataFrame(rows[1:], schema))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_tiled_left_join_equals_left_join(spark, monkeypatch):
    from vellum.operators import joins
    left = spark.createDataFrame([(i, "hot", f"left {i}") for i in range(40)] + [(50, "cold", None), (51, "none", "x"), (52, None, "y"), (53, None, "y"),
                                 *[(60 + i, "alone", "z" * 30) for i in range(20)], (50, "cold", None)], "lid int, k string, lt string")
    right = spark.createDataFrame([("hot", i, f"right {i}") for i in range(70)] + [("cold", 7, "c"), ("cold", 7, "c"), (None, 1, "n")]
                                  + [("right only", i, "r" * 40) for i in range(90)] + [("cold", None, None)], "rk string, v int, rt string")
    want = _rows(left.join(right, F.col("k") == F.col("rk"), "left"))
    for most, keys in ((joins.MOST_TILES, joins.TILED_KEYS), (12, joins.TILED_KEYS), (joins.MOST_TILES, 1)):
        monkeypatch.setattr(joins, "LEFT_TILE", (100, 10))
        monkeypatch.setattr(joins, "RIGHT_TILE", (80, 9))
        monkeypatch.setattr(joins, "MOST_TILES", most)
        monkeypatch.setattr(joins, "TILED_KEYS", keys)
        got = left_join_hot_safe(left, right, "k", "rk", spread_by=("v",), tiled_by=("lid",))
        assert got.columns == left.columns + right.columns and _rows(got) == want
        per_task = got.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert per_task < 70 * 40 / 4 or most == 12
    none = right.where("v < 0")
    assert _rows(left_join_hot_safe(left, none, "k", "rk", tiled_by=("lid",))) == _rows(left.join(none, F.col("k") == F.col("rk"), "left"))


def test_the_final_view_is_written_with_few_copies_of_its_texts(spark, tmp_path):
    import os

    from vellum.operators.catalog import PROCESSED_SCHEMA, conform
    from vellum.plans.final import final_integrated
    text = lambda what: F.concat(*(F.sha2(F.concat(F.lit(f"{what}{i} "), F.col("id").cast("string")), 512) for i in range(24)))
    manuals = conform(spark.range(40).select(F.concat(F.lit("7_Manual-"), "id").alias("pdf_id"), F.concat(F.lit("manuals/"), "id").alias("relative_path"),
                                             F.lit("2024-01-01").cast("timestamp_ntz").alias("last_modified"), text("manual").alias("extracted_text")), PROCESSED_SCHEMA)
    point = F.struct(F.lit(1.0).alias("lon"), F.lit(2.0).alias("lat"))
    reviews = spark.range(400).select(F.lit("7").alias("product_id"), F.lit("b").alias("brand"), F.lit("m").alias("model_name"), F.lit("c").alias("category"),
                                      F.col("id").alias("review_id"), F.lit("1999-01-01").cast("date").alias("review_date"), F.lit(1).alias("rating"),
                                      text("review").alias("review_text"), F.lit("there").alias("reviewer_location_name"), point.alias("reviewer_geo_point"))
    manuals.write.parquet(str(tmp_path / "manuals"))
    reviews.write.parquet(str(tmp_path / "reviews"))
    stats = spark.createDataFrame([(1.0, 0.5)], "avg_arr_delay double, cancel_rate double")
    view = final_integrated(spark.read.parquet(str(tmp_path / "manuals")), spark.read.parquet(str(tmp_path / "reviews")), stats).drop("pdf_metadata")
    view.write.parquet(str(tmp_path / "view"))
    back = spark.read.parquet(str(tmp_path / "view"))
    assert back.count() == 40 * 400 == back.select("relative_path", "review_text").distinct().count()
    written = sum(os.path.getsize(f"{tmp_path}/view/{f}") for f in os.listdir(tmp_path / "view"))
    assert written < 6_000_000, written  # 1.3 MB of texts, 98 MB of them in the rows
