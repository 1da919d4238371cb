"""What the physical plans must and must not contain."""

import re
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from salescope.operators import cleaning, clustering, components, customers, exploration, sampling, spending
from salescope.plans.registry import QUERIES, ev, tx
from salescope.sources import materialise, read_parquet, scratch, write_parquet


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def written(spark, sf, tmp_path_factory):
    """The clean table as reports read it."""
    path = str(tmp_path_factory.mktemp("plans") / "t")
    write_parquet(cleaning.enrich(tx(spark, sf)), path)
    return read_parquet(spark, path)


@pytest.fixture(autouse=True)
def large_tables(spark):
    """No table is small enough to be broadcast on its estimate, and plans are final before they run."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    before = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], "-1")
    spark.conf.set(names[1], "false")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


# The iterative fits are left out: they run their jobs before there is a plan to look at.
RUN_FIRST = "cluster|silhouette|pca|repurchase_[sq]|forecast|saved|basket_[lv]|baskets|checks|csv|ranked|first_"
LAZY = [n for n in QUERIES if not re.search(RUN_FIRST, n)]


@pytest.mark.parametrize("name", LAZY)
def test_no_nested_loops_and_no_python(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "ArrowEval", "MapInArrow", "MapInPandas"):
        assert bad not in text


def test_top_k_is_kept_by_each_task(written):
    assert "TakeOrderedAndProject" in plan(spending.top_spenders(written))
    assert "TakeOrderedAndProject" in plan(exploration.earliest_rows(written))
    assert "TakeOrderedAndProject" in plan(sampling.last_rows(written, 10))
    for ranked in (exploration.top_products_by_count(written), exploration.top_products_by_quantity(written)):
        assert re.search(r"WindowGroupLimit .*Partial", plan(ranked))


def test_aggregates_combine_before_each_shuffle(written):
    text = plan(spending.mean_customer_quantity(written, "main_category", "month"))
    assert text.count("Exchange hashpartitioning") == 2
    assert "partial_sum(quantity" in text and "partial_avg(quantity_sum" in text
    # One scan and three shuffles, however many reports; rows are multiplied only after they were summed by customer.
    every = plan(spending.quantity_reports(written))
    assert every.count("FileScan") == 1 and every.count("Exchange hashpartitioning") == 3
    assert every.index("Expand") < every.index("partial_sum(quantity#")


def test_only_used_columns_are_read(written):
    def read(df):
        return set(re.search(r"ReadSchema: struct<(.*?)>", plan(df)).group(1).replace(":", ",").split(",")[::2])

    assert read(exploration.sales_by(written, "month")) == {"month", "total_amount"}
    assert read(spending.mean_customer_quantity(written, "main_category")) == {
        "customer_id", "main_category", "quantity"
    }
    assert read(exploration.segment_means(written)) == {"customer_type", "quantity", "total_amount"}


def test_filters_reach_the_scan(written):
    assert "EqualTo(customer_type,B2B)" in plan(exploration.segment(written, "B2B"))
    assert "EqualTo(main_category,SMALL)" in plan(
        spending.mean_customer_quantity(written, "main_category").where(F.col("main_category") == "SMALL")
    )
    assert "IsNotNull(quantity)" in plan(cleaning.clean(written))


def test_neighbours_write_their_layout_and_run_nothing_else(written, monkeypatch):
    """Building the frame is one write; the windows group on the chunk as well as on the key."""
    from salescope.operators import ordering

    names, original = [], ordering.materialise
    monkeypatch.setattr(ordering, "materialise", lambda df, name: names.append(name) or original(df, name))
    text = plan(customers.with_next_purchase(written))
    assert names == ["chunks"] and re.search(r"hashpartitioning\(customer_id#\d+L?, _chunk", text)


def test_facts_are_never_broadcast(spark, sf):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100m")
    text = plan(tx(spark, sf))
    assert "SortMergeJoin [l_orderkey" in text


def test_a_large_table_is_cleaned_in_parts(spark, sf, monkeypatch):
    """A part is chosen as lines are read, so that each shuffle has the lines of one part; none is left for the result."""
    plans, sizes, original = [], [], cleaning.materialise

    def watch(df, name):
        plans.append(plan(df))
        table = original(df, name)
        sizes.append(table.count())
        return table

    whole = QUERIES["clean_enriched"](spark, sf)
    monkeypatch.setattr(cleaning, "materialise", watch)
    monkeypatch.setattr(cleaning, "PART_BYTES", 20_000)
    cleaned = QUERIES["clean_enriched"](spark, sf)
    assert len(plans) == cleaning.MOST_PARTS and max(sizes) < 2 * min(sizes) and "Exchange" not in plan(cleaned)
    for text in plans:
        assert "xxhash64(concat_ws" in text[:text.index("FileScan parquet [l_orderkey")].rsplit("Exchange", 1)[1]
    assert whole.exceptAll(cleaned).count() == 0 == cleaned.exceptAll(whole).count()


def test_ids_are_put_together_after_the_joins(spark, sf):
    text = plan(tx(spark, sf))
    assert text.index("concat_ws") < text.index("SortMergeJoin") and text.count("concat_ws") == 1


def test_quantity_reports_shuffle_customers_before_they_multiply_rows(written):
    every = plan(spending.quantity_reports(written))
    assert "customer_id" not in every[:every.index("Expand")]
    # A report and the one by sub-category share a sort.
    assert every.count("Sort [customer_id") == 3


def test_purchases_are_dealt_out_before_their_terms(written):
    text = plan(customers.basket_terms(written))
    assert re.search(r"hashpartitioning\(customer_id.*, %d\), REPARTITION_BY_NUM" % customers.TERM_PARTITIONS, text)
    assert text.index("Generate") < text.index("REPARTITION_BY_NUM")


def test_merging_terms_takes_more_tasks_than_the_session_has_partitions(spark, tmp_path):
    """Of few partitions each would hold a share of all terms, however many there are."""
    rows = spark.range(400_000).selectExpr(
        "id % 90000 as customer_id", "cast(id % 7 as string) as category", "sha2(cast(id as string), 256) as product_name",
        "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id) as timestamp",
    )
    rows.write.parquet(str(tmp_path / "rows"))
    settings = {"spark.sql.adaptive.enabled": "true", "spark.sql.shuffle.partitions": "2"}
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = {n: spark.conf.get(n) for n in (*settings, advisory)}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        terms = customers.written_basket_terms(spark.read.parquet(str(tmp_path / "rows")))
        assert len(terms.inputFiles()) > 2 and terms.count() == 2 * 400_000
        assert spark.conf.get(advisory) == before[advisory]
        assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) is None
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _most_tasks(spark, work) -> int:
    """The tasks of the largest stage of what ``work`` runs."""
    context = spark.sparkContext
    group = f"tasks-{uuid.uuid4().hex}"
    context.setJobGroup(group, group)
    try:
        work()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(job).stageIds]
    return max(info.numTasks for info in map(tracker.getStageInfo, stages) if info)


@pytest.fixture(scope="module")
def basket_files(spark, tmp_path_factory):
    """A small basket space over forty files of entries, of which a task may read one at a time."""
    path = str(tmp_path_factory.mktemp("baskets") / "entries")
    rows = spark.range(8000).selectExpr("id % 400 as customer_id", "cast(pmod(hash(id), 30) as int) as feature_id")
    rows.distinct().repartition(40, "customer_id", "feature_id").write.parquet(path)
    entries = spark.read.parquet(path)
    loadings = spark.range(30).selectExpr(
        "cast(id as int) as feature_id", *[f"sin(id + {i}) as PC{i + 1}" for i in range(3)]
    )
    scores = materialise(components.project(entries, loadings), "test-scores")
    return clustering.BasketSpace(entries, None, loadings, [], scores)


@pytest.mark.parametrize("step", [
    lambda space: components.PackedBaskets.of(space.entries, np.arange(30)),
    lambda space: clustering.component_checks(space).count(),
])
def test_tasks_that_deal_out_entries_read_little(spark, basket_files, monkeypatch, step):
    """What such a task holds in memory is all that it reads, and must not grow with the entries."""
    monkeypatch.setattr(scratch, "SMALL_TASK_BYTES", "64k")
    files = len(basket_files.entries.inputFiles())
    assert files >= 30 and _most_tasks(spark, lambda: step(basket_files)) >= files


def test_products_of_a_large_vocabulary_read_little(spark, basket_files, monkeypatch):
    """With the block in tables, too, a task's share of the entries must not grow with them. Ten features take one round."""
    monkeypatch.setattr(components, "TABLE_TASK_BYTES", "64k", raising=False)
    monkeypatch.setattr(components, "BROADCAST_BYTES", 0)
    entries = basket_files.entries.where("feature_id < 10")
    vocabulary = materialise(entries.groupBy("feature_id").agg(F.count(F.lit(1)).alias("customers")), "test-vocabulary")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    tasks = _most_tasks(spark, lambda: components.principal_components(entries, vocabulary, 3))
    assert tasks >= len(basket_files.entries.inputFiles())
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_entries_are_written_by_small_tasks(spark, monkeypatch, tmp_path):
    """As many files as the terms ask for, not as the session has cores."""
    monkeypatch.setattr(scratch, "SMALL_TASK_BYTES", "8k")
    rows = spark.range(30_000).selectExpr(
        "id % 2000 as customer_id", "cast(id % 7 as string) as category", "cast(pmod(xxhash64(id), 50) as string) as product_name",
        "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id) as timestamp",
    )
    rows.write.parquet(str(tmp_path / "rows"))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        space = clustering.basket_space(spark.read.parquet(str(tmp_path / "rows")))
        assert len(space.entries.inputFiles()) > spark.sparkContext.defaultParallelism
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
        assert space.scores.count() == 2000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
