"""State tables by day: loads in any order and repeated, ranges, sketches, months of a table, lookups of profiles."""

import datetime as dt
import glob
import re

import pytest
from pyspark.sql import functions as F

from salescope import sources
from salescope.operators import cleaning, customers, daily, spending
from salescope.plans.registry import ev, tx


@pytest.fixture(scope="module")
def rows(spark, sf):
    return sources.materialise(cleaning.enrich(tx(spark, sf)), "test-enriched")


def _sorted(df):
    return sorted(map(str, df.collect()))


def _reports(df):
    return [_sorted(r.select(*[F.round(c, 4).alias(c) if t == "double" else c for c, t in r.dtypes]))
            for r in (spending.top_spenders(df), spending.quantity_reports(df))]


def _year(df, first, before):
    return df.where((F.year("timestamp") >= first) & (F.year("timestamp") < before))


def test_loads_in_any_order_and_twice_equal_one_full_run(spark, rows, tmp_path):
    want = _reports(rows)
    for name, loads in (("a", [(1995, 1998), (1998, 2002)]), ("b", [(1998, 2002), (1996, 1999), (1995, 1998), (1998, 2002)]),
                        ("c", [(1995, 2002), (1995, 2002)])):
        path = str(tmp_path / name)
        for first, before in loads:
            daily.load_sums(_year(rows, first, before), path)
        state = daily.read_state(spark, path)
        assert _reports(state) == want
        assert state.agg(F.sum("purchases")).first()[0] == rows.count()


def test_a_day_is_replaced_by_its_newer_load_and_its_neighbours_stay(spark, rows, tmp_path):
    path = str(tmp_path / "state")
    daily.load_sums(rows, path)
    day = rows.agg(F.min(F.to_date("timestamp"))).first()[0]
    of_day = rows.where(F.to_date("timestamp") == F.lit(day))
    daily.load_sums(of_day.limit(1), path)
    state = daily.read_state(spark, path)
    lost = of_day.count() - 1
    assert state.agg(F.sum("purchases")).first()[0] == rows.count() - lost
    daily.load_sums(rows.limit(0), path)
    assert daily.read_state(spark, path).agg(F.sum("purchases")).first()[0] == rows.count() - lost


def test_purchases_without_a_time_and_null_groups(spark, rows, tmp_path):
    path = str(tmp_path / "state")
    odd = rows.limit(50).withColumns({"timestamp": F.lit(None).cast("timestamp_ntz"), "sub_category": F.lit(None).cast("string"),
                                      "customer_type": F.lit(None).cast("string")})
    for _ in range(2):
        daily.load_sums(odd.unionByName(rows), path)
    state = daily.read_state(spark, path)
    assert state.agg(F.sum("purchases")).first()[0] == rows.count() + 50
    assert state.where("day is null").agg(F.sum("purchases")).first()[0] == 50


def test_ranges_read_their_months_only(spark, rows, tmp_path):
    path = str(tmp_path / "state")
    daily.load_sums(rows, path)
    first, last = dt.date(1996, 3, 5), dt.date(1996, 6, 20)
    part = daily.between(daily.read_state(spark, path), first, last)
    want = rows.where(F.to_date("timestamp").between(F.lit(first), F.lit(last)))
    assert part.agg(F.sum("purchases")).first()[0] == want.count()
    assert _reports(part) == _reports(want)
    text = part._jdf.queryExecution().executedPlan().toString()
    filters = re.search(r"PartitionFilters: \[(.*?)\],", text).group(1)
    assert "1996-03" in filters and "1996-06" in filters


def test_sketches_merge_within_their_bound(spark, rows, tmp_path):
    path = str(tmp_path / "sketches")
    for first, before in ((1995, 1998), (1997, 2002), (1997, 2002)):
        daily.load_sketches(_year(rows, first, before), path)
    state = daily.read_state(spark, path)
    for share in (0.1, 0.5, 0.9):
        found = {r.customer_type: r for r in daily.sketched_quantile(state, share, "q", "customer_type").collect()}
        for kind, r in found.items():
            amounts = sorted(x.total_amount for x in rows.where(F.col("customer_type") == kind).collect())
            assert r.purchases == len(amounts)
            rank = sum(a <= r.q for a in amounts) / len(amounts)
            assert abs(rank - share) <= 2 * daily.RANK_ERROR
    assert 0.005 < daily.RANK_ERROR < 0.01
    nothing = daily.sketched_quantile(state.limit(0), 0.5, "q", "customer_type")
    assert nothing.count() == 0


def test_months_of_a_table_are_pruned_and_files_bounded(spark, rows, tmp_path):
    path = str(tmp_path / "by-month")
    sources.write_by_month(rows.repartition(16), path)
    back = sources.read_by_month(spark, path)
    assert sorted(back.columns) == sorted(rows.columns)
    assert back.select(rows.columns).exceptAll(rows).count() == 0 and back.count() == rows.count()
    months = rows.select(F.date_format("timestamp", "yyyy-MM")).distinct().count()
    assert len(glob.glob(f"{path}/*/*/*.parquet")) <= months + 8
    part = sources.read_by_month(spark, path, dt.datetime(1996, 3, 5), dt.datetime(1996, 7, 1))
    want = rows.where("timestamp >= timestamp_ntz'1996-03-05' and timestamp < timestamp_ntz'1996-07-01'")
    assert part.count() == want.count() > 0
    text = part._jdf.queryExecution().executedPlan().toString()
    assert "year" in re.search(r"PartitionFilters: \[(.*?)\],", text).group(1)
    assert "timestamp" in re.search(r"PushedFilters: \[(.*?)\],", text).group(1)


def test_lookups_read_far_fewer_rows_than_the_table(spark, tmp_path):
    path = str(tmp_path / "profiles")
    profiles = spark.range(200_000).selectExpr(
        "id * 3 as customer_id", "cast(id as double) as total_spend", "uuid() as customer_type")
    sources.save_indexed_profiles(profiles, path, group_bytes=100_000)
    found = sources.lookup_profiles(spark, path, [30_000, 30_001, 599_997, -5])
    assert sorted(r.customer_id for r in found.collect()) == [30_000, 599_997]
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "customer_id,30000" in re.search(r"PushedFilters: \[(.*?)\]", text).group(1)
    one = sources.lookup_profiles(spark, path, [30_000])
    assert one.collect()[0].total_spend == 10_000.0
    plan = one._jdf.queryExecution().executedPlan()
    read = []

    def walk(node):
        if "numFiles" in str(node.metrics().keySet().toString()):
            read.append(node.metrics().apply("numOutputRows").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    one._jdf.queryExecution().executedPlan().executeCollect()
    walk(plan)
    assert read and 0 < sum(read) <= 50_000
    assert sources.lookup_profiles(spark, path, []).count() == 0


def test_indexed_profiles_are_the_profiles(spark, sf, tmp_path):
    profiles = customers.customer_profiles(ev(spark, sf))
    sources.save_indexed_profiles(profiles, str(tmp_path / "p"))
    assert _sorted(sources.read_parquet(spark, str(tmp_path / "p"))) == _sorted(profiles)


def test_a_load_writes_itself_once_and_only_the_days_it_keeps(spark, rows, tmp_path, monkeypatch):
    written, original = [], daily.materialise
    monkeypatch.setattr(daily, "materialise", lambda df, name: written.append((t := original(df, name)).count()) or t)
    path = str(tmp_path / "state")
    daily.load_sums(_year(rows, 1995, 1998), path)
    daily.load_sums(_year(rows, 1997, 2000), path)
    assert len(written) == 3 and written[2] == 0


def test_loads_read_only_the_columns_of_the_state(spark, sf, monkeypatch):
    from salescope.plans import registry

    columns, original = [], registry.materialise
    monkeypatch.setattr(registry, "materialise", lambda df, name: columns.append(df.columns) or original(df, name))
    registry.spenders_in_range(spark, sf)
    registry.sketched_medians(spark, sf)
    assert columns == [list(daily.SUM_COLUMNS), list(daily.SKETCH_COLUMNS)]
