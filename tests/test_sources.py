"""Reading, writing and whole runs."""

import csv
import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from salescope import sources
from salescope.operators import cleaning, spending
from salescope.plans import jobs
from salescope.plans.registry import ev
from salescope.schema import CORRUPT_COLUMN, TRANSACTION_COLUMNS, TRANSACTION_SCHEMA

HEADER = ",".join(TRANSACTION_COLUMNS)
GOOD = "P-aa,2031-05-04 17:20:09.120345,77,Orla Tamsinger,Port Halyard,B2C,Kettle Product_3,Deck & Cabin > Kettle,12.5,6,75.0"
MORE = 'P-bb,2031-05-06 08:00:01,4410,"Quist, Bram",Low Fen,B2B,Sextant Product_8,Charts > Sextant,310.0,1,310.0'
BAD = "P-cc,soon,none,Ivo Marl,Upper Sound,B2B,Hammock Product_2,Deck & Cabin > Hammock,49.9,two,99.8"


@pytest.fixture
def csv_file(tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("\n".join([HEADER, GOOD, MORE, BAD, GOOD]) + "\n")
    return str(path)


def lines(folder):
    return [r for f in sorted(glob.glob(f"{folder}/*.csv")) for r in csv.reader(open(f))]


def test_typed_read(spark, csv_file):
    df = sources.read_transactions(spark, csv_file)
    assert df.schema == TRANSACTION_SCHEMA
    first = df.where("transaction_id = 'P-aa'").head()
    assert first.timestamp == dt.datetime(2031, 5, 4, 17, 20, 9, 120345)
    assert (first.customer_id, first.quantity, first.total_amount) == (77, 6, 75.0)
    assert sorted(r.transaction_id for r in cleaning.clean(df).collect()) == ["P-aa", "P-bb"]
    assert sources.schema_of(df)[1] == ("timestamp", "timestamp_ntz")
    assert sources.preview(df, 2).count() == 2


def test_rejected_rows_keep_their_text(spark, csv_file):
    df = sources.read_transactions(spark, csv_file, keep_rejected=True)
    assert [r[CORRUPT_COLUMN] for r in sources.rejected_rows(df).collect()] == [BAD]
    assert df.count() == 4


def test_csv_round_trip(spark, csv_file, tmp_path):
    df = sources.read_transactions(spark, csv_file)
    out = str(tmp_path / "out")
    for _ in range(2):  # the second write replaces the first
        sources.write_csv(df, out)
    again = sources.read_transactions(spark, out)
    assert again.count() == df.count() and again.exceptAll(df).count() == 0


def test_ranked_csv(spark, sf, tmp_path):
    top = spending.top_spenders(ev(spark, sf))
    out = str(tmp_path / "top")
    sources.write_ranked_csv(top, out, [F.desc("total_spent"), F.asc("customer_id")], rows=5)
    header, *rows = lines(out)
    assert header == ["rank", *top.columns] and [r[0] for r in rows] == list("01234")
    spent = [float(r[-1]) for r in rows]
    assert spent == sorted(spent, reverse=True)


def test_one_folder_per_category(spark, tmp_path):
    df = spark.createDataFrame([("Deck & Cabin", 1), ("Charts", 2)], "main_category string, n int")
    sources.write_by_category(df, str(tmp_path / "c"))
    folders = sorted(p.name for p in (tmp_path / "c").iterdir() if p.is_dir())
    assert folders == ["category_label=Charts", "category_label=Deck_&_Cabin"]


def test_scratch_goes_to_the_folder_the_session_names(spark):
    path = sources.scratch_path(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert path != sources.scratch_path(spark, "x")
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), [1.0])], "a int, t timestamp_ntz, v array<double>")
    written = sources.materialise(df, "x")
    assert written.collect() == df.collect() and written.dtypes == df.dtypes


def test_whole_run(spark, sf, tmp_path):
    """All reports from a CSV: the events as a file, with copies and one bad row added."""
    raw = ev(spark, sf)
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    sources.write_csv(raw.unionByName(raw.where("customer_type = 'B2B'")), source)
    (tmp_path / "in" / "part-bad.csv").write_text(f"{HEADER}\n{BAD}\n")
    jobs.run(spark, source, out, horizon_hours=0.1, category="ECONOMY")
    prepared = spark.read.parquet(f"{out}/prepared/transactions")
    assert prepared.count() == raw.count()
    assert prepared.select(raw.columns).exceptAll(raw).count() == 0
    assert {r[-1] for r in lines(f"{out}/prepared/rejected")} == {CORRUPT_COLUMN, BAD}
    header, *rows = lines(f"{out}/spending/top_spenders")
    want = spending.top_spenders(raw).collect()
    assert [int(r[1]) for r in rows] == [r.customer_id for r in want]
    produced = {
        "spending": {"top_spenders", "mean_quantities", *spending.QUANTITY_REPORTS},
        "exploration": {"median_amount", "segment_means", "segment_ratio", "category_month_counts", "earliest_rows"},
        "clustering": {"row_clusters", "row_cluster_sample", "time_clusters", "customer_clusters", "extreme_features"},
        "prediction": {"profiles", "top_profiles", "repurchase_scores", "repurchase_quality", "next_amounts"},
    }
    for part, names in produced.items():
        assert names <= {p.name for p in (tmp_path / "out" / part).iterdir()}
    assert spark.read.parquet(f"{out}/clustering/row_clusters").count() == raw.count()
    sample = spark.read.parquet(f"{out}/clustering/row_cluster_sample").count()
    assert sample == -(-raw.count() // 40)
