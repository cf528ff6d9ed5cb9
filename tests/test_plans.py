"""Physical plans and whole-plan behaviour."""

from __future__ import annotations

from datetime import datetime

import pytest
from conftest import SMALL, physical_plan, rows
from pyspark.sql import functions as F

from lotwise import schema as S
from lotwise.operators.tables import append_table, overwrite_table, stored
from lotwise.plans import scoring
from lotwise.session import new_folder, working_root
from lotwise.sources.files import record_columns
from lotwise.sources.standin import standin_listings


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """A columnar listings table with all columns of the record."""
    path = str(tmp_path_factory.mktemp("table") / "listings")
    listings = standin_listings(spark, SMALL)
    listings.select(*record_columns(listings)).write.parquet(path)
    return spark.read.parquet(path)


def test_filters_and_columns_reach_the_scan(table):
    plan = physical_plan(scoring.clean_batch(table).select("id", "price"))
    assert "GreaterThan(price,500)" in plan
    assert "LessThan(price,200000)" in plan
    read = plan.split("ReadSchema: ")[1]
    assert "description" not in read and "odometer" not in read


def test_batch_plan_reads_needed_columns_and_shuffles_no_listing(table):
    plan = physical_plan(scoring.score_batch(scoring.clean_batch(table), scan_twice=True))
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan
    assert "SortMergeJoin" not in plan
    for unused in ("url", "description", "image_url", "paint_color"):
        assert unused not in plan


@pytest.mark.parametrize("options", [{"scan_twice": True}, {"broadcast_limit": -1}])
def test_every_way_to_score_gives_the_same_rows(table, options):
    usual = scoring.score_batch(scoring.clean_batch(table))
    other = scoring.score_batch(scoring.clean_batch(table), **options)
    assert usual.exceptAll(other).isEmpty() and other.exceptAll(usual).isEmpty()


def test_live_plan_with_shuffled_statistics(table):
    usual = scoring.score_live(scoring.clean_live(table))
    other = scoring.score_live(scoring.clean_live(table), broadcast_limit=-1)
    assert usual.exceptAll(other).isEmpty() and other.exceptAll(usual).isEmpty()


def test_published_columns(table):
    moment = datetime(2024, 1, 1)
    scored = scoring.score_batch(scoring.clean_batch(table), scan_twice=True)
    published = scoring.published(scored, F.lit(moment))
    assert published.columns == [*S.PUBLISHED_COLUMNS, "processed_at"]
    assert published.first().processed_at == moment
    assert dict(scoring.published(scored).dtypes)["processed_at"] == "timestamp"


def test_null_year_segment_stays_in_the_batch(spark):
    listings = spark.createDataFrame(
        [(i, "a", "b", year, 1000, 5.0, "c", "r", 0.0, 0.0, None)
         for i, year in enumerate(["abc", "abc", "0", None])],
        "id long, manufacturer string, model string, year string, price int, odometer double,"
        " VIN string, region string, lat double, long double, title_status string",
    )
    scored = scoring.score_batch(scoring.clean_batch(listings))
    assert sorted(rows(scored, "id", "year", "group_count"), key=str) == [
        (0, None, 2), (1, None, 2), (2, 0, 1),
    ]
    live = scoring.score_live(scoring.clean_live(listings))
    assert set(rows(live, "year", "group_count")) == {(1900, 4)}


def test_stored_and_written_tables(spark, tmp_path):
    frame = spark.range(5).withColumn("word", F.lit("x"))
    kept = stored(frame)
    assert kept.schema == spark.read.schema(frame.schema).parquet(new_folder_like(kept)).schema
    assert kept.count() == 5
    path = str(tmp_path / "table")
    overwrite_table(frame, path)
    overwrite_table(frame.limit(2), path)
    assert spark.read.parquet(path).count() == 2
    append_table(frame, path)
    assert spark.read.parquet(path).count() == 7


def new_folder_like(frame):
    return frame.inputFiles()[0].rsplit("/", 1)[0]


def test_a_failed_write_raises(spark):
    with pytest.raises(Exception, match="no_such_format"):
        overwrite_table(spark.range(1), "/tmp/never", "no_such_format")


def test_working_folder_comes_from_the_session(spark):
    root = working_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir")
    first, second = new_folder(spark, "a"), new_folder(spark, "a")
    assert first != second
    assert first.startswith(f"{root}/a-")


class Unset:
    """A session that names no working folder."""

    def __init__(self, master, chosen=None):
        self.conf = self
        self.sparkContext = self
        self.master = master
        self.chosen = chosen

    def get(self, key, default):
        return "/w" if key == "spark.sql.warehouse.dir" else default

    def getCheckpointDir(self):
        return self.chosen


def test_only_a_local_master_works_below_its_warehouse():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        working_root(Unset("spark://host:7077"))
    assert working_root(Unset("yarn", "hdfs://shared/x/")) == "hdfs://shared/x"
    local = Unset("local[2]")
    assert working_root(local) == "/w/lotwise-work"
    assert local.chosen is None
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        working_root(Unset("local-cluster[2,1,1024]"))
