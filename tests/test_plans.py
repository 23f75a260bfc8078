"""What Catalyst makes of the job."""

import pytest
from pyspark.sql import functions as F

from checks import inputs
from tillroll.operators import staging

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def staged(spark):
    return staging.stage(inputs.raw_rows(spark, SF), inputs.mapping(spark, SF), inputs.config())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def parses(plan):
    """How often the plan works out the time; scans repeat their filters for information only."""
    return sum(line.count("regexp_replace") for line in plan.splitlines() if "FileScan" not in line)


@pytest.mark.parametrize("fix_date", [False, True])
def test_staging_needs_no_python_and_moves_no_raw_row(spark, fix_date):
    staged = staging.stage(inputs.raw_rows(spark, SF), inputs.mapping(spark, SF), inputs.config(fix_date=fix_date))
    plan = plan_of(staged)
    assert "Python" not in plan and "SinglePartition" not in plan
    # The one shuffle numbers the mapping; the raw side goes straight into the broadcast join.
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in plan


def test_valid_receipts_need_no_shuffle_and_parse_once_before_the_join(staged):
    plan = plan_of(staging.valid(staged, inputs.config()))
    assert "hashpartitioning" not in plan and "SinglePartition" not in plan
    assert "LeftOuter" not in plan
    # once in the filter below the join, once for the receipts that are left
    assert parses(plan) == 2


def test_filter_on_the_fixed_date_parses_once(spark):
    staged = staging.stage(inputs.raw_rows(spark, SF), inputs.mapping(spark, SF), inputs.config(fix_date=True))
    assert parses(plan_of(staged.filter("__dated").select("__dt"))) == 1


def test_shop_ids_read_only_the_shop_number(staged):
    plan = plan_of(staging.shop_ids(staged))
    assert "ReadSchema: struct<user_id:bigint>" in plan
    assert "regexp_replace" not in plan


def test_row_numbers_have_no_single_partition(staged):
    plan = plan_of(staging.errors(staged, inputs.config()))
    assert "SinglePartition" not in plan and "Python" not in plan


def valid_plan(spark, fmt):
    cfg = inputs.config(dt_or_dttm_format=fmt)
    staged = staging.stage(inputs.raw_rows(spark, SF), inputs.mapping(spark, SF), cfg)
    return plan_of(staging.valid(staged, cfg).select(F.col("dttm"), F.col("info")))


@pytest.mark.parametrize("fmt", ["%d %b %Y", "%A %d %B %Y %I %p", "%Y %j %z"])
def test_names_and_offsets_need_no_python(spark, fmt):
    assert "Python" not in valid_plan(spark, fmt)


def test_python_parser_runs_once(spark):
    assert valid_plan(spark, "%x %X").count("ArrowEvalPython") == 1
