"""Plan shape: no Python UDF, no shuffle of exploded rows before the contract-day aggregate,
partition pruning on date-range reports."""

from pyspark.sql import functions as F

from lanecast.plans import catalog, pipeline as P
from tests.conftest import SF_SMALL


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_contract_day_plan(spark):
    """The contract join can spill, exploded rows are not shuffled before the
    contract-day aggregate, and they are made once."""
    st = P.materialised_staging(spark, SF_SMALL)
    text = plan_text(P.M.contract_daily_price(P.M.contract_days(st.datapoints, st.charges), st.exchange_rates))
    assert "SortMergeJoin [datapoint_id" in text and "ShuffledHashJoin" not in text
    phys = text.splitlines()
    gen = [i for i, line in enumerate(phys) if "Generate explode" in line]
    assert len(gen) == 1, "explode missing"
    agg = [i for i, line in enumerate(phys[:gen[0]]) if "HashAggregate(keys=[datapoint_id" in line]
    assert agg, "contract-day aggregate missing"
    assert not any("Exchange" in line and "Broadcast" not in line for line in phys[agg[-1] + 1:gen[0]])


def test_window_reaches_the_scan(spark):
    st = P.materialised_staging(spark, SF_SMALL)
    window = (F.lit("1997-01-01").cast("date"), F.lit("1997-01-31").cast("date"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    text = plan_text(P.M.contract_days(st.datapoints, st.charges, window))
    pushed = [x for x in text.splitlines() if "PushedFilters" in x and "valid_from" in x]
    assert any("LessThanOrEqual(valid_from,1997-01-31)" in x and "GreaterThanOrEqual(valid_to,1997-01-01)" in x for x in pushed)
    assert "LeftSemi" in text  # charges are cut to the window's contracts before they are summed


def test_all_queries_udf_free(spark):
    for key in sorted(catalog.QUERIES):
        text = plan_text(catalog.QUERIES[key](spark, SF_SMALL))
        assert "EvalPython" not in text, key


def test_date_range_report_prunes_partitions(spark):
    df = catalog.QUERIES["port_pair_series"](spark, SF_SMALL)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "valid_month" in text.split("PartitionFilters: [")[1][:300]


def test_mart_states_plan(spark):
    """Contract-days are shuffled once and not expanded for the distinct counts."""
    st = P.materialised_staging(spark, SF_SMALL)
    days = P.M.contract_days(st.datapoints, st.charges, None, 50_000)
    text = plan_text(P.M.lane_states(P.M.contract_daily_price(days, st.exchange_rates)))
    assert "Expand" not in text
    above = text.split("HashAggregate(keys=[datapoint_id")[0]
    assert above.count("Exchange") == 1 and "Exchange hashpartitioning(valid_day" in above
    assert "ArrowEvalPython" not in text and "MapInArrow" not in text
