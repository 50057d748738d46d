"""Data-quality checks on hand tables, and CSV scanning edge cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lanecast import schemas
from lanecast.functions.compat import file_stem, table_name_from_file
from lanecast.operators import quality as Q
from lanecast.session import scratch_path
from lanecast.sources import csv as CSV

D0 = dt.date(2024, 1, 1)


def test_checks_count_failures(spark):
    dps = spark.createDataFrame([
        (1, None, 1, 2, D0, D0, 1, 1, 1, D0),
        (1, dt.datetime(2024, 1, 1), 1, 2, D0, D0, 1, 1, 9, D0),
        (2, dt.datetime(2024, 1, 1), 1, 2, D0, D0, 1, 1, 7, D0),
    ], schemas.STG_DATAPOINTS)
    ch = spark.createDataFrame([(1, "USD", 5, D0), (3, "USD", 1, D0), (None, "", 1, D0)], schemas.STG_CHARGES)
    fx = spark.createDataFrame([(D0, "USD", 1.0, D0)], schemas.STG_EXCHANGE_RATES)
    res = {(r.test_name, r.model, r.column_name): r.failures
           for r in Q.run_checks({"datapoints": dps, "charges": ch, "exchange_rates": fx}).collect()}
    assert res[("not_null", "datapoints", "created")] == 1
    assert res[("not_null", "charges", "datapoint_id")] == 1
    assert res[("unique", "datapoints", "datapoint_id")] == 1
    assert res[("relationships", "charges", "datapoint_id")] == 1     # id 3; NULL is not checked
    assert res[("relationships", "charges", "currency")] == 1         # ''
    assert res[("accepted_values", "datapoints", "equipment_id")] == 2  # 9 and 7


def test_contract_finds_a_renamed_stored_column(spark):
    """The files of one of two segments are rewritten with another name, then
    with another type; the readers of the library still give the contract."""
    import os
    from lanecast.sources import tables as TB
    root = scratch_path(spark, "test-contract")
    path = f"{root}/regions"
    row = lambda s: spark.createDataFrame([(s, "n", None, D0)], schemas.STG_REGIONS)
    TB.overwrite(row("a").unionByName(row("b")), path)
    TB.append(row("c"), path)

    def found():
        got = Q.contract_checks(spark, [("regions", TB.segment_paths(spark, path), schemas.STG_REGIONS)]).collect()
        return {r.column_name: (r.rows_checked, r.failures) for r in got}
    fine = {c: (3, 0) for c in schemas.STG_REGIONS.fieldNames()}
    assert found() == fine
    first = TB.segment_paths(spark, path)[0]

    def rewrite(df):
        df.write.parquet(f"{first}-new")
        os.rename(first, f"{first}-old")
        os.rename(f"{first}-new", first)
        os.rename(f"{first}-old", f"{root}/{len(os.listdir(root))}")
    rewrite(spark.read.parquet(first).withColumnRenamed("name", "nom"))
    assert TB.read(spark, path, schemas.STG_REGIONS).schema == schemas.STG_REGIONS
    assert found() == fine | {"name": (3, 2), "nom": (2, 2)}
    rewrite(spark.read.parquet(first).withColumnRenamed("nom", "name").withColumn("load_date", F.col("load_date").cast("string")))
    assert found() == fine | {"load_date": (3, 2)}
    rewrite(spark.read.parquet(first).limit(0).drop("parent").withColumn("load_date", F.lit(D0)))
    assert found()["parent"] == (1, 1)  # a table without rows fails too


def test_table_name_from_file(spark):
    names = ["DE_casestudy_charges_2.csv", "DE_casestudy_exchange_rates.csv", "casestudy_ports.csv",
             "charges_11.csv", "DE_casestudy_data-points 3.csv", "/x/y/DE_regions.csv"]
    df = spark.createDataFrame([(n,) for n in names], "f string")
    got = [r[0] for r in df.select(table_name_from_file(file_stem("f"))).collect()]
    assert got == ["charges", "exchange_rates", "ports", "charges", "data_points 3".replace(" ", "_"),
                   "regions"]


def test_csv_scan_quotes_nulls_and_folders(spark):
    import os
    root = scratch_path(spark, "csvtest")
    os.makedirs(f"{root}/full_load", exist_ok=True)
    with open(f"{root}/full_load/DE_casestudy_ports.csv", "w") as f:
        f.write('PID,CODE,SLUG,NAME,COUNTRY,COUNTRY_CODE\n'
                '1,cnsha,china_east_main,Shanghai,China,CN\n'
                '2,uslgb,us_west_coast,"Long Beach, CA",United States,\n')
    df = CSV.scan(spark, root, "ports", "full", "2025-01-01").orderBy("pid").collect()
    assert df[1].name == "Long Beach, CA" and df[1].country_code is None
    assert df[0].file_path == "full_load/DE_casestudy_ports.csv" and df[0].load_date == dt.date(2025, 1, 1)
    inv = {r.file_name: (r.table_name, r.row_count)
           for r in CSV.file_inventory(spark, f"{root}/full_load").collect()}
    assert inv == {"DE_casestudy_ports.csv": ("ports", 2)}


def _file(root, name, text):
    import os
    os.makedirs(f"{root}/full_load", exist_ok=True)
    with open(f"{root}/full_load/{name}", "w") as f:
        f.write(text)


def test_csv_zoned_times_and_decimal_charges(spark):
    root = scratch_path(spark, "csvtypes")
    head = "D_ID,CREATED,ORIGIN_PID,DESTINATION_PID,VALID_FROM,VALID_TO,COMPANY_ID,SUPPLIER_ID,EQUIPMENT_ID\n"
    times = ["2021-03-01 05:12:11+00", "2021-03-01 05:12:11.123456+00:00", "2021-03-01T05:12:11Z", "2021-03-01 07:12:11+02"]
    _file(root, "DE_casestudy_datapoints_1.csv", head + "".join(
        f"{i},{t},1,2,2021-03-01,2021-03-02,1,1,1\n" for i, t in enumerate(times)))
    _file(root, "DE_casestudy_charges_1.csv", "D_ID,CURRENCY,CHARGE_VALUE\n1,USD,12.5\n2,USD,1e3\n3,USD,7\n")
    from lanecast.operators import staging as S
    rows = S.stg_datapoints(CSV.scan(spark, root, "datapoints", "full", "2025-01-01"), "2025-01-01").collect()
    assert {r.created.replace(microsecond=0) for r in rows} == {dt.datetime(2021, 3, 1, 5, 12, 11)} and len(rows) == 4
    raw = CSV.scan(spark, root, "charges", "full", "2025-01-01")
    assert sorted(r.charge_value for r in raw.collect()) == [7.0, 12.5, 1000.0]
    assert sorted(r.charge_value for r in S.stg_charges(raw, "2025-01-01").collect()) == [7, 12, 1000]


def test_csv_bad_input_is_an_error(spark):
    root = scratch_path(spark, "csvbad")
    for head in ("CURRENCY,D_ID,VALUE", "D_ID,CURRENCY", "D_ID,CURRENCY,CHARGE_VALUE,d_id"):
        _file(root, "DE_casestudy_charges_1.csv", f"{head}\nUSD,9,1\n")
        with pytest.raises(ValueError, match="CSV header"):
            CSV.scan(spark, root, "charges", "full", "2025-01-01")
    _file(root, "DE_casestudy_charges_1.csv", "D_ID,CURRENCY,CHARGE_VALUE\nx,USD,1\n")
    with pytest.raises(Exception, match="[Mm]alformed"):
        CSV.scan(spark, root, "charges", "full", "2025-01-01").collect()
    with pytest.raises(ValueError):
        CSV.scan(spark, root, "charges", "full", None)
    with pytest.raises(FileNotFoundError):
        CSV.load_tables(spark, f"{root}/nowhere", root, "full", "2025-01-01")
    _file(root, "other.csv", "D_ID,CURRENCY,CHARGE_VALUE\n4,USD,1\n")
    assert CSV.scan(spark, root, "charges", "full", "2025-01-01", "full_load/other.csv").first().d_id == 4


def test_csv_columns_are_found_by_name(spark):
    """Files whose headers differ in order, and one with a new column, give the
    rows of files in the schema's order; the new column reaches the raw table."""
    from lanecast.plans import pipeline as P
    from lanecast.sources import tables as TB
    root = scratch_path(spark, "csvnames")
    _file(root, "DE_casestudy_charges_1.csv", "D_ID,CURRENCY,CHARGE_VALUE\n1,USD,10\n2,\"\",20\n")
    _file(root, "DE_casestudy_charges_2.csv", "\ufeffCharge_Value,D_ID,CURRENCY\n30,3,EUR\n")
    _file(root, "DE_casestudy_charges_3.csv", "CURRENCY,NOTE,CHARGE_VALUE,D_ID\nNOK,\"a, b\",40,4\n,,50,5\n")
    _file(root, "DE_casestudy_charges_4.csv", "")
    df = CSV.scan(spark, root, "charges", "full", "2025-01-01")
    assert df.columns == ["d_id", "currency", "charge_value", "file_path", "load_type", "load_date", "note"]
    got = sorted((r.d_id, r.currency, r.charge_value, r.note) for r in df.collect())
    assert got == [(1, "USD", 10.0, None), (2, "", 20.0, None), (3, "EUR", 30.0, None), (4, "NOK", 40.0, "a, b"), (5, None, 50.0, None)]
    path = f"{root}/raw"
    TB.overwrite(df.filter("d_id < 4").drop("note"), path)
    P.append_raw_charges(spark, df, path)
    assert sorted((r.d_id, r.note) for r in TB.read(spark, path).collect()) == [(1, None), (2, None), (3, None), (4, "a, b"), (5, None)]
    with pytest.raises(Exception):
        CSV.scan(spark, root, "charges", "full", "2025-01-01", "full_load/none.csv").collect()
