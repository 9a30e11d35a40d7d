import pytest

from contrail.operators import contracts
from contrail.sources.calendar import holiday_calendar_range

# Golden output: the reference's 2015 holiday file.
GOLDEN_2015 = {
    "2015-01-01": "New Year's Day", "2015-05-25": "Memorial Day", "2015-07-04": "Independence Day",
    "2015-07-03": "Independence Day (observed)", "2015-09-07": "Labor Day",
    "2015-11-26": "Thanksgiving Day", "2015-12-25": "Christmas Day",
    "2015-01-19": "Martin Luther King Jr. Day", "2015-02-16": "Washington's Birthday",
    "2015-10-12": "Columbus Day", "2015-11-11": "Veterans Day",
}


def test_holidays_2015_golden(spark):
    rows = holiday_calendar_range(spark, 2015, 2015).collect()
    assert {str(r["date"]): r["holiday_name"] for r in rows} == GOLDEN_2015
    assert all(r["is_holiday"] == 1 for r in rows)


def test_observed_new_year_on_previous_friday(spark):
    rows = {str(r["date"]): r["holiday_name"] for r in holiday_calendar_range(spark, 1999, 1999).collect()}
    assert rows["1999-12-31"] == "New Year's Day (observed)"


def test_contract_raises_on_missing_and_non_numeric(spark):
    df = spark.createDataFrame([("a", "b")], "IATA_CODE string, AIRLINE string")
    assert contracts.check_contract(df, contracts.AIRLINES)
    with pytest.raises(contracts.ContractError):
        contracts.check_contract(df, contracts.HOLIDAYS)
    ap = spark.createDataFrame([("X", "n", "c", "s", "US", "1.0", 2.0)],
                               "IATA_CODE string, AIRPORT string, CITY string, STATE string, COUNTRY string, "
                               "LATITUDE string, LONGITUDE double")
    with pytest.raises(contracts.ContractError, match="LATITUDE"):
        contracts.check_contract(ap, contracts.AIRPORTS)


def test_presence_report_never_raises(spark):
    df = spark.createDataFrame([(1, 2)], "a int, z int")
    r = contracts.column_presence(spark, {"t": df}, {"t": ["a", "b"]}).first()
    assert (r["missing_columns"], r["extra_columns"], r["all_required_present"]) == ("b", "z", False)
