import datetime as dt
import io
import zipfile


from ledgerlens.plans import fx, reports
from ledgerlens.sources import fx_files
from conftest import rows


def _wide(spark):
    return spark.createDataFrame([
        ("2017-12-31", 1.0, 10.0), ("2018-01-01", 2.0, None), ("2018-01-02", 3.0, 20.0),
        ("2018-01-03", 4.125, 30.0)], "Date string, USD double, GBP double")


def _currency(spark):
    return spark.createDataFrame([(1, "USD", "Dollar"), (2, "GBP", "Pound"), (3, "EUR", "Euro")],
                                 "id long, iso_code string, name string")


def test_weekly_average_table(spark):
    x2 = fx.weekly_average_table(fx.long_rates(_wide(spark)), _currency(spark))
    assert x2.columns == ["date", "currency", "exchange_rate", "week_nr", "weekly_avg", "currency_name"]
    got = rows(x2.select("date", "currency", "week_nr", "weekly_avg"))
    # 2017-12-31 is a Sunday: week 201753; 2018-01-01..03 are week 201800
    assert got == [
        (dt.date(2017, 12, 31), "GBP", "201753", 10.0), (dt.date(2017, 12, 31), "USD", "201753", 1.0),
        (dt.date(2018, 1, 1), "USD", "201800", 9.125 / 3), (dt.date(2018, 1, 2), "GBP", "201800", 25.0),
        (dt.date(2018, 1, 2), "USD", "201800", 9.125 / 3), (dt.date(2018, 1, 3), "GBP", "201800", 25.0),
        (dt.date(2018, 1, 3), "USD", "201800", 9.125 / 3)]


def test_rates_since_is_strict_and_half_even(spark):
    weekly = spark.createDataFrame([
        (dt.date(2018, 1, 1), "USD", "201800", 9.085), (dt.date(2018, 1, 2), "USD", "201800", 9.085),
        (dt.date(2018, 1, 1), "GBP", "201800", 1.5), (dt.date(2018, 1, 9), "GBP", "201801", 9.075)],
        "date date, currency string, week_nr string, weekly_avg double")
    got = rows(fx.rates_since(weekly, "2018-01-01"))
    assert got == [("GBP", "201801", 9.08), ("USD", "201800", 9.08)]


def test_convert_two_roles(spark):
    df = spark.createDataFrame([
        (100.0, "USD", "Dollar", "201800", 50.0, "EUR", "Euro", "201800"),
        (100.0, "EUR", "Euro", "201800", 50.0, "GBP", "Pound", "209900")],
        "revenue double, currency_code string, sales_currency string, sales_week_nr string, "
        "invoice_amount double, invoice_currency_code string, invoice_currency string, invoice_week_nr string")
    rates = spark.createDataFrame([("USD", "201800", 0.8), ("GBP", "201800", 2.0)],
                                  "currency_code string, week_nr string, rate_avg double")
    out = reports.convert_two_roles(df, rates).select("rate_avg", "dc_sales_amount", "rate_avg_inv",
                                                      "dc_invoice_amount")
    assert rows(out) == [(0.8, 125.0, 1.0, 50.0), (1.0, 100.0, None, None)]


def test_a_tiny_rate_keeps_its_digits(spark):
    wide = spark.createDataFrame([("2024-01-01", 1.23e-7), ("2024-01-02", 1.25e-7)], "Date string, USD double")
    x2 = fx.weekly_average_table(fx.long_rates(wide), _currency(spark))
    assert rows(x2.select("exchange_rate", "weekly_avg")) == [(1.23e-7, 1.24e-7), (1.25e-7, 1.24e-7)]


def test_weekly_mean_has_no_window(spark):
    plan = fx.with_weekly_mean(fx.long_rates(_wide(spark)))._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


def _landed(spark, tmp_path, *bodies):
    for i, body in enumerate(bodies):
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w") as zf:
            zf.writestr("rates.csv", body)
        (tmp_path / f"hist{i}.zip").write_bytes(buf.getvalue())
    return fx_files.newest_cells(fx_files.read_zipped_cells(spark, str(tmp_path / "*.zip")))


def test_archive_keeps_every_date_and_the_column_order(spark, tmp_path):
    cells = _landed(spark, tmp_path, "Date,USD,AUD,IDX,\n2024-01-01,1.1,N/A,2,\n2024-01-02,N/A,N/A,N/A,\n")
    wide = fx_files.cells_to_wide(cells)
    assert wide.columns == ["Date", "USD", "AUD", "IDX"]
    assert rows(wide) == [("2024-01-01", 1.1, None, 2.0), ("2024-01-02", None, None, None)]
    assert rows(fx_files.cells_to_long(cells)) == [
        (dt.date(2024, 1, 1), "IDX", 2.0), (dt.date(2024, 1, 1), "USD", 1.1)]


def test_overlapping_archives_give_each_date_from_the_newest(spark, tmp_path):
    cells = _landed(spark, tmp_path, "Date,USD,GBP,\n2024-01-01,1.1,5,\n2024-01-02,1.2,0.9,\n",
                    "Date,USD,\n2024-01-02,7,\n2024-01-03,1.3,\n")
    assert rows(fx_files.cells_to_wide(cells)) == [
        ("2024-01-01", 1.1, 5.0), ("2024-01-02", 7.0, None), ("2024-01-03", 1.3, None)]
    assert fx_files.cells_to_long(cells).count() == 4


def test_plain_rate_csv(spark, tmp_path):
    p = tmp_path / "rates.csv"
    p.write_text("Date,USD,GBP\n2024-01-01,1.1,N/A\n")
    df = fx_files.read_rates_csv(spark, str(p))
    r = df.first()
    assert r.USD == 1.1 and r.GBP is None
