"""Ready-made queries on small sales tables under their own names."""

import datetime as dt

import pytest

from spokewise.plans import categories as pc
from spokewise.plans import products as pp
from spokewise.plans import series as ps
from spokewise.plans import summaries as sm


def tuples(df):
    return [tuple(x) for x in df.collect()]


@pytest.fixture(scope="module")
def sales(spark):
    rows = [
        (dt.datetime(2011, 1, 7), 100.0, "Road", "Elite Road", "Carbon"),
        (dt.datetime(2011, 2, 7), 150.0, "Road", "Elite Road", "Aluminum"),
        (dt.datetime(2012, 2, 9), 300.0, "Road", "Endurance Road", "Carbon"),
        (dt.datetime(2012, 4, 1), 75.0, "Mountain", "Trail", "Aluminum"),
        (dt.datetime(2013, 1, 1), 375.0, "Mountain", "Over Mountain", "Carbon"),
    ]
    schema = "order_date timestamp, total_price double, category_1 string, category_2 string, frame_material string"
    return spark.createDataFrame(rows, schema)


def test_yearly(sales):
    rows = ps.yearly_change(sales).orderBy("order_year").collect()
    assert [r.yoy_pct for r in rows] == ["0.0%", "50.0%", "0.0%"]
    since = ps.yearly_since_first(sales).orderBy("order_year").collect()
    assert [r.increase_pct for r in since] == ["0.0%", "50.0%", "50.0%"]
    running = ps.yearly_running(sales).orderBy("order_year").collect()
    assert [r.running_sales for r in running] == [250, 625, 1000]
    assert [r.running_mean for r in running] == pytest.approx([250, 312.5, 1000 / 3])
    assert running[-1].running_share == 1


def test_yearly_text(sales):
    assert [r.sales_text for r in ps.sales_by_year(sales).collect()] == ["$250", "$375", "$375"]


def test_monthly(sales):
    rows = ps.monthly_change(sales).orderBy("order_year", "month").collect()
    assert [r.order_month for r in rows] == ["Jan", "Feb", "Feb", "Apr", "Jan"]
    assert [r.pct_diff for r in rows] == pytest.approx([0, 0.5, 1.0, -0.75, 4.0])
    since = ps.monthly_since_first(sales).orderBy("order_year", "month").collect()
    assert [r.sales_jan for r in since] == [100, 100, 300, 300, 375]
    rolled = ps.monthly_rolling(sales, (3,)).orderBy("order_year", "month").collect()
    assert [r.roll_mean_3m for r in rolled] == pytest.approx([0, 0, 550 / 3, 175, 250])
    running = ps.monthly_running(sales).orderBy("order_year", "month").collect()
    assert [r.running_share_pct for r in running] == ["40.0%", "100.0%", "80.0%", "100.0%", "100.0%"]


def test_calendar_month_report(sales):
    report = ps.calendar_month_report(sales)
    assert report.columns == ["Month", "Sales"]
    assert tuples(report) == [("Jan", "$475"), ("Feb", "$450"), ("Apr", "$75")]


def test_quarters_and_their_level_order(sales):
    rows = pc.quarterly_reordered(sales).orderBy("category_2_code").collect()
    assert rows[0].category_2 == "Over Mountain" and rows[0].order_quarter == dt.date(2013, 1, 1)
    assert rows[-1].category_2 == "Trail" and rows[-1].category_2_code == 4


def test_lumped_categories(sales):
    rows = pc.category_lumped(sales, n=2).orderBy("category_2_code").collect()
    assert [(r.category_2, r.revenue) for r in rows] == [
        (pc.OTHER_CATEGORY, 325.0),
        ("Endurance Road", 300.0),
        ("Over Mountain", 375.0),
    ]


def test_category_codes(sales):
    rows = {r.category_2: r for r in pc.category_codes(sales).collect()}
    assert rows["Over Mountain"].rank_code == 1 and rows["Over Mountain"].reversed_code == 4
    assert rows["Elite Road"].name_code == 1


def test_frame_gaps(sales):
    report = sm.frame_gap_report(sales, ["Aluminum", "Carbon"])
    assert report.columns == ["Primary Category", "Secondary Category", "Aluminum", "Carbon", "Total Sales"]
    assert tuples(report) == [
        ("Mountain", "Over Mountain", "$0", "$375", "$375"),
        ("Road", "Endurance Road", "$0", "$300", "$300"),
        ("Road", "Elite Road", "$150", "$100", "$250"),
        ("Mountain", "Trail", "$75", "$0", "$75"),
    ]


def test_sales_report(sales):
    report = sm.sales_report_by(sales, "category_1", "Primary Category")
    assert report.columns == ["Primary Category", "Sales"]
    assert tuples(report) == [("Road", "$550"), ("Mountain", "$450")]


def test_round_trip_takes_the_day_not_the_month(sales):
    row = ps.date_round_trip(sales.select("order_date").limit(1)).first()
    assert (row.order_date, row.year, row.month, row.date) == ("2011-01-07", 2011, 1, 7)
    assert row.order_date_united == dt.date(2011, 1, 7)


def test_days_since_order(sales):
    rows = ps.days_since_order(sales.select("order_date"), dt.date(2011, 1, 8)).orderBy("order_date")
    assert rows.first().days_interval == 1.0


@pytest.fixture(scope="module")
def bikes(spark):
    models = [
        "Supersix Evo Black Inc.",
        "Supersix Evo Hi-Mod Utegra",
        "Syapse Carbon Tiagra",
        "CAAD Disc Ultegra",
        "Beast of the East 1",
        "Bad Habit 2",
        "Fat CAAD2",
        "Scalpel 29 Carbon Race",
        "Scalpel-Si Black Inc.",
        "Jekyll Carbon 1",
        None,
    ]
    return spark.createDataFrame([(m,) for m in models], "model string")


def test_model_features(bikes):
    rows = {r.model: r for r in pp.model_features(bikes).collect()}
    found = {m: (r.base_model, r.model_tier) for m, r in rows.items()}
    assert found == {
        "Supersix Evo Black Inc.": ("Supersix Evo", "Black Inc."),
        "Supersix Evo Hi-Mod Ultegra": ("Supersix Evo", "Hi-Mod Ultegra"),
        "Synapse Carbon Tiagra": ("Synapse", "Carbon Tiagra"),
        "CAAD12 Disc Ultegra": ("CAAD12", "Disc Ultegra"),
        "Beast of the East 1": ("Beast of the East", "1"),
        "Bad Habit 2": ("Bad Habit", "2"),
        "Fat CAAD2": ("Fat CAAD2", ""),
        "Scalpel 29 Carbon Race": ("Scalpel 29", "Carbon Race"),
        "Scalpel-Si Black Inc.": ("Scalpel-Si", "Black Inc."),
        "Jekyll Carbon 1": ("Jekyll", "Carbon 1"),
        None: (None, None),
    }
    assert (rows["Supersix Evo Hi-Mod Ultegra"].hi_mod, rows["Supersix Evo Hi-Mod Ultegra"].ultegra) == (1, 1)
    assert (rows["CAAD12 Disc Ultegra"].disc, rows["CAAD12 Disc Ultegra"].black) == (1, 0)
    assert rows[None].black is None
    assert not any(c.startswith("model_") and c != "model_tier" for c in pp.model_features(bikes).columns)


def test_price_by_base_model(spark):
    rows = [("Road", "Elite Road", "Supersix Evo 1", 10.5)] * 3 + [
        ("Road", "Elite Road", "Supersix Evo 2", 20.5),
        ("Road", "Elite Road", "CAAD12 Red", 5.0),
    ]
    sales = spark.createDataFrame(rows, "category_1 string, category_2 string, model string, price double")
    distinct = pp.price_by_base_model(sales)
    assert tuples(distinct.select("base_model", "sales_avg", "sales_min", "sales_max")) == [
        ("Supersix Evo", 15.5, 10.5, 20.5),
        ("CAAD12", 5.0, 5.0, 5.0),
    ]
    weighted = pp.price_by_base_model(sales, distinct=False)
    assert weighted.first().sales_avg == 13.0
    report = pp.base_model_price_report(distinct)
    assert report.columns == ["Category 1", "Category 2", "Base Model", "Sales Avg", "Sales Min", "Sales Max"]
    assert report.first()["Sales Avg"] == "$16"


def test_model_type_and_flags(bikes):
    typed = pp.model_type(bikes, {"supersix": "SuperSix", "jekyll": "Jekyll"}, "Neither SuperSix nor Jekyll")
    kinds = {r.model: r.bike_type for r in typed.collect()}
    assert kinds["Jekyll Carbon 1"] == "Jekyll" and kinds["Supersix Evo Black Inc."] == "SuperSix"
    assert kinds[None] == kinds["Bad Habit 2"] == "Neither SuperSix nor Jekyll"
    assert pp.models_with(bikes, "supersix", "is_supersix").count() == 2


def test_median_report(spark):
    sales = spark.createDataFrame(
        [("A Black Inc", 10.0), ("b black", 15.5), ("c", 1.0), (None, 99.0)], "model string, total_price double"
    )
    report = sm.median_report(sales, "black", "Black Inc")
    assert report.columns == ["Black Inc", "Median Sales"]
    assert set(tuples(report)) == {(True, "$13"), (False, "$1"), (None, "$99")}


def test_statement(spark):
    df = spark.createDataFrame(
        [("Ithaca mountain climbers", 1, 2)], "bikeshop_name string, order_id bigint, order_line bigint"
    )
    text = pp.purchase_statements(df).first().purchase_statement
    assert text == "Order line : 1.2 sent to customer: Ithaca Mountain Climbers"
