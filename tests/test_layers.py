"""Raw files to forecast tables in a fresh folder, and the sinks and scans on their own."""

from __future__ import annotations

import datetime as dt
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from siltbed.errors import MissingInputError
from siltbed.functions import surrogate_key
from siltbed.plans import bronze, fixed_values as fixed, forecast, gold, silver
from siltbed.sources.published import publish_table, read_published
from siltbed.sources.readers import (
    concat_bars,
    landed_bars,
    read_csv,
    read_table,
    read_tables,
    rows_frame,
)
from siltbed.sources.session import staged
from siltbed.sources.writers import write_table

YEARS = range(2014, 2026)
COUNTRIES = ["Japan ", "USA", "Germany", "Taiwan", "Atlantis"]
COMPANIES = ["NVIDIA Corp", "Intel", "tsmc"]
WORDS = {
    "country": COUNTRIES,
    "exporting_country": COUNTRIES,
    "importing_country": ["Brazil"],
    "company": COMPANIES,
    "region": ["East Asia", "Europe", "North America"],
    "logistics_route": ["sea, air"],
}


def write_csvs(folder, skip=()):
    """One CSV per dataset: a row for each year and name, quoted text, units, a duplicate."""
    rng = random.Random(4)
    for name, schema in fixed.PANEL_SCHEMAS.items():
        if name in skip:
            continue
        key = next((c for c in ("country", "company", "region", "exporting_country") if c in schema), None)
        lines = [",".join(c.replace("_", " ").title() for c in schema)]
        for year in YEARS:
            for i, word in enumerate(WORDS[key] if key else [None]):
                cells = []
                for c, kind in schema.items():
                    if c == "year":
                        cells.append(str(year))
                    elif c == key:
                        cells.append(f'"{word}"')
                    elif c in WORDS:
                        cells.append(f'"{WORDS[c][i % len(WORDS[c])]}"')
                    elif c == "technology_node_nm":
                        cells.append(f"{(5, 7)[i % 2]}nm")
                    elif c == "node_size_nm":
                        cells.append(str((5, 7)[i % 2]))
                    elif kind == "long":
                        cells.append(str(rng.randrange(1, 50)))
                    else:
                        cells.append(f"{rng.uniform(1, 100) * (1 + (year - 2014) / 10):.4f}")
                lines.append(",".join(cells))
        lines.append(lines[-1])
        (folder / f"{name}.csv").write_text("\n".join(lines) + "\n")


def bar_frames(spark):
    rng = random.Random(8)
    frames = {}
    for ticker, adjusted in (("NVDA", True), ("TSM", False)):
        rows = []
        for i in range(80):
            day = dt.date(2024, 1, 1) + dt.timedelta(days=i)
            o, c = rng.uniform(10, 20), rng.choice([0.0, rng.uniform(10, 20)])
            rows.append((f"{day} 00:00:00-05:00", o, 21.0, 9.0, c, c / 2, rng.choice([0, 100])))
        df = spark.createDataFrame(
            rows, "`index` string, Open double, High double, Low double, Close double, `Adj Close` double, Volume int"
        )
        frames[ticker] = df if adjusted else df.drop("Adj Close")
    return frames


PRICE_PAGE = """<table><tr><th>Date</th></tr>
<tr><td>2024-01-01</td><td>DDR4  8Gb</td><td>US$ 1.80</td><td>usd</td></tr>
<tr><td>2024-01-05</td><td>ddr4 8gb</td><td>n/a</td><td>usd</td></tr>
<tr><td>2024-01-08</td><td>DDR4 8Gb</td><td>1.90</td><td>USD</td></tr>
<tr><td>2024-01-10</td><td>DDR5</td><td>4.10</td></tr></table>"""


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """The whole run, once."""
    raw, root = tmp_path_factory.mktemp("raw"), str(tmp_path_factory.mktemp("lake"))
    write_csvs(raw)
    pages = spark.createDataFrame(
        [("https://h.example/price/dram_spot", PRICE_PAGE), ("https://h.example/price/flash", PRICE_PAGE)],
        "url string, html string",
    )
    report = bronze.run_sources(
        {
            "panels": lambda: bronze.ingest_panels(spark, str(raw), root),
            "bars": lambda: bronze.ingest_bars(spark, bar_frames(spark), root),
            "prices": lambda: bronze.ingest_prices(spark, pages, root),
            "broken": lambda: bronze.ingest_bars(spark, {}, root),
        }
    )
    panels = silver.silver_panels(spark, root)
    bars, prices = silver.silver_bars(spark, root), silver.silver_prices(spark, root)
    written = gold.build_gold(spark, root)
    settings = {"trees": 3, "depth": 2, "learning_rate": 0.3}
    outputs = forecast.run_forecast(spark, root, settings=settings)
    return {
        "root": root,
        "report": report,
        "panels": panels,
        "bars": bars,
        "prices": prices,
        "gold": written,
        "forecast": outputs,
    }


def test_ingest_is_faithful_and_isolated(spark, lake):
    report = lake["report"]
    assert set(report.failures) == {"broken"}
    assert report.written["1_semiconductor_production"].rows == 12 * 5 + 1
    stored = read_table(spark, f"{lake['root']}/{fixed.BRONZE_PANELS}/1_semiconductor_production")
    assert stored.columns[1] == "Country" and stored.filter("`Technology Node Nm` LIKE '%nm'").count() == 61
    quality = report.quality["1_semiconductor_production"].first()
    assert (quality.row_count, quality.duplicate_row_count, quality.passed) == (61, 1, True)
    assert report.profiles["2_ai_hardware_demand"].count() == 8
    assert report.quality["yahoo"].first().passed
    assert report.quality["trendforce"].first().invalid_date_count == 0


def test_silver_panels(spark, lake):
    result = lake["panels"]["1_semiconductor_production"]
    assert (result.rows_in, result.written.rows, result.delta) == (61, 60, -1)
    df = read_table(spark, f"{lake['root']}/{fixed.SILVER_PANELS}/1_semiconductor_production")
    assert dict(df.dtypes)["technology_node_nm"] == "double" and dict(df.dtypes)["year"] == "bigint"
    assert {r.company for r in df.select("company").distinct().collect()} == {"nvidia corp", "intel", "tsmc"}
    assert {c for c in df.columns if c.endswith("_is_outlier")} == {
        f"{c}_is_outlier" for c in fixed.PANEL_OUTLIERS["1_semiconductor_production"]
    }


def test_silver_bars(spark, lake):
    df = read_table(spark, f"{lake['root']}/{fixed.SILVER_BARS}")
    assert lake["bars"].written.rows == df.count() == 160
    assert df.filter("close = 0 OR volume = 0").count() == 0
    assert set(fixed.BAR_MEASURES) < set(df.columns) and "ticker" in df.columns
    # Partitions are pruned by key.
    plan = df.filter("ticker = 'TSM'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(ticker" in plan


def test_silver_prices(spark, lake):
    df = read_table(spark, f"{lake['root']}/{fixed.SILVER_PRICES}")
    one = df.filter("product = 'ddr4 8gb' AND category = 'dram_spot'")
    # 1-4 January at 1.80, a gap from the unparseable 5th on, 8-10 January at 1.90.
    assert [(r.date.day, round(r.price, 2)) for r in one.orderBy("date").collect()] == [
        (1, 1.8), (2, 1.8), (3, 1.8), (4, 1.8), (8, 1.9), (9, 1.9), (10, 1.9),
    ]
    assert {r.unit for r in one.collect()} == {"USD"}
    assert df.filter("product = 'ddr5'").first().unit is None
    raw = read_table(spark, f"{lake['root']}/{fixed.BRONZE_PRICES}")
    filled = silver.clean_prices(raw, drop_bad_first=True).filter("product = 'ddr4 8gb' AND category = 'flash'")
    assert filled.count() == 10
    assert silver.clean_prices(raw, daily=False).filter("product = 'ddr5'").count() == 2


def gold_table(spark, lake, kind, name):
    return read_table(spark, f"{lake['root']}/{kind}/{name}")


def test_gold_dimensions(spark, lake):
    sizes = {n: lake["gold"][n].rows for n in lake["gold"] if n.startswith("dim_")}
    assert sizes == {
        "dim_company": 3,
        "dim_country": 6,
        "dim_region": 3,
        "dim_product": 4,
        "dim_technology": 2,
        "dim_date": 12 + 80 - 1,
    }
    company = gold_table(spark, lake, fixed.GOLD_DIMENSIONS, "dim_company")
    assert company.columns == ["company_key", "company_name", "ticker"]
    assert {(r.company_name, r.ticker) for r in company.collect()} == {
        ("nvidia corp", "NVDA"), ("intel", "INTC"), ("tsmc", "TSM"),
    }
    for name in sizes:
        dim = gold_table(spark, lake, fixed.GOLD_DIMENSIONS, name)
        assert dim.select(dim.columns[0]).distinct().count() == sizes[name]


def test_gold_facts(spark, lake):
    sizes = {n: lake["gold"][n].rows for n in lake["gold"] if n.startswith("fact_")}
    prices = lake["prices"].written.rows
    assert sizes == {
        "fact_ai_demand": 60,
        "fact_chip_market_price": prices,
        "fact_stock_market": 160,
        "fact_semiconductor_production": 60,
        "fact_semiconductor_supply_risk": 60,
    }
    for name in sizes:
        checks = gold.fact_checks(spark, lake["root"], name)
        assert checks["sample"].count() == min(20, sizes[name])
        assert checks["grain"].first().duplicate_rows == 0, name
        nulls = checks["foreign_keys"].first().null_fk_rows
        # Atlantis lies in no region.
        assert nulls == (12 if name == "fact_semiconductor_supply_risk" else 0), name
    production = gold_table(spark, lake, fixed.GOLD_FACTS, "fact_semiconductor_production")
    # Three of five countries produce at a company and node that also has innovation rows.
    assert production.filter("transistor_density IS NOT NULL").count() == 36
    risk = gold_table(spark, lake, fixed.GOLD_FACTS, "fact_semiconductor_supply_risk")
    assert risk.filter("region_name IN ('east asia', 'europe') AND energy_supply_risk IS NULL").count() == 0
    stock = gold_table(spark, lake, fixed.GOLD_FACTS, "fact_stock_market")
    keys = stock.select("company_key").distinct()
    company = gold_table(spark, lake, fixed.GOLD_DIMENSIONS, "dim_company")
    assert keys.join(company, "company_key", "left_semi").count() == 2
    # Prices and production meet on the company, however their sources name it.
    assert keys.join(production, "company_key", "left_semi").count() == 2


def test_repeated_rows_to_enrich_with_do_not_multiply_facts(spark, lake):
    read = lambda path: read_table(spark, f"{lake['root']}/{path}")
    silver_rows = {n: read(gold.SILVER_TABLES[n]) for n in ("production", "innovation", "risk", "disruption")}
    dims = {n: gold_table(spark, lake, fixed.GOLD_DIMENSIONS, n) for n in gold.DIMENSIONS}
    shout = lambda df, c: df.union(df.withColumn(c, F.upper(c)))
    repeated = silver_rows | {
        "innovation": shout(silver_rows["innovation"], "company"),
        "disruption": shout(silver_rows["disruption"], "region"),
    }
    for name in ("fact_semiconductor_production", "fact_semiconductor_supply_risk"):
        expected = gold_table(spark, lake, fixed.GOLD_FACTS, name)
        got = gold.FACTS[name][0](repeated, dims)
        assert got.count() == expected.count() == 60
        assert got.exceptAll(expected).count() == 0


def test_gold_can_be_published(spark, lake, tmp_path):
    (tmp_path / "silver").symlink_to(Path(lake["root"]) / "silver")
    written = gold.build_gold(spark, str(tmp_path), write=publish_table, read=read_published)
    assert {n: w.rows for n, w in written.items()} == {n: w.rows for n, w in lake["gold"].items()}
    path = f"{tmp_path}/{fixed.GOLD_FACTS}/fact_semiconductor_production"
    expected = gold_table(spark, lake, fixed.GOLD_FACTS, "fact_semiconductor_production")
    assert read_published(spark, path).exceptAll(expected).count() == 0


def test_gold_side_by_side_equals_gold_in_turn(spark, lake, tmp_path):
    (tmp_path / "silver").symlink_to(Path(lake["root"]) / "silver")
    report = gold.run_gold(spark, str(tmp_path), f"{tmp_path}/run", write=publish_table, read=read_published)
    assert not report.failures and not report.left_out
    assert {n: w.rows for n, w in report.written.items()} == {n: w.rows for n, w in lake["gold"].items()}
    for name in gold.FACTS:
        expected = gold_table(spark, lake, fixed.GOLD_FACTS, name)
        got = read_published(spark, gold.gold_path(str(tmp_path), name))
        assert got.columns == expected.columns
        assert got.exceptAll(expected).count() == expected.exceptAll(got).count() == 0
    again = gold.run_gold(spark, str(tmp_path), f"{tmp_path}/run", write=publish_table, read=read_published)
    assert set(again.kept) == {*gold.DIMENSIONS, *gold.FACTS} and not again.written


def test_gold_without_a_silver_table_writes_the_others(spark, lake, tmp_path):
    for path in set(gold.SILVER_TABLES.values()) - {gold.SILVER_TABLES["disruption"]}:
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / path).symlink_to(Path(lake["root"]) / path)
    report = gold.run_gold(spark, str(tmp_path))
    # The calendar is made from all panels; all facts look it up.
    assert set(report.failures) == {"dim_region", "dim_date"}
    assert set(report.left_out) == set(gold.FACTS)
    assert set(report.written) == {"dim_company", "dim_country", "dim_product", "dim_technology"}


def test_company_year_rollup(spark, lake):
    production = read_table(spark, f"{lake['root']}/{fixed.SILVER_PANELS}/1_semiconductor_production")
    got = gold.company_year_rollup(production.drop("fab_count"))
    assert got.columns == ["company", "year", *fixed.PRODUCTION_ROLLUP]
    assert (got.count(), got.filter("fab_count IS NULL").count()) == (36, 36)
    total = production.agg(F.sum("foundry_revenue_usd")).first()[0]
    assert got.agg(F.sum("foundry_revenue_usd")).first()[0] == pytest.approx(total)


def test_keys_are_stable(spark, lake):
    dim = gold_table(spark, lake, fixed.GOLD_DIMENSIONS, "dim_country")
    assert dim.filter(dim.country_key != surrogate_key(F.col("country_name"))).count() == 0


def test_forecast_tables(spark, lake):
    sizes = {n: r.rows for n, r in lake["forecast"].items()}
    assert sizes == {"evaluation": 2, "feature_importance": 46, "forecast_country": 25, "forecast_global": 5}
    country = gold_table(spark, lake, fixed.GOLD_FORECAST, "forecast_country")
    assert country.columns == [
        "forecast_year",
        "country_key",
        "country_name",
        "predicted_ai_gpu_demand",
        "predicted_ai_chip_revenue",
        "predicted_market_growth_rate",
    ]
    assert country.dropna().count() == 25
    assert country.filter("predicted_ai_gpu_demand < 0").count() == 0
    total = gold_table(spark, lake, fixed.GOLD_FORECAST, "forecast_global").orderBy("forecast_year")
    assert [r.forecast_year for r in total.collect()] == fixed.FORECAST_YEARS
    assert total.first().cagr == 0.0


def test_missing_dataset_does_not_stop_the_others(spark, tmp_path):
    write_csvs(tmp_path, skip=["1_semiconductor_production"])
    names = ["1_semiconductor_production", "6_supply_chain_disruption"]
    report = bronze.ingest_panels(spark, str(tmp_path), str(tmp_path / "lake"), names)
    assert set(report.written) == {"6_supply_chain_disruption"}
    assert "1_semiconductor_production.csv" in report.failures["1_semiconductor_production"]


def test_no_pages_give_an_empty_typed_table(spark, tmp_path):
    bronze.ingest_prices(spark, None, str(tmp_path))
    df = read_table(spark, f"{tmp_path}/{fixed.BRONZE_PRICES}")
    assert df.dtypes == [(c, "string") for c in fixed.PRICE_COLUMNS] and df.count() == 0


def test_csv_scan(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,text\n1,"two\nlines, ""quoted"""\n2,x\n')
    df = read_csv(spark, str(tmp_path / "a.csv"))
    assert df.dtypes == [("id", "int"), ("text", "string")]
    assert df.orderBy("id").first().text == 'two\nlines, "quoted"'
    declared = read_csv(spark, str(tmp_path / "a.csv"), "id bigint, text string")
    assert declared.dtypes[0] == ("id", "bigint")
    with pytest.raises(MissingInputError, match="gone.csv"):
        read_csv(spark, str(tmp_path / "gone.csv"))


def test_table_scans(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "id int, k string")
    result = write_table(df, str(tmp_path / "t"), ["k"])
    assert (result.rows, result.schema) == (3, "struct<id:int,k:string>")
    assert sorted(p.name for p in (tmp_path / "t").glob("k=*")) == ["k=a", "k=b"]
    assert read_table(spark, str(tmp_path / "t")).columns == ["id", "k"]
    assert read_table(spark, str(tmp_path / "t"), recursive=True).columns == ["id"]
    tables = read_tables(spark, str(tmp_path), {"one": "t"})
    assert tables["one"].count() == 3
    write_table(df.limit(1), str(tmp_path / "t2"), files=1)
    assert len(list((tmp_path / "t2").glob("*.snappy.parquet"))) == 1
    with pytest.raises(MissingInputError, match="nothing-here"):
        read_table(spark, str(tmp_path / "nothing-here"))
    (tmp_path / "empty").mkdir()
    with pytest.raises(MissingInputError, match="empty"):
        read_table(spark, str(tmp_path / "empty"))


def test_landed_bars(spark):
    bars = concat_bars(bar_frames(spark))
    assert bars.columns == fixed.BAR_COLUMNS and bars.count() == 160
    assert dict(bars.dtypes) == {c: t.simpleString() for c, t in bronze.BAR_TYPES.items()}
    assert bars.filter("Ticker = 'TSM' AND `Adj Close` <> Close").count() == 0
    dated = spark.createDataFrame([(dt.date(2024, 1, 1), "X", 1.0, 1.0, 1.0, 1.0, 5)], "Date date, Ticker string, Open double, High double, Low double, Close double, Volume int")
    assert landed_bars(dated).first().Date == "2024-01-01"


def test_rows_and_staging(spark):
    assert rows_frame(spark, [], "a string, b int").dtypes == [("a", "string"), ("b", "int")]
    once = staged(spark.range(5))
    assert once.count() == 5
    assert "Range" not in once._jdf.queryExecution().toString()
