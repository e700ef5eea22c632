"""The batch plan on a handful of raw files, and from raw payloads."""

from datetime import date, timedelta

from pyspark.sql import functions as F

from skyledger.operators import adapters, extract
from skyledger.operators.merge import merge_sources
from skyledger.plans.lakehouse import bronze, build, gold, silver
from skyledger.storage import staged
from tests.conftest import values


def write(folder, name, lines):
    path = folder / name
    path.mkdir()
    (path / f"{name}.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_raw_files_to_forecast(spark, tmp_path):
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(40)]
    raw = {
        "calendar": write(tmp_path, "calendar", [
            "Governorate,Condition,High Temp (C),Low Temp (C),Date",
            *[f"Cairo,{'Fog' if i % 3 else 'Sunny'},{20 + i % 7},{10 + i % 5},{d}" for i, d in enumerate(days)]]),
        "archive": write(tmp_path, "archive", [
            "Governorate,Date,Weather_Code,Max_Temp,Min_Temp,Avg_Humidity,Source",
            *[f"{p},{d},1,{22 + i % 7},{12 + i % 5},{'' if i == 3 else 50},s" for p in ("Cairo", "Luxor") for i, d in enumerate(days)]]),
        "monthly": write(tmp_path, "monthly", [
            "Governorate,Date,Year,Month,Weather_Code,Max_Temp,Min_Temp,Avg_Humidity,Source",
            "Cairo,2024-03-01,2024,3,1.0,25,15,40,api", "Cairo,2024-01-01,2024,1,1.0,99,15,40,api"]),
        "normals": write(tmp_path, "normals", ["h" + ",h" * 14, "Rain," + ",".join("123456789abc") + ",1,src"]),
        "revisions": write(tmp_path, "revisions", [
            "Timestamp,User,Comment,Source", '2024-01-20T10:00:00Z,ann,"a, b\nsecond line",api', "2024-02-01T10:00:00Z,bob,,api"]),
    }
    t = build(spark, raw, str(tmp_path / "out"), trees=2)
    assert t["merged_weather"].count() == 80 and t["climate_insights_long"].count() == 12
    rows = {r["id"]: r for r in t["silver"].collect()}
    # one day of each place lacks humidity; the implausible monthly row does not win its day
    assert len(rows) == 80 - 2 + 1
    assert rows["Cairo_2024-01-19"]["user"] == "unknown" and rows["Luxor_2024-01-20"]["comment"] == "a, b\nsecond line"
    assert t["rejected_calendar"].count() == t["rejected_revisions"].count() == 0
    assert rows["Cairo_2024-03-01"]["user"] == "bob" and rows["Cairo_2024-03-01"]["comment"] == "unknown"
    assert rows["Luxor_2024-01-02"]["condition"] == "unknown" and rows["Luxor_2024-01-02"]["high_temp_c"] is not None
    assert t["fact_weather"].count() == 79 and t["fact_weather"].where("date_id is null").count() == 0
    assert "user" not in t["ml_ready"].columns
    forecast = t["forecast"]
    assert forecast.count() == 360 and forecast.where("predicted_max_temp is null or predicted_condition is null").count() == 0
    assert str(forecast.agg({"date": "min"}).first()[0]) == "2024-03-02"


def test_aliases_and_rejected_lines(spark, tmp_path):
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(12)]
    raw = {
        "calendar": write(tmp_path, "calendar", [
            "Governorate,Condition,High Temp (C),Low Temp (C),Date",
            *[f"Asyut,Sunny,{20 + i},{10 + i},{d}" for i, d in enumerate(days)], "Asyut,Fog,warm,9,2024-02-01"]),
        "archive": write(tmp_path, "archive", [
            "Governorate,Date,Weather_Code,Max_Temp,Min_Temp,Avg_Humidity,Source",
            *[f"Assiut,{d},1,{22 + i},{12 + i},50,s" for i, d in enumerate(days)], "Assiut,soon,1,2,3,50,s"]),
    }
    t = build(spark, raw, str(tmp_path / "out"), trees=1, aliases={"Asyut": "Assiut"}, source_order=["s"], by_place_month=True)
    assert t["rejected_calendar"].first()[0].startswith("Asyut,Fog,warm") and t["rejected_archive"].count() == 1
    silver_rows = t["silver"].collect()
    assert len(silver_rows) == 12 and {r["governorate"] for r in silver_rows} == {"Assiut"}
    assert all(r["high_temp_c"] is not None and r["avg_humidity"] == 50 and r["condition"] == "Sunny" for r in silver_rows)
    assert t["forecast"].count() == 180


def test_raw_payloads_to_fact(spark, tmp_path):
    """Calendar page, archive answer, revision answer and a table page enter through their adapters."""
    cells = "".join(f'<li class="calendar-day"><i>{d}</i><div class="phrase">Sunny</div><span class="hi">86</span><span class="low">50</span></li>'
                    for d in (31, *range(1, 29), 1))
    pages = spark.createDataFrame([("p", "Cairo", 2023, 2, f"<ul>{cells}</ul>")], "page_id string, governorate string, year int, month int, html string")
    lines = "".join(f"2023-02-{d:02d},3,{25 + d % 3},{12 + d % 4},40\n" for d in range(1, 29))
    payload = "a,b\n30,31\n\ntime,code,max,min,hum\n" + lines
    archive = extract.parse_archive_payload(spark.createDataFrame([("Cairo", 2023, 2, payload)], "governorate string, year int, month int, payload string"))
    log = extract.parse_revision_json(spark.createDataFrame(
        [('{"query":{"pages":{"1":{"revisions":[{"timestamp":"2023-02-10T08:00:00Z","user":"ann","comment":"new"}]}}}}',)], "payload string"))
    table = '<table class="wikitable"><tr><th>Month</th></tr><tr><th>High</th>' + "".join(f"<td>{m}.5(9)</td>" for m in range(1, 13)) + "<td>7</td></tr></table>"
    normals = adapters.normals_staging(extract.parse_html_table(spark.createDataFrame([(1, table)], "page_id int, html string")))
    assert values(normals.select("metric_name", "jan", "dec", "year_value")) == [("High", "1.5(9)", "12.5(9)", "7")]
    merged = merge_sources(adapters.calendar_staging(extract.calendar_observations(staged(pages, "pages"))), adapters.archive_staging(archive))
    done = staged(silver(bronze(staged(merged, "merged")), adapters.revision_staging(log)), "silver")
    facts = gold(done, str(tmp_path / "gold"))["fact_weather"]
    assert facts.count() == 28 and facts.where("date_id is null or location_id is null").count() == 0
    assert {(r["high_temp_c"], r["condition"]) for r in done.select(F.col("high_temp_c").cast("double"), "condition").collect()} == {(30.0, "Sunny")}
    assert done.where("user = 'ann'").count() == 19 and done.where("user = 'unknown'").count() == 9
