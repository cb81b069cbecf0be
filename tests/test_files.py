import gzip
import json
import os
from datetime import datetime
from pathlib import Path

import pytest
from cases import case, frame
from pyspark.sql import functions as F

from flowgauge.plans.analysis import report_tables, run_analysis, write_report
from flowgauge.schema import CASE_COLUMNS, CATALOG_SCHEMA, TRANSFER_COLUMNS
from flowgauge.session import settle, settled, shared_folder
from flowgauge.sources import dimensions, readers, writers


def rows():
    return [
        case(f"e{n}", facility="AB"[n % 2], procedure="PQ"[n // 2 % 2], phases=(10, 20, 30 + n, 40 + n % 2 * 30))
        for n in range(40)
    ] + [case("x", status="canceled")]


def test_csv_round_trip(spark, tmp_path):
    df = frame(spark, rows())
    path = str(tmp_path / "cases")
    writers.write_cases_csv(df, path)
    back = readers.read_cases_csv(spark, path)
    assert tuple(back.columns) == CASE_COLUMNS
    assert back.exceptAll(df.select(*CASE_COLUMNS)).count() == 0
    header = next(Path(path).glob("*.csv")).read_text().splitlines()[0]
    assert header == ",".join(CASE_COLUMNS)


def test_json_round_trip(spark, tmp_path):
    df = frame(spark, rows())
    writers.write_cases_json(df, str(tmp_path / "cases"))
    back = readers.read_cases_json(spark, str(tmp_path / "cases"))
    assert back.exceptAll(df.select(*CASE_COLUMNS)).count() == 0


def test_json_is_written_compressed_in_files_of_a_bounded_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "ROWS_PER_FILE", 1)
    df = frame(spark, rows()).coalesce(1)
    writers.write_cases_json(df, str(tmp_path / "cases"))
    assert len(list((tmp_path / "cases").glob("*.json.gz"))) == df.count() > 1
    assert readers.read_cases_json(spark, str(tmp_path / "cases")).count() == df.count()


def test_intermediate_tables_are_packed_closely(spark):
    assert all(".zstd." in name for name in settle(spark.range(5), "test").inputFiles())


def test_mixed_iso_times_and_empty_text(spark, tmp_path):
    path = tmp_path / "cases.csv"
    line = "e,A,P,,2025-01-06T07:00:01+00:00,2025-01-06T07:10:01.250000+00:00,2025-01-06T07:20:01+00:00,"
    line += "2025-01-06T07:30:01+00:00,2025-01-06T08:00:01+00:00,,,completed,"
    path.write_text(",".join(CASE_COLUMNS) + "\n" + line + "\n")
    row = readers.read_cases_csv(spark, str(path)).first()
    assert row["checkin_time"] == datetime(2025, 1, 6, 7, 0, 1)
    assert row["preop_start_time"] == datetime(2025, 1, 6, 7, 10, 1, 250000)
    for name in ("scheduled_start_time", "anesthesia_type", "asa_class", "source_generator_id"):
        assert row[name] is None


def test_raw_csv_fills_absent_columns(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("asa_class,event_id,facility_id\n3,e,\n")
    df = readers.read_raw_csv(spark, str(path))
    assert tuple(df.columns) == TRANSFER_COLUMNS
    row = df.first()
    assert (row["event_id"], row["asa_class"], row["facility_id"], row["created_at"]) == ("e", 3, None, None)


def test_database_address():
    options = readers.jdbc_options("postgresql://me:p%40ss@db.example:6543/central")
    assert options == {
        "url": "jdbc:postgresql://db.example:6543/central",
        "driver": "org.postgresql.Driver",
        "user": "me",
        "password": "p@ss",
    }
    assert readers.jdbc_options("postgresql://db/x")["url"] == "jdbc:postgresql://db:5432/x"
    with pytest.raises(ValueError):
        readers.jdbc_options("/some/file.csv")


def test_partitioned_database_read_needs_bounds(spark):
    with pytest.raises(ValueError):
        readers.read_cases_table(spark, "postgresql://db/x", column="created_at")


def test_missing_table_reads_empty_but_other_errors_pass(spark, tmp_path):
    assert readers.read_or_empty(spark, str(tmp_path / "none"), CATALOG_SCHEMA).count() == 0


def test_catalog(spark, tmp_path):
    path = tmp_path / "catalog.csv"
    path.write_text(",".join(CATALOG_SCHEMA.names) + "\nP,GI,2.7,0.3,2.9,0.3,2.5,0.2,3.2,0.4\n")
    row = readers.read_catalog(spark, str(path)).first()
    assert (row["service_line"], row["postop_to_discharge_sigma"]) == ("GI", 0.4)


def test_shared_folder_follows_the_session(spark, tmp_path):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir", shared_folder(spark)).rstrip("/")
    settled = settle(spark.range(5).withColumn("text", F.lit("x")), "test")
    assert settled.count() == 5
    assert any(shared_folder(spark) in name for name in settled.inputFiles())


def test_fixed_dimensions(spark):
    weights = dimensions.anesthesia_weights(spark).groupBy("service_line").agg(F.sum("weight").alias("w"))
    assert all(abs(row["w"] - 1) < 0.01 for row in weights.collect())
    assert weights.count() == 10
    bands = dimensions.volume_bands(spark)
    assert bands.filter("volume_min > 0 AND volume_max >= volume_min").count() == 3
    assert dimensions.facilities(spark).select("facility_id").distinct().count() == 3
    assert dimensions.hour_weights(spark).count() == 24
    assert dimensions.asa_weights(spark).agg(F.round(F.sum("weight"), 6)).first()[0] == 1.0
    assert dimensions.service_line_bias(spark).filter("weight > 1").count() == 10


def test_analysis_writes_and_reads_back(spark, tmp_path):
    source, output = str(tmp_path / "in.csv"), str(tmp_path / "out")
    writers.write_cases_csv(frame(spark, rows()), source)
    frames = run_analysis(spark, source, output, with_models=False, timestamp="2025-02-01T00:00:00+00:00")
    assert frames["aggregates"].count() == 4

    document = json.loads(next(Path(output, "analytics_results.json").glob("*.json")).read_text())
    assert document["timestamp"] == "2025-02-01T00:00:00+00:00"
    assert document["gpu_available"] is False
    assert "discharge_predictor" not in document
    severities = [entry["severity"] for entry in document["insights"]]
    assert severities == sorted(severities, key=["high", "medium", "info"].index)
    assert [entry["title"] for entry in document["insights"]] == [r["title"] for r in frames["insights"].collect()]
    # an insight carries only the fields of its type
    assert "gap_pct" not in next(entry for entry in document["insights"] if entry["type"] == "facility_summary")

    groups = readers.read_aggregates(spark, f"{output}/aggregates.csv")
    assert groups.exceptAll(frames["aggregates"]).count() == 0
    write_report(spark, output)
    results = readers.read_results(spark, f"{output}/analytics_results.json")
    tables = report_tables(groups, results)
    assert set(tables) == {path.name for path in Path(output, "report").iterdir()}
    kpi = tables["kpi"].first()
    assert (kpi["completed"], kpi["facilities"], kpi["canceled"], kpi["all_cases"]) == (40, 2, 1, 41)
    status = {r["status"]: r["cases"] for r in tables["status"].collect()}
    assert status == {"Completed": 40, "Cancelled": 1, "Other": 0}
    assert tables["importance"].count() == 0
    assert tables["models"].first()["r2_score"] is None
    assert tables["top_procedures"].count() == 4


def test_doubled_quotes_and_commas(spark, tmp_path):
    header = "event_id,facility_id,case_status"
    (tmp_path / "a.csv").write_text(f'{header}\n1,"The ""A"", site",completed\n')
    row = readers.read_raw_csv(spark, str(tmp_path)).first()
    assert (row["event_id"], row["facility_id"], row["case_status"]) == ("1", 'The "A", site', "completed")


def test_files_of_a_folder_go_by_their_own_headers(spark, tmp_path):
    """Once an honest failure; now each file is read by the names it has."""
    (tmp_path / "a.csv").write_text("event_id,facility_id\n1,FA\n")
    (tmp_path / "deeper").mkdir()
    (tmp_path / "deeper" / "b.csv").write_text('\ufefffacility_id,event_id,"odd, name"\n"F ""B""",2,"x, y"\n')
    (tmp_path / "c.csv").write_text("unknown\n5\n")
    with gzip.open(tmp_path / "d.csv.gz", "wt") as file:
        file.write("asa_class,event_id\n4,4\n")
    rows = readers.read_raw_csv(spark, str(tmp_path)).collect()
    found = sorted((row["event_id"] or "", row["facility_id"] or "", row["asa_class"] or 0) for row in rows)
    assert found == [("", "", 0), ("1", "FA", 0), ("2", 'F "B"', 0), ("4", "", 4)]
    (tmp_path / "e.csv").write_text("event_id,event_id\n1,2\n")
    with pytest.raises(ValueError, match="named twice"):
        readers.read_raw_csv(spark, str(tmp_path))


def test_a_folder_without_rows_is_empty(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    assert readers.read_raw_csv(spark, str(tmp_path)).count() == 0
    assert tuple(readers.read_raw_csv(spark, str(tmp_path)).columns) == TRANSFER_COLUMNS


def test_a_database_is_not_read_in_one_task_unawares(spark):
    with pytest.raises(ValueError, match="single task"):
        readers.load_cases(spark, "postgresql://host/name")


def test_intermediate_tables_go_when_they_are_used(spark):
    with pytest.raises(RuntimeError), settled(spark.range(3), "short") as rows:
        place = rows.inputFiles()[0].removeprefix("file://")
        assert rows.count() == 3 and os.path.exists(place)
        raise RuntimeError
    assert not os.path.exists(os.path.dirname(place))
    assert f"/flowgauge/{spark.sparkContext.applicationId}/" in place
