import json

from pyspark.sql import functions as F

from skyledger.schema import FLIGHT_SOURCE_SCHEMA, SOURCE_FIELDS
from skyledger.sources.csv_scan import first_by_event_time, read_ontime_csv, to_flights
from skyledger.sources.json_events import decode_flights, encode_source
from tests.helpers import flights

NAMES = list(SOURCE_FIELDS)


def _line(**cells):
    full = {"YEAR": "2025", "MONTH": "1", "DAY_OF_MONTH": "2", "OP_UNIQUE_CARRIER": "AA", "CRS_DEP_TIME": "1830.0",
            "ORIGIN_AIRPORT_ID": "1", "DEST_AIRPORT_ID": "2", **cells}
    return ",".join(full.get(n, "") for n in NAMES)


def _write(path, name, lines, header=None):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join([header or ",".join(NAMES), *lines]) + "\n")


def test_csv_scan(spark, tmp_path):
    d = tmp_path / "csv"
    _write(d, "202501_T_ONTIME_REPORTING.csv", [
        _line(OP_CARRIER_FL_NUM="1", DEP_DELAY="-3.5"),
        _line(OP_CARRIER_FL_NUM="2", CRS_DEP_TIME="", ORIGIN_AIRPORT_ID=""),
        _line(OP_CARRIER_FL_NUM="3", DEP_DELAY="x"),
        _line(OP_CARRIER_FL_NUM="4", MONTH="Jan"),
        "2025,1,2",
        _line(OP_CARRIER_FL_NUM="5") + ",extra",
        _line(OP_CARRIER_FL_NUM="6", OP_UNIQUE_CARRIER=" DL ", DEP_DELAY="1e1"),
    ])
    _write(d, "._202501_T_ONTIME_REPORTING.csv", [_line(OP_CARRIER_FL_NUM="7")])
    _write(d, "notes.csv", [_line(OP_CARRIER_FL_NUM="8")])
    df = read_ontime_csv(spark, str(d))
    assert df.schema.simpleString() == FLIGHT_SOURCE_SCHEMA.simpleString()
    rows = {r.OP_CARRIER_FL_NUM: r for r in df.collect()}
    assert set(rows) == {"1", "2", "6"}
    assert (rows["1"].CRS_DEP_TIME, rows["1"].DEP_DELAY, rows["1"].ARR_TIME) == (1830, -3.5, None)
    assert (rows["2"].CRS_DEP_TIME, rows["2"].ORIGIN_AIRPORT_ID) == (0, None)
    assert (rows["6"].OP_UNIQUE_CARRIER, rows["6"].DEP_DELAY, rows["6"].ORIGIN_STATE_ABR) == ("DL", 10.0, None)


def test_csv_columns_by_name(spark, tmp_path):
    _write(tmp_path / "a", "x_T_ONTIME_REPORTING.csv", [_line()])
    _write(tmp_path / "b", "y_T_ONTIME_REPORTING.csv", ["B6,2,1,2025,700"],
           " month_x,DAY_OF_MONTH, month ,Year,crs_dep_time".replace(" month_x", "op_unique_carrier"))
    rows = to_flights(read_ontime_csv(spark, [str(tmp_path / "a"), str(tmp_path / "b")]), F.lit(5)).collect()
    got = {r.airline: (r.year, r.month, r.day_of_month, r.crs_dep_time, r.origin_airport_id, r.ingest_ms) for r in rows}
    assert got == {"AA": (2025, 1, 2, 1830, 1, 5), "B6": (2025, 1, 2, 700, None, 5)}


def test_each_csv_file_has_its_own_header(spark, tmp_path):
    _write(tmp_path / "c", "1_T_ONTIME_REPORTING.csv", [_line(OP_CARRIER_FL_NUM="1"), _line(OP_CARRIER_FL_NUM="2")])
    turned = ",".join(reversed(NAMES))
    _write(tmp_path / "c", "2_T_ONTIME_REPORTING.csv", [
        ",".join(reversed(_line(OP_CARRIER_FL_NUM="3", YEAR="2024").split(",")))], turned)
    _write(tmp_path / "c", "3_T_ONTIME_REPORTING.csv", ["2023,3"], '"YEAR",MONTH')
    rows = read_ontime_csv(spark, str(tmp_path / "c")).collect()
    assert sorted((r.OP_CARRIER_FL_NUM or "", r.YEAR) for r in rows) == [("", 2023), ("1", 2025), ("2", 2025), ("3", 2024)]


def test_csv_numbers_with_text_behind_them(spark, tmp_path):
    _write(tmp_path / "n", "1_T_ONTIME_REPORTING.csv", [
        _line(YEAR="20x4", DEP_DELAY="1.5min"), _line(YEAR="x20"), _line(DEP_DELAY="-")])
    rows = read_ontime_csv(spark, str(tmp_path / "n")).collect()
    assert [(r.YEAR, r.DEP_DELAY) for r in rows] == [(20, 1.5)]


def test_decode_json(spark):
    good = {"YEAR": 2025, "MONTH": 1, "DAY_OF_MONTH": 2, "OP_UNIQUE_CARRIER": "AA", "CRS_DEP_TIME": 1830.0,
            "ORIGIN_AIRPORT_ID": "7", "DEST_AIRPORT_ID": 8, "OTHER": {"x": [1]}}
    payloads = [
        json.dumps(good), None, "", "null", "[1]", "{", json.dumps(good)[:-9], json.dumps({**good, "MONTH": "Jan"}),
        json.dumps({**good, "CANCELLED": True}), "{}", json.dumps({**good, "DEP_DELAY": None, "DIVERTED": 1}),
    ]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "id int, value string")
    rows = {r.id: r for r in decode_flights(df, "value", F.lit(9), "id").collect()}
    assert set(rows) == {0, 9, 10}
    assert (rows[0].crs_dep_time, rows[0].origin_airport_id, rows[0].dep_delay, rows[0].ingest_ms) == (1830, 7, None, 9)
    # An empty object decodes; the cleaning rules reject and count it.
    assert rows[9].year is None
    assert rows[10].diverted == 1.0


def test_source_round_trip(spark):
    row = tuple(None if f.name != "YEAR" else 2025 for f in FLIGHT_SOURCE_SCHEMA.fields)
    message = encode_source(spark.createDataFrame([row], FLIGHT_SOURCE_SCHEMA)).first().value
    assert json.loads(message) == {"YEAR": 2025}


def test_first_by_event_time(spark):
    rows = flights(
        spark, dict(crs_dep_time=900, dest_airport_id=1), dict(crs_dep_time=2400, dest_airport_id=2),
        dict(day_of_month=2, crs_dep_time=0, dest_airport_id=0), dict(year=0, dest_airport_id=4),
    )
    assert [r.dest_airport_id for r in first_by_event_time(rows, 0, "dest_airport_id").collect()] == [4, 1, 0, 2]
    assert [r.dest_airport_id for r in first_by_event_time(rows, 2, "dest_airport_id").collect()] == [4, 1]
