import pytest
from pyspark.sql import functions as F

from tidemark.operators import registry as R
from tidemark.operators.requests import parse_requests, quarantine
from tidemark.session import clear_scratch, materialise
from tidemark.operators.features import apply_scaler, fit_scaler
from tidemark.plans.jobs import prepare_series
from tidemark.sources import metrics as M
from tidemark.sources import tables as S
from tidemark.sources.series import read_series_csv
from tidemark.sources.typed import ingest_rows, ingest_typed, labelled_schema


def test_overwrite_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        S.read_table(spark, path)
    assert S.overwrite_table(spark.range(3), path) == 1
    assert S.overwrite_table(S.read_table(spark, path).filter("id > 0"), path) == 2
    assert {r.id for r in S.read_table(spark, path).collect()} == {1, 2}
    with pytest.raises(S.SchemaMismatch):
        S.overwrite_table(spark.range(1).withColumn("x", F.lit(1)), path)
    assert S.latest_version(spark, path) == 2
    S.overwrite_table(spark.range(1).withColumn("x", F.lit(1)), path, replace_schema=True)
    assert S.read_table(spark, path).columns == ["id", "x"]


def test_unpublished_snapshot_is_invisible(spark, tmp_path):
    path = str(tmp_path / "t")
    S.overwrite_table(spark.range(3), path)
    spark.range(99).write.parquet(f"{path}/data/v=2")
    assert S.read_table(spark, path).count() == 3
    S.overwrite_table(spark.range(5), path)
    assert S.read_table(spark, path).count() == 5


def test_csv_series(spark, tmp_path):
    file = tmp_path / "s.csv"
    file.write_text("date,close,note\n2024-01-02,2.5,x\n2024-01-01,NaN,y\nsoon,1.0,z\n")
    with pytest.raises(Exception, match="not a date: soon"):
        read_series_csv(spark, str(file)).collect()
    rows = read_series_csv(spark, str(file), on_bad_date="null").orderBy("date").collect()
    assert [r.close for r in rows] == [1.0, None, 2.5]
    assert rows[0].date is None and rows[2].date.day == 2


def test_csv_dates_and_headers_as_files_have_them(spark, tmp_path):
    file = tmp_path / "s.csv"
    file.write_text("date,ISE,ISE.1,a b\n5-Jan-09,1.5,2.5,x\n6-Jan-09,,3.5,y\n,1,1,z\n")
    rows = read_series_csv(spark, str(file), date_formats="d-MMM-yy")
    prepared = prepare_series(rows, "ISE.1")
    assert prepared.columns == ["date", "ISE", "ISE.1", "target"]
    assert [(str(r["date"].date()), r["target"]) for r in prepared.collect()] == [("2009-01-05", 1)]
    scaled = {r["date"].day: r["ISE.1"] for r in apply_scaler(rows, fit_scaler(rows, ["ISE.1"]), ["ISE.1"]).where("date is not null").collect()}
    assert scaled[5] < scaled[6]


def test_requests_are_numbers_and_nothing_after(spark):
    bodies = ['{"k": "5.1d"}', '{"k": "7f"}', '{"k": 1} junk', '{"k": 1}, {"k": 2}', '{"k": {"j": 1}}', "5", None, '{"k": "1e3"}', ' {"k": -2.5} ', '{"k": true}', '{"k": "NaN"}']
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "id int, body string")
    got = {r.id: (r.k, r.status) for r in parse_requests(df, ["k"]).collect()}
    assert {i for i, (_, status) in got.items() if status == "ok"} == {7, 8}
    assert got[7][0] == 1000 and got[8][0] == -2.5
    strict = {r.id: r.status for r in parse_requests(df, ["k"], lenient=False).collect()}
    assert {i for i, status in strict.items() if status == "ok"} == {8}


def test_typed_ingest(spark):
    schema = labelled_schema(["a", "b"])
    rows = ingest_rows(spark, [(1, 2.5, 0, "x"), (None, 3, 1.0, 7)], schema).collect()
    assert [tuple(r) for r in rows] == [(1.0, 2.5, 0, "x"), (None, 3.0, 1, "7")]
    raw = spark.createDataFrame([("1.5", "bad", "2", "x", 1)], "a string, b string, target string, target_name string, extra int")
    assert tuple(ingest_typed(raw, schema).first()) == (1.5, None, 2, "x")


def test_gauges_replace_only_their_job(spark, tmp_path):
    path = str(tmp_path / "g")
    make = lambda rows: spark.createDataFrame(rows, "job string, metric string, value double")
    M.push_gauges(make([("a", "x", 1.0), ("a", "y", 2.0), ("b", "x", 3.0)]), path)
    M.push_gauges(make([("a", "x", 9.0)]), path)
    got = {(r.job, r.metric, r.value) for r in M.read_gauges(spark, path).collect()}
    assert got == {("a", "x", 9.0), ("b", "x", 3.0)}


def _events(spark, rows):
    return spark.createDataFrame(rows, "name string, version bigint, stage string, event_seq bigint")


def test_registry_stages(spark):
    first = [("m", 1, "None", 1), ("m", 1, "Staging", 2)]
    second = [("m", 2, "None", 3), ("m", 2, "Staging", 4), ("m", 2, "Archived", 5)]
    events = _events(spark, [*first, *second])
    assert R.latest_in_stage(events, "Staging").first().version == 1
    assert R.latest_in_stage(events, "Production").count() == 0
    assert R.model_ready(events, "m", "Staging").first().ready
    assert not R.model_ready(events, "m", "Production").first().ready
    assert not R.model_ready(events, "unknown", "Staging").first().ready


def test_registering_numbers_versions(spark):
    new = spark.createDataFrame([("m", 1), ("m", 2), ("n", 3)], "name string, event_seq bigint")
    existing = spark.createDataFrame([("m", 4)], "name string, version bigint")
    got = {(r.name, r.event_seq, r.version, r.stage) for r in R.register(new, existing).collect()}
    assert got == {("m", 1, 5, "None"), ("m", 2, 6, "None"), ("n", 3, 1, "None")}
    assert {r.version for r in R.register(new).collect()} == {1, 2}


def test_compare_runs_takes_the_last_value(spark, tmp_path):
    path = str(tmp_path / "m")
    rows = [("a", "accuracy", 1, 0.5), ("a", "accuracy", 2, 0.6), ("b", "final_net_worth", None, 9.0)]
    M.log_metrics(spark.createDataFrame(rows, "run_id string, key string, step bigint, value double"), path)
    got = R.compare_runs(M.read_metrics(spark, path), ["accuracy", "final_net_worth"]).orderBy("run_id").collect()
    assert [tuple(r) for r in got] == [("a", 0.6, None), ("b", None, 9.0)]


def test_request_validation(spark):
    bodies = {
        '{"a": 1, "b": 2.5}': "ok",
        '{"a": "5.1", "b": 2}': "ok",
        '{"a": 1, "b": 2, "c": 3}': "ok",
        '{"a": 1}': "invalid",
        '{"a": 1, "b": null}': "invalid",
        '{"a": 1, "b": "x"}': "invalid",
        '{"a": 1, "b": [2]}': "invalid",
        "[1, 2]": "invalid",
        "not json": "invalid",
        "": "invalid",
        None: "invalid",
    }
    df = spark.createDataFrame([(k,) for k in bodies], "body string")
    assert {r.body: r.status for r in parse_requests(df, ["a", "b"]).collect()} == bodies
    strict = {r.body: r.status for r in parse_requests(df, ["a", "b"], lenient=False).collect()}
    assert strict['{"a": "5.1", "b": 2}'] == "invalid" and strict['{"a": 1, "b": 2.5}'] == "ok"
    good, bad = quarantine(parse_requests(df, ["a", "b"]))
    assert (good.count(), bad.count()) == (3, 8)


def test_clearing_scratch_by_label(spark):
    kept, gone = materialise(spark.range(3), "kept"), materialise(spark.range(3), "gone")
    clear_scratch(spark, "gone")
    assert kept.count() == 3
    with pytest.raises(Exception):
        gone.count()
