"""Batch-file validation (B1-B13), including header-by-name reading of real CSV files."""

import json
import os

from pyspark.sql import functions as F

from lakekpi import constants as K
from lakekpi.operators import numbering as NUM
from lakekpi.operators import validate as B
from lakekpi.sources.csv_scan import read_batches


def _write(root, key, text):
    p = os.path.join(root, key)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "w") as fh:
        fh.write(text)


def _files(spark, rows):
    return spark.createDataFrame(rows, "source_key string, landing_date string, fields array<string>")


REQ = ["user_id", "track_id", "listen_time"]


def test_missing_and_blank_fields_with_row_numbers(spark):
    recs = spark.createDataFrame(
        [("k", 2, "1", "T1", "2024-06-01 10:00:00"), ("k", 3, "1", "", "2024-06-01 10:00:00"),
         ("k", 4, " \t", "T1", None)],
        "source_key string, row_no int, user_id string, track_id string, listen_time string")
    errs = sorted((r.row_no, r.error) for r in B.record_errors(recs).collect())
    assert errs == [(3, "Row 3: missing required field 'track_id'"), (4, "Row 4: missing required field 'listen_time'"),
                    (4, "Row 4: missing required field 'user_id'")]


def test_verdict_empty_file_invalid(spark):
    files = _files(spark, [("a", "2024-06-01", REQ), ("b", "2024-06-01", REQ)])
    recs = spark.createDataFrame([("a", 2, "1", "T1", "2024-06-01 10:00:00")],
                                 "source_key string, row_no int, user_id string, track_id string, listen_time string")
    v = {r.source_key: r for r in B.validate(files, recs).collect()}
    assert v["a"].valid and v["a"].error_count == 0 and v["a"].errors is None
    assert not v["b"].valid and v["b"].error_count == 1 and v["b"].errors == [K.EMPTY_FILE_ERROR]
    assert v["b"].schema_drift == {"missing_required_fields": REQ}
    assert v["a"].manifest_key == "streams/manifests/a.json"


def test_drift_unknown_and_missing(spark):
    files = _files(spark, [("a", "d", ["user_id", "track_id", "listen_time", "unexpected"]), ("b", "d", ["user_id", "track_id"])])
    recs = spark.createDataFrame([("a", 2, "1", "T", "x"), ("b", 2, "1", "T", None)],
                                 "source_key string, row_no int, user_id string, track_id string, listen_time string")
    v = {r.source_key: r for r in B.validate(files, recs).collect()}
    assert v["a"].schema_drift == {"unknown_fields": ["unexpected"]} and v["a"].valid  # drift alone is not invalid
    assert v["b"].schema_drift == {"missing_required_fields": ["listen_time"]}


def test_run_date_min_parseable_else_landing(spark):
    files = _files(spark, [("a", "2024-06-09", REQ), ("b", "2024-06-09", REQ)])
    recs = spark.createDataFrame(
        [("a", 2, "1", "T", "2024-06-03 10:00:00"), ("a", 3, "1", "T", "2024-06-02 23:00:00"), ("a", 4, "1", "T", "bad"),
         ("b", 2, "1", "T", "bad")],
        "source_key string, row_no int, user_id string, track_id string, listen_time string")
    rd = {r.source_key: r.run_date for r in B.derive_run_date(files, recs).collect()}
    assert rd == {"a": "2024-06-02", "b": "2024-06-09"}


def test_manifest_key_rule(spark):
    df = spark.createDataFrame([("streams/landing_date=2024-06-01/a.csv",), ("other/x.csv",)], "k string")
    from lakekpi.functions.text import manifest_key

    out = [r[0] for r in df.select(manifest_key("k")).collect()]
    assert out == ["streams/manifests/landing_date=2024-06-01/a.csv.json", "streams/manifests/other/x.csv.json"]


def test_first_errors_capped_in_file_order(spark):
    recs = spark.createDataFrame([("k", i, None, "T", "t") for i in range(2, 40)],
                                 "source_key string, row_no int, user_id string, track_id string, listen_time string")
    v = B.validate(_files(spark, [("k", "d", REQ)]), recs).collect()[0]
    assert v.error_count == 38 and len(v.errors) == 20 and v.errors[0].startswith("Row 2:") and v.errors[-1].startswith("Row 21:")
    doc = json.loads(B.manifest_json(B.validate(_files(spark, [("k", "d", REQ)]), recs)).collect()[0].json)
    assert doc["error_count"] == 38 and len(doc["errors"]) == 20 and doc["valid"] is False


def test_tags_report_and_quarantine(spark):
    files = _files(spark, [("streams/landing_date=2024-06-01/a.csv", "", REQ)]).withColumn(
        "execution_id", F.lit("x" * 300)).withColumn("event_time", F.lit("2024-06-01T10:00:00Z"))
    v = B.validate(files, spark.createDataFrame([], "source_key string, row_no int, user_id string, track_id string, listen_time string"))
    t = B.status_tags(v).collect()[0]
    assert t.validated == "false" and len(t.pipeline_run_id) == 256 and t.landing_date == "unknown"
    r = B.dq_report(v, F.lit("2024-06-01 00:00:00").cast("timestamp")).collect()[0]
    assert r.event_date == "2024-06-01" and r.expires_at - 1717200000 == 30 * 86400
    q = B.quarantine_ledger(v).collect()[0]
    assert q.quarantine_key == "bronze/streams/landing_date=2024-06-01/a.csv" and q.quarantined


def test_number_within_is_dense_per_group(spark):
    df = spark.range(0, 5000).selectExpr("id % 3 as g", "id as o")
    out = NUM.number_within(df, ["g"], ["o"], out="rn", start=2, num_partitions=7)
    got = {(r.g, r.o): r.rn for r in out.collect()}
    for g in range(3):
        ids = sorted(o for (gg, o) in got if gg == g)
        assert [got[(g, o)] for o in ids] == list(range(2, 2 + len(ids)))


def test_read_batches_by_header_name(spark, tmp):
    _write(tmp, "streams/landing_date=2024-06-01/a.csv", "user_id,track_id,listen_time\n1,T1,2024-06-01 10:00:00\n2,,2024-06-01 11:00:00\n")
    _write(tmp, "streams/landing_date=2024-06-01/b.csv", "listen_time,track_id,user_id,extra\n2024-06-01 12:00:00,T9,7,x\n")
    _write(tmp, "streams/landing_date=2024-06-02/c.csv", "user_id,track_id\n3,T3\n")
    _write(tmp, "streams/landing_date=2024-06-02/d.csv", "user_id,track_id,listen_time\n")
    _write(tmp, "streams/landing_date=2024-06-02/e.csv", 'user_id,track_id,listen_time\n4,"T,4","2024-06-02\n10:00:00"\n5,T5,2024-06-02 11:00:00\n')
    files, recs = read_batches(spark, tmp)
    v = {r.source_key.split("/")[-1]: r for r in B.validate(files, recs).collect()}
    assert v["a.csv"].error_count == 1 and v["a.csv"].errors == ["Row 3: missing required field 'track_id'"]
    assert v["b.csv"].valid and v["b.csv"].schema_drift == {"unknown_fields": ["extra"]}
    assert v["c.csv"].schema_drift == {"missing_required_fields": ["listen_time"]} and v["c.csv"].error_count == 1
    assert v["d.csv"].record_count == 0 and not v["d.csv"].valid
    assert v["e.csv"].record_count == 2 and v["e.csv"].valid  # quoted newline kept inside one record
    b = recs.filter(F.col("source_key").endswith("b.csv")).collect()[0]
    assert (b.user_id, b.track_id, b.listen_time, b.row_no) == ("7", "T9", "2024-06-01 12:00:00", 2)
    assert v["a.csv"].landing_date == "2024-06-01"


def test_route_valid_and_invalid(spark):
    files = _files(spark, [("a", "d", REQ), ("b", "d", REQ)])
    recs = spark.createDataFrame([("a", 2, "1", "T", "t"), ("b", 2, None, "T", "t")],
                                 "source_key string, row_no int, user_id string, track_id string, listen_time string")
    good, bad = B.route(B.validate(files, recs), recs)
    assert [r.source_key for r in good.collect()] == ["a"] and [r.source_key for r in bad.collect()] == ["b"]


def test_unreadable_and_missing_coordinates(spark, tmp):
    from lakekpi.sources.probe import list_files, unreadable_text

    _write(tmp, "streams/landing_date=2024-06-01/ok.csv", "user_id,track_id,listen_time\n1,T1,2024-06-01 10:00:00\n")
    with open(os.path.join(tmp, "streams/landing_date=2024-06-01/bin.csv"), "wb") as fh:
        fh.write(b"\xff\xfe\x00garbage\xc3")
    bad = unreadable_text(list_files(spark, tmp, "*.csv"))
    v = B.unreadable_verdicts(bad, tmp).collect()
    assert [r.source_key for r in v] == ["streams/landing_date=2024-06-01/bin.csv"]
    assert v[0].error.startswith("Failed to read object") and v[0].valid is False
    inputs = spark.createDataFrame([("b", "k", "e1"), ("", "k2", "e2"), ("b", None, "e3")], "bucket string, key string, execution_id string")
    r = B.rejected_inputs(inputs).collect()
    assert sorted(x.execution_id for x in r) == ["e2", "e3"] and r[0].error == "Missing bucket or key"
