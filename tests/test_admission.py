"""Admission, dedupe, replay, archive selection, retention, spine."""

from pyspark.sql import functions as F

from lakekpi.operators import admission as A

LST = "object_key string, etag string, event_time timestamp, n_records long"


def _lst(spark, rows):
    return spark.createDataFrame(rows, LST)


def _t(s):
    import datetime as dt

    return dt.datetime.fromisoformat(s)


def test_admit_rules(spark):
    keys = ["streams/landing_date=2024-06-01/a.csv", "readme.txt", "streams/manifests/landing_date=2024-06-01/a.csv",
            "other/test.csv", "streams/landing_date=2024-06-01/a.csv.tmp", ""]
    df = _lst(spark, [(k, "e", _t("2024-06-01 00:00:00"), 1) for k in keys])
    assert [r.object_key for r in A.admit(df).collect()] == [keys[0]]


def test_decode_and_dates(spark):
    df = _lst(spark, [("streams/landing_date%3D2024-06-01/my+file.csv", "e", None, 1), ("x/y.csv", "e", None, 1)])
    out = A.with_dates(A.decode_keys(df)).collect()
    assert out[0].object_key == "streams/landing_date=2024-06-01/my file.csv"
    assert (out[0].landing_date, out[0].run_date) == ("2024-06-01", "2024-06-01")
    assert (out[1].landing_date, out[1].run_date) == ("", "unknown")


def test_run_inputs_etag_and_fallback(spark):
    df = _lst(spark, [("streams/landing_date=2024-06-01/a.csv", '"abc"', _t("2024-06-01 00:00:00"), 1),
                      ("streams/landing_date=2024-06-01/b.csv", "", _t("2024-06-01 00:00:00"), 1)])
    out = {r.key: r for r in A.run_inputs(df, "bronze").collect()}
    assert out["streams/landing_date=2024-06-01/a.csv"].execution_id == "abc"
    assert out["streams/landing_date=2024-06-01/b.csv"].execution_id.startswith("req-")
    assert A.run_inputs(df, "").count() == 0


def test_content_dedupe_with_ledger(spark):
    df = _lst(spark, [("k1", "h1", _t("2024-06-02 00:00:00"), 1), ("k2", "h1", _t("2024-06-01 00:00:00"), 1),
                      ("k3", "h2", _t("2024-06-01 00:00:00"), 1), ("k4", "h3", _t("2024-06-01 00:00:00"), 1)])
    ledger = spark.createDataFrame([("h2", _t("2024-05-30 00:00:00")), ("h3", _t("2024-01-01 00:00:00"))],
                                   "execution_id string, started_at timestamp")
    out = sorted(r.object_key for r in A.new_runs(df, ledger, F.lit("2024-06-03 00:00:00").cast("timestamp")).collect())
    assert out == ["k2", "k4"]  # k2: first copy of h1; h2 ran 4 days ago; h3 ran > 90 days ago


def test_failure_classification(spark):
    rows = [("k1", 1, _t("2024-06-01 00:00:00"), _t("2024-06-01 00:30:00")),
            ("k2", 3, _t("2024-06-01 00:00:00"), _t("2024-06-01 00:30:00")),
            ("k3", 1, _t("2024-05-01 00:00:00"), _t("2024-05-01 02:00:00"))]
    df = spark.createDataFrame(rows, "object_key string, attempts int, event_time timestamp, failed_at timestamp")
    out = {r.object_key: r.disposition for r in A.classify_failures(df, F.lit("2024-06-02 00:00:00").cast("timestamp")).collect()}
    assert out == {"k1": "retry", "k2": "dead_letter", "k3": "expired"}


def test_archive_candidates_given_keys(spark):
    df = _lst(spark, [("streams/landing_date=2024-06-01/a.csv", "e", None, 1), ("streams/landing_date=2024-06-01/b.csv", "e", None, 1),
                      ("streams/landing_date=2024-06-01/x.txt", "e", None, 1)])
    keys = spark.createDataFrame([("streams/landing_date=2024-06-01/b.csv",), ("streams/landing_date=2024-06-01/x.txt",)], "object_key string")
    assert [r.object_key for r in A.archive_candidates(df, keys).collect()] == ["streams/landing_date=2024-06-01/b.csv"]
    assert A.archive_candidates(df).count() == 2


def test_retention(spark):
    df = _lst(spark, [("streams/a.csv", "e", _t("2023-01-01 00:00:00"), 1), ("streams/b.csv", "e", _t("2024-05-01 00:00:00"), 1),
                      ("quarantine/c.csv", "e", _t("2024-01-01 00:00:00"), 1)])
    out = sorted(r.object_key for r in A.retention_prune(df, A.retention_policy(spark), F.lit("2024-06-01 00:00:00").cast("timestamp")).collect())
    assert out == ["quarantine/c.csv", "streams/a.csv"]


def test_missing_days(spark):
    present = spark.createDataFrame([("2024-01-01",), ("2024-01-03",)], "day string")
    out = [str(r.day) for r in A.missing_days(present, "2024-01-01", "2024-01-04").orderBy("day").collect()]
    assert out == ["2024-01-02", "2024-01-04"]
