import datetime
import gzip
import json

import pytest
from pyspark.sql import functions as F

from trailmark.functions.text import decode_title, encode_title, fixed, grouped, percent
from trailmark.operators.cleaning import clean_clicks
from trailmark.schema import ANOMALIES, as_anomalies, existing, with_defaults
from trailmark.sources.anomalies import read_anomalies, write_anomalies, write_flat
from trailmark.sources.clicks import clean_or_load, read_clean, read_month, read_months, write_clean
from trailmark.sources.pageviews import flatten_responses, read_daily_views
from trailmark.sources.truth import ground_truth_pages


def one(df, column):
    return spark_value(df.select(column.alias("v")))


def spark_value(df):
    return df.first()[0]


def test_cleaning_rules(clicks_of):
    rows = [
        (None, "B", "link", "2024-01", 20),
        ("A", None, "link", "2024-01", 20),
        ("A", "B", "link", "2024-01", None),
        ("A", "B", "link", "2024-01", 0),
        ("A", "B", "link", "2024-01", -1),
        ("A", "B", "link", "2024-01", 9),
        (" A ", "B ", " link", "2024-01", 10),
        ("null", "other-search", "other", "2024-01", 11),
    ]
    got = {r["prev"]: r for r in clean_clicks(clicks_of(rows)).collect()}
    assert set(got) == {"A", "null"}
    assert (got["A"]["curr"], got["A"]["type"], got["A"]["curr_normalized"]) == ("B", "link", "b")
    assert got["null"]["prev_category"] == "direct"
    assert got["null"]["curr_category"] == "other-search"
    assert got["A"]["prev_category"] == "page"


def test_type_may_stay_untrimmed(clicks_of):
    rows = clean_clicks(clicks_of([("A", "B", " link", "2024-01", 10)]), trim_type=False)
    assert rows.first()["type"] == " link"


def write_tsv(path, rows, zipped=False):
    text = "prev\tcurr\ttype\tn\n" + "".join("\t".join(r) + "\n" for r in rows)
    data = gzip.compress(text.encode()) if zipped else text.encode()
    path.write_bytes(data)
    return str(path)


def test_reading_months(spark, tmp_path):
    jan = write_tsv(tmp_path / "clickstream-2024-01.tsv", [("A", '"B"', "link", "12"), ("A", "C", "link", "x")])
    feb = write_tsv(tmp_path / "clickstream-2024-02.tsv.gz", [("A", "B", "link", "30")], zipped=True)
    odd = write_tsv(tmp_path / "march.tsv", [("D", "B", "link", "40")])
    missing = str(tmp_path / "clickstream-2024-05.tsv")
    df = read_months(spark, [(jan, "2024-01"), (feb, "2024-02"), (odd, "2024-03"), (missing, "2024-05")])
    got = sorted((r["month"], r["prev"], r["curr"], r["n"] or 0) for r in df.collect())
    assert got == [
        ("2024-01", "A", '"B"', 12),
        ("2024-01", "A", "C", 0),
        ("2024-02", "A", "B", 30),
        ("2024-03", "D", "B", 40),
    ]
    assert read_month(spark, jan, "1999-01").first()["month"] == "1999-01"
    with pytest.raises(ValueError):
        read_months(spark, [(missing, "2024-05")])


def test_clean_table_round_trip(spark, tmp_path, clicks_of):
    source = write_tsv(tmp_path / "clickstream-2024-01.tsv", [("A", "B", "link", "12"), ("A", "C", "link", "3")])
    path = str(tmp_path / "clean")
    assert clean_or_load(spark, path, [(source, "2024-01")]).count() == 1
    # the second call reads what is stored and needs no source
    assert clean_or_load(spark, path, []).count() == 1
    more = clean_clicks(clicks_of([("X", "Y", "link", "2024-02", 50)]))
    write_clean(more, path, replace_months_only=True)
    assert sorted(r["month"] for r in read_clean(spark, path).collect()) == ["2024-01", "2024-02"]
    with pytest.raises(ValueError):
        write_clean(more, path, fmt="xml")


def test_anomaly_table(spark, tmp_path):
    rows = spark.createDataFrame(
        [("1", "2024-01", "mix_shift", 5), ("2", "2024-02", "traffic_spike", 6)],
        "anomaly_id string, month string, anomaly_type string, n bigint",
    )
    table = as_anomalies(rows)
    assert table.schema.fieldNames() == ANOMALIES.fieldNames()
    assert [f.dataType for f in table.schema] == [f.dataType for f in ANOMALIES]
    path = str(tmp_path / "anomalies")
    write_anomalies(table, path)
    write_anomalies(table.limit(0), path)
    assert read_anomalies(spark, path).count() == 2
    one_month = read_anomalies(spark, path, {"month": "2024-02"})
    assert [r["anomaly_id"] for r in one_month.collect()] == ["2"]
    assert one_month.first()["forecast_ratio"] == 1.0
    assert "PartitionFilters: [isnotnull(month" in one_month._jdf.queryExecution().executedPlan().toString()
    for _ in range(2):  # a repeated run leaves one copy, and a type that is gone goes
        write_anomalies(table.filter("month = '2024-01'").replace("mix_shift", "traffic_spike", "anomaly_type"), path, mode="replace")
        assert sorted((r["month"], r["anomaly_type"]) for r in read_anomalies(spark, path).collect()) == [("2024-01", "traffic_spike"), ("2024-02", "traffic_spike")]
    with pytest.raises(ValueError):
        read_anomalies(spark, path, fmt="xml")
    write_flat(table, str(tmp_path / "flat"))
    with pytest.raises(Exception, match="(?i)exists"):
        write_flat(table, str(tmp_path / "flat"))


def test_daily_view_files(spark, tmp_path):
    def save(name, days):
        (tmp_path / name).write_text(json.dumps([{"date": d, "views": v} for d, v in days]))

    save("World_War_II_20240101_20240102.json", [("20240101", 5), ("20240102", 6)])
    save("World_War_II_20240102_20240103.json", [("20240102", 6), ("20240103", 7)])
    save("Art_20240101_20240101.json", [("20240101", 1), ("bad", 3)])
    got = sorted(map(tuple, read_daily_views(spark, str(tmp_path)).collect()))
    day = lambda d: datetime.date(2024, 1, d)
    assert got == [
        ("Art", day(1), 1),
        ("World_War_II", day(1), 5),
        ("World_War_II", day(2), 6),
        ("World_War_II", day(3), 7),
    ]


def test_responses(spark):
    body = '{"items": [{"timestamp": "2024010200", "views": 3}, {"timestamp": "2024010300"}]}'
    rows = spark.createDataFrame([("A", body), ("B", '{"items": []}'), ("C", "{}")], "page string, body string")
    got = sorted((r["page"], str(r["date"]), r["views"]) for r in flatten_responses(rows).collect())
    assert got == [("A", "2024-01-02", 3), ("A", "2024-01-03", 0)]


def test_ground_truth(spark, tmp_path):
    path = str(tmp_path / "truth")
    spark.createDataFrame([("A",), ("A",), ("B",)], "page string").write.parquet(path)
    assert ground_truth_pages(spark, path).count() == 2


@pytest.mark.parametrize(
    "title, encoded",
    [("A B", "A_B"), ("C++", "C%2B%2B"), ("~*é/", "~%2A%C3%A9%2F"), ("100%", "100%25"), ("a.b-c_d", "a.b-c_d")],
)
def test_title_codec(spark, title, encoded):
    row = spark.createDataFrame([(title,)], "t string").select(
        encode_title(F.col("t")).alias("e"), decode_title(encode_title(F.col("t"))).alias("d")
    ).first()
    assert row["e"] == encoded
    assert row["d"] == title.replace("_", " ")


@pytest.mark.parametrize("x", [12.35, 0.125, 2.5, 3.5, 1234.567, -0.006, 99.95, 1e-9, 0.0])
def test_number_formats_follow_python(spark, x):
    row = spark.range(1).select(
        fixed(F.lit(x), 1).alias("f1"), fixed(F.lit(x), 2).alias("f2"), fixed(F.lit(x), 0).alias("f0"),
        percent(F.lit(x)).alias("p"), grouped(F.lit(1234567)).alias("g"),
    ).first()
    assert (row["f1"], row["f2"], row["f0"]) == (f"{x:.1f}", f"{x:.2f}", f"{x:.0f}")
    assert row["p"] == f"{x:.1%}"
    assert row["g"] == "1,234,567"


def test_projection_helpers(spark):
    df = spark.createDataFrame([(1, None)], "a int, b double")
    assert existing(df, ["b", "missing", "a", "b"]).columns == ["b", "a"]
    assert with_defaults(df, {"b": 2.0, "c": False}).first().asDict() == {"a": 1, "b": 2.0, "c": False}
