"""Column expressions, scans and the feed on literal rows."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from emberlog import schemas
from emberlog.functions import hit_flag, numeric_columns, time_bucket, url_host
from emberlog.sources import (
    normalise_dns,
    read_auth,
    read_dns,
    read_flows,
    read_lines,
    read_proc,
    read_threat_feed,
    split_malformed,
)
from emberlog.plans.silver import build_silver_iocs
from emberlog.sources.feed import feed_status, recent_iocs


def _write(spark, path, lines, codec):
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(
        str(path), compression=codec
    )
    return str(path)


def test_url_host(spark):
    texts = ["http://a.b:80/x", "example.com", None, "HTTPS://Q/x", "http://h?x=1/2", "http://u@h/p"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, url string")
    hosts = [r[0] for r in df.orderBy("i").select(url_host(F.col("url"))).collect()]
    assert hosts == ["a.b:80", "", None, "", "h?x=1", "u@h"]


def test_time_bucket_truncates_toward_zero(spark):
    times = [-1, -3601, 3599, 3600, None, 2147483647]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "i int, time int")
    out = df.orderBy("i").select(time_bucket(F.col("time")).alias("b"))
    assert [r["b"] for r in out.collect()] == [0, -3600, 0, 3600, None, 2147482800]
    assert out.schema["b"].dataType.simpleString() == "bigint"
    minutes = df.orderBy("i").select(time_bucket(F.col("time"), 60).alias("b"))
    assert [r["b"] for r in minutes.collect()][:4] == [0, -3600, 3540, 3600]


def test_hit_flag_counts_empty_but_not_missing_threats(spark):
    df = spark.createDataFrame([(0, "x"), (1, ""), (2, None)], "i int, threat string")
    assert [r[0] for r in df.orderBy("i").select(hit_flag(F.col("threat"))).collect()] == [1, 1, 0]


def test_numeric_columns(spark):
    df = spark.createDataFrame([], "a int, `b.c` double, s string, l long, d date, flag boolean")
    assert numeric_columns(df).columns == ["a", "b.c", "l"]


@pytest.mark.parametrize(
    "reader, schema, codec, lines",
    [
        (read_auth, schemas.AUTH, "bzip2", ["1,U1,C1", "1,U1,C2", "2,U2,C3", "3,U3,C4", "6,U4,C5"]),
        (read_dns, schemas.DNS, "gzip", ["2,C4653,C5030", "2,C5782,C16712"]),
        (
            read_flows,
            schemas.FLOWS,
            "gzip",
            [
                "1,0,C1065,389,C3799,N10451,6,10,5323",
                "1,0,C1423,N1136,C1707,N1,6,5,847",
                "1,0,C1423,N1142,C1707,N1,6,5,847",
            ],
        ),
        (
            read_proc,
            schemas.PROC,
            "gzip",
            ["1,C1$@DOM1,C1,P16,Start", "1,C1001$@DOM1,C1001,P4,Start", "1,C1002$@DOM1,C1002,P4,End"],
        ),
    ],
)
def test_logs_have_their_declared_schema(spark, tmp_path, reader, schema, codec, lines):
    df = reader(spark, _write(spark, tmp_path / "log", lines, codec))
    assert df.schema == schema
    kinds = {"int": int, "string": str}
    want = [
        tuple(kinds[f.dataType.simpleString()](cell) for f, cell in zip(schema.fields, line.split(",")))
        for line in lines
    ]
    assert sorted(tuple(r) for r in df.collect()) == sorted(want)


RAGGED = ["x,U2,C2", "3000000000,U3,C3", "4,U4", "5,U5,C5,extra", "", "7,,C7", "8,U8,C8"]


def test_bad_cells_become_null_and_rows_stay(spark, tmp_path, rows_of):
    df = read_auth(spark, _write(spark, tmp_path / "log", RAGGED, "bzip2"))
    assert rows_of(df) == sorted(
        [
            (None, "U2", "C2"),
            (None, "U3", "C3"),
            (4, "U4", None),
            (5, "U5", "C5"),
            (7, None, "C7"),
            (8, "U8", "C8"),
        ],
        key=lambda row: [(v is not None, str(v)) for v in row],
    )


def test_split_malformed(spark, tmp_path, rows_of):
    path = _write(spark, tmp_path / "log", RAGGED, "none")
    good, rejected = split_malformed(spark, path, schemas.AUTH)
    assert rows_of(good) == [(7, None, "C7"), (8, "U8", "C8")]
    lines = [r["_rejected_line"] for r in rejected.collect()]
    assert sorted(lines) == sorted(["x,U2,C2", "3000000000,U3,C3", "4,U4", "5,U5,C5,extra"])
    assert schemas.AUTH.fieldNames() == ["time", "source_user", "source_computer"]


def test_split_malformed_under_any_projection(spark, tmp_path):
    path = _write(spark, tmp_path / "auth", ["1,U1,C1", "x,U2,C2", "4,U4", "5,U5,C5,extra", ""], "none")
    good, rejected = split_malformed(spark, path, schemas.AUTH)
    assert (good.count(), rejected.count()) == (1, 3)
    assert [r[0] for r in good.select("source_user").collect()] == ["U1"]
    assert {r[0] for r in rejected.select("source_user").collect()} == {"U2", "U4", "U5"}
    assert {r[0] for r in rejected.select("_rejected_line").collect()} == {"x,U2,C2", "4,U4", "5,U5,C5,extra"}


def test_dns_rename(spark):
    df = normalise_dns(spark.createDataFrame([], schemas.DNS))
    assert df.columns == ["time", "source_computer", "computer_resolved"]


def test_lines(spark, tmp_path):
    path = _write(spark, tmp_path / "log", ["a,b", "c"], "gzip")
    assert sorted(r["value"] for r in read_lines(spark, path).collect()) == ["a,b", "c"]


def _feed(folder: Path, name: str, status, urls) -> None:
    folder.mkdir(exist_ok=True)
    document = {"query_status": status, "urls": urls}
    (folder / name).write_text(json.dumps(document, indent=2))


def test_feed_is_flattened(spark, tmp_path, rows_of):
    folder = tmp_path / "feed"
    _feed(
        folder,
        "a.json",
        "ok",
        [
            {"url": "http://27.215.210.91:46312/bin.sh", "host": "27.215.210.91", "threat": "malware_download",
             "date_added": "2026-05-03 01:00:00 UTC", "tags": ["t1", "t2"]},
            {"url": "https://wood-zone.weplord.lat/x", "threat": "malware_download", "tags": None},
            {"host": "h", "threat": None, "extra": 1},
        ],
    )
    _feed(folder, "b.json", "ok", [])
    _feed(folder, "c.json", "no_results", [{"url": "http://z/"}])
    with pytest.warns(UserWarning, match="1 feed documents"):
        feed = read_threat_feed(spark, str(folder), on_bad="drop")
    assert [(f.name, f.dataType) for f in feed.schema] == [(f.name, f.dataType) for f in schemas.IOCS]
    kept = [
        ("", "h", "", "", ""),
        ("http://27.215.210.91:46312/bin.sh", "27.215.210.91", "malware_download",
         "2026-05-03 01:00:00 UTC", "t1,t2"),
        ("https://wood-zone.weplord.lat/x", "", "malware_download", "", ""),
    ]
    assert rows_of(feed) == sorted(kept)
    assert read_threat_feed(spark, str(folder), on_bad="keep").count() == 4
    with pytest.raises(Exception, match="feed status: no_results"):
        read_threat_feed(spark, str(folder)).collect()
    with pytest.raises(ValueError):
        read_threat_feed(spark, str(folder), on_bad="hide")


def test_a_broken_feed_document_ends_the_job(spark, tmp_path):
    folder = tmp_path / "feed"
    _feed(folder, "a.json", "ok", [{"url": "http://a/"}, {"url": "http://b/"}])
    text = (folder / "a.json").read_text()
    (folder / "b.json").write_text(text[: len(text) // 2])
    for on_bad in ("fail", "keep"):
        with pytest.raises(Exception, match="feed status: unreadable"):
            read_threat_feed(spark, str(folder), on_bad).select("url").collect()
    with pytest.raises(Exception, match="feed status: unreadable"):
        build_silver_iocs(spark, str(folder), str(tmp_path / "silver"))
    with pytest.warns(UserWarning, match="1 feed documents"):
        assert read_threat_feed(spark, str(folder), on_bad="drop").count() == 2
    assert {tuple(r) for r in feed_status(spark, str(folder)).collect()} == {("ok", 1), ("unreadable", 1)}


def test_newest_entries_of_many_documents(spark, tmp_path):
    folder = tmp_path / "feed"
    for k in range(3):
        _feed(folder, f"{k}.json", "ok", [{"url": f"http://h{k}/{i}", "date_added": f"2026-{i:04d}"} for i in range(1000)])
    assert build_silver_iocs(spark, str(folder), str(tmp_path / "silver"), newest=2500).count() == 2500


def test_feed_with_one_document_per_line(spark, tmp_path):
    lines = [
        json.dumps({"query_status": s, "urls": [{"url": f"http://{s}/"}]}) for s in ("ok", "bad", "ok")
    ]
    path = _write(spark, tmp_path / "feed", lines, "none")
    with pytest.warns(UserWarning):
        assert read_threat_feed(spark, path, on_bad="drop", one_per_line=True).count() == 2


def test_recent_iocs(spark):
    rows = [(f"http://h{i}/", "", "t", f"2026-01-{i % 9 + 1:02d}", "") for i in range(1005)]
    iocs = spark.createDataFrame(rows, schemas.IOCS)
    assert recent_iocs(iocs, 5000).count() == 1005
    for n in (0, -3):
        with pytest.raises(ValueError):
            recent_iocs(iocs, n)
    newest = [tuple(r) for r in recent_iocs(iocs, 20).collect()]
    want = sorted(rows, key=lambda r: r[0])
    want = sorted(want, key=lambda r: r[3], reverse=True)[:20]
    assert newest == want
