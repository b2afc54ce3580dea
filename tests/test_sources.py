import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from audience_engine.schemas import AB_LOG, DQ_LOG, RAW_POST_COMMENT, RAW_VIDEO_COMMENT
from audience_engine.settings import Settings
from audience_engine.sources import payloads, readers, sinks

HEADER = ",".join(f.name for f in RAW_VIDEO_COMMENT)


def write(path: Path, text: str) -> str:
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_with_quotes_and_lines(spark, tmp_path):
    row = 'YouTube,v,t,u,c1,a,"two\nlines, ""quoted""",3,1,0,2024-01-02T03:04:05Z,2024-01-02T03:04:05Z,cat,US,1,2,0'
    path = write(tmp_path / "a.csv", f"{HEADER}\n{row}\n")
    got = readers.read_comments_csv(spark, path, "youtube").first()
    assert got["text"] == 'two\nlines, "quoted"' and got["likes_or_score"] == 3
    assert got["created_utc"] == dt.datetime(2024, 1, 2, 3, 4, 5)


def test_csv_round_trip_and_bad_records(spark, tmp_path):
    df = spark.createDataFrame([("x", 'say "hi"\nthere', ["a", "é"], float("nan"), None)], "a string, b string, c array<string>, d double, e int")
    out = str(tmp_path / "out")
    sinks.write_csv(df, out)
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(out).fillna("")
    assert tuple(back.first()) == ("x", 'say "hi"\nthere', '["a","é"]', "", "")
    path = write(tmp_path / "bad.csv", f"{HEADER}\nYouTube,v,t,u,c1,a,b,many,1,0,,,cat,US,1,2,0\n")
    bad = readers.read_comments_csv(spark, path, "youtube", keep_bad=True).first()
    assert bad["likes_or_score"] is None and "many" in bad[readers.BAD_RECORD]


def test_empty_csv_keeps_header(spark, tmp_path):
    out = str(tmp_path / "empty")
    sinks.write_csv(spark.createDataFrame([], "a string, b int"), out)
    assert spark.read.option("header", True).csv(out).columns == ["a", "b"]


def test_jsonl_snapshots(spark, tmp_path):
    out = str(tmp_path / "snap")
    df = spark.createDataFrame([("reddit", "p", "c", dt.datetime(2024, 1, 1), "téxt", 1, 0, 0, 0, None, "u")], RAW_POST_COMMENT)
    sinks.write_jsonl(df, out, "2024-01-01")
    sinks.write_jsonl(df, out, "2024-01-02")
    back = readers.read_comments_jsonl(spark, out, "reddit")
    assert back.count() == 2 and back.first()["text"] == "téxt" and "dt" in back.columns


def test_tables(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    sinks.replace_table(a, "t_replace")
    sinks.replace_table(a.union(a), "t_replace")
    assert readers.read_table(spark, "t_replace").count() == 2
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        readers.read_table(spark, "t_missing").count()
    rows = spark.createDataFrame([("yt", "lang_other", 3)], DQ_LOG)
    sinks.append_table(rows, "t_log", DQ_LOG)
    sinks.append_table(rows, "t_log", DQ_LOG)
    assert spark.table("t_log").count() == 2
    with pytest.raises(ValueError):
        sinks.append_table(a, "t_log")
    with pytest.raises(ValueError):
        sinks.append_table(a, "t_new", DQ_LOG)


def test_bulk_load(spark, tmp_path):
    one = write(tmp_path / "one.csv", "a,b\n1,2\n")
    missing = str(tmp_path / "none.csv")
    assert sinks.bulk_load(spark, {"t_one": one, "t_none": missing}, skip_missing=True) == {"t_one": True, "t_none": False}
    assert spark.table("t_one").count() == 1
    with pytest.raises(FileNotFoundError):
        sinks.bulk_load(spark, {"t_none": missing})


def test_resolve_source_conforms_both(spark, tmp_path):
    path = write(tmp_path / "raw.csv", f"{HEADER}\nYouTube,v,t,u,c1,a,body,3,1,0,,,cat,US,1,2,0\n")
    local = readers.resolve_source(spark, path, "t_raw", "youtube")
    assert (local.first()["comment"], local.first()["source"]) == ("body", "youtube")
    sinks.replace_table(spark.createDataFrame([("tab", "c")], "text string, comment_id string"), "t_raw")
    stored = readers.resolve_source(spark, str(tmp_path / "no.csv"), "t_raw", "youtube")
    assert (stored.first()["comment"], stored.first()["source"]) == ("tab", "youtube")


def test_first_nonempty(spark):
    empty, one, two = spark.range(0), spark.range(1), spark.range(2)
    assert readers.first_nonempty([empty, two, one]).count() == 2
    assert readers.first_nonempty([empty, empty]).count() == 0


def test_training_and_ab_log(spark, tmp_path):
    good = write(tmp_path / "t.csv", "a,target\n1,2.5\n")
    assert dict(readers.read_training(spark, good).dtypes) == {"a": "int", "target": "double"}
    with pytest.raises(ValueError):
        readers.read_training(spark, write(tmp_path / "u.csv", "a,b\n1,2\n"))
    head = ",".join(f.name for f in AB_LOG)
    log = write(tmp_path / "ab.csv", f'{head}\np,t,v,"a\nb",2024-01-01T00:00:00Z,,,\nq,t,v,x,,3,bad,nan\nr,t,v,x,,1,1,0.5\n')
    rows = readers.read_ab_log(spark, log).orderBy("post_id").collect()
    assert [(r["replies"], r["likes"], r["ctr"]) for r in rows] == [(None, None, None), (3, None, None), (1, 1, 0.5)]
    assert rows[0]["variant_text"] == "a\nb" and rows[1]["ts"] is None


def test_manifest_and_fallback(spark, tmp_path):
    path = str(tmp_path / "manifest")
    sinks.write_manifest(spark, Settings(min_density=0.5), path, run="r1")
    row = json.loads(spark.read.text(path).first()[0])
    assert row["min_density"] == 0.5 and row["run"] == "r1" and row["as_of"] == "2024-03-31T00:00:00Z"
    df = spark.createDataFrame([(1,)], "a int")
    assert sinks.write_with_fallback(df, "t_ok", str(tmp_path / "x")) == "t_ok"
    debug = str(tmp_path / "debug")
    assert sinks.write_with_fallback(df, "no_such_db.t", debug) == debug
    assert spark.read.option("header", True).csv(debug).count() == 1


def test_payload_defaults(spark):
    pages = spark.createDataFrame(
        [("v", '{"items":[{"id":"c"},{"snippet":{"topLevelComment":{"snippet":{"likeCount":null,"textDisplay":"t"}}}}]}'), ("w", "{}")],
        "video_id string, payload string",
    )
    rows = payloads.flatten_comment_threads(pages).collect()
    assert [(r["comment_id"], r["text"], r["likes_or_score"], r["created_utc"]) for r in rows] == [("c", "", 0, None), ("", "t", 0, None)]
    videos = spark.createDataFrame([("US", "news", '{"items":[{"id":"a","statistics":{"viewCount":"7"}},{"snippet":{}}]}')], "region string, category string, payload string")
    got = payloads.flatten_videos(videos, "popular").collect()
    assert [(r["video_id"], r["view_count"], r["comment_count"], r["channel_id"], r["position"]) for r in got] == [("a", 7, 0, "", 0)]
    found = payloads.flatten_videos(spark.createDataFrame([('{"items":[{"id":{"videoId":"z"},"snippet":{"title":"T"}}]}',)], "payload string"), "marketing").first()
    assert (found["video_id"], found["comment_count"], found["region"], found["title"]) == ("z", 100, "marketing", "T")


def test_cell_safe(spark):
    df = spark.createDataFrame([(None, float("nan"), ["a"], {"k": 1}, (1,), "t")], "i int, d double, a array<string>, m map<string,int>, s struct<x:int>, t string")
    assert tuple(sinks.cell_safe(df).first()) == ("", "", '["a"]', '{"k":1}', '{"x":1}', "t")
    assert tuple(sinks.cell_safe(df.select(F.lit(1.5).alias("d"))).first()) == ("1.5",)


def test_columns_are_taken_by_name(spark, tmp_path):
    path = write(tmp_path / "shuffled.csv", "Text,comment_id,likes_or_score,unknown,platform\nhello,c9,many,x,youtube\n")
    got = readers.read_comments_csv(spark, path, "youtube").first()
    assert (got["text"], got["comment_id"], got["likes_or_score"], got["platform"], got["video_id"]) == ("hello", "c9", None, "youtube", None)
    with pytest.raises(ValueError, match="none of"):
        readers.read_comments_csv(spark, write(tmp_path / "other.csv", "a,b\n1,2\n"), "youtube")
    log = write(tmp_path / "log.csv", "ctr,likes,post_id\n0.5,3,p1\nnan,,p2\n")
    rows = {r["post_id"]: r for r in readers.read_ab_log(spark, log).collect()}
    assert (rows["p1"]["ctr"], rows["p1"]["likes"], rows["p2"]["ctr"], rows["p2"]["topic"]) == (0.5, 3, None, None)


def test_empty_path_and_unknown_source(spark, tmp_path):
    from audience_engine.plans import pipelines

    assert not readers.path_exists(spark, "") and not readers.path_exists(spark, str(tmp_path / "missing"))
    sinks.replace_table(spark.createDataFrame([("c", "some text", dt.datetime(2024, 3, 30))], "comment_id string, text string, created_utc timestamp_ntz"), "t_stored")
    merged = pipelines.merge_sources(spark, {"youtube": ""}, {"youtube": "t_stored"}, Settings())
    assert [r["comment"] for r in merged.collect()] == ["some text"]
    with pytest.raises(ValueError, match="tiktok"):
        pipelines.merge_sources(spark, {}, {"tiktok": "t_stored"}, Settings())


def test_training_schema(spark, tmp_path):
    path = write(tmp_path / "train.csv", "a,target\n1,2.5\n")
    assert readers.read_training(spark, path, schema="a int, target double").first().asDict() == {"a": 1, "target": 2.5}
    with pytest.raises(ValueError):
        readers.read_training(spark, path, label="other")


def test_listing_places_and_unreadable_pages(spark):
    def page(*ids):
        return json.dumps({"items": [{"id": i, "snippet": {"topLevelComment": {"snippet": {"textDisplay": i}}}} for i in ids]})

    pages = spark.createDataFrame([("v", 1, page("z", "a")), ("v", 0, page("m", "b")), ("v", 2, "{broken"), ("v", 3, "{}")], "video_id string, page int, payload string")
    rows = payloads.flatten_comment_threads(pages).orderBy("position").collect()
    assert [r["comment_id"] for r in rows] == ["m", "b", "z", "a"]
    assert [r["page"] for r in payloads.unreadable_pages(pages).collect()] == [2]
    found = spark.createDataFrame([(1, json.dumps({"items": [{"id": {"videoId": "x"}}, {"id": {"videoId": "y"}}]}))], "page int, payload string")
    places = [r["position"] for r in payloads.flatten_videos(found, "marketing").orderBy("position").collect()]
    assert places == [payloads.PAGE_ITEMS, payloads.PAGE_ITEMS + 1]
