import json
import random

import pytest
from pyspark.sql import functions as F

from tabloom.operators import export, profile
from tabloom.session import scratch_dir
from tabloom.sources import files, markup, payloads, quoted


def pages(spark, *html):
    return spark.createDataFrame(list(enumerate(html)), "page int, html string")


def test_csv_with_quoted_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,text\n1,"two\nlines, ""quoted"""\n2,plain\n', encoding="utf-8")
    rows = files.read_csv(spark, str(tmp_path / "a.csv"), "id int, text string").collect()
    assert [(r["id"], r["text"]) for r in rows] == [(1, 'two\nlines, "quoted"'), (2, "plain")]
    assert files.read_csv(spark, str(tmp_path / "absent.csv")) is None
    assert dict(files.read_csv(spark, str(tmp_path / "a.csv")).dtypes)["id"] == "int"


def test_document_files(spark, tmp_path):
    for name in ("W2.PDF", "W1.pdf", "notes.txt"):
        (tmp_path / name).write_bytes(b"abc")
    rows = files.document_files(spark, str(tmp_path)).orderBy("filename").collect()
    assert [(r["filename"], r["length"]) for r in rows] == [("W1.pdf", 3), ("W2.PDF", 3)]


def test_pages_join_in_order_without_empty_ones(spark):
    rows = spark.createDataFrame(
        [("d", 2, "c"), ("d", 0, "a"), ("d", 1, ""), ("d", 3, None), ("e", 5, "x"), ("e", 4, "y")],
        "doc string, page int, text string",
    )
    got = files.joined_pages(rows, "doc", "page", "text").orderBy("doc").collect()
    assert [(r["doc"], r["text"], r["text_length"]) for r in got] == [("d", "a\nc", 3), ("e", "y\nx", 3)]


def test_listing_limits_and_defaults(spark):
    children = [{"data": {"title": f"t{i}", "score": i}} for i in range(25)]
    broken = "{not json"
    df = spark.createDataFrame([(1, json.dumps({"data": {"children": children}})), (2, broken), (3, "{}")], "k int, p string")
    rows = payloads.listing_posts(df, "p", ["k"], now=F.lit("now")).orderBy("post_id").collect()
    assert [r["post_id"] for r in rows] == list(range(1, 21)) and {r["k"] for r in rows} == {1}
    assert rows[0]["author"] == "" and rows[0]["created_utc"] == "1970-01-01 00:00:00"


def test_broken_listing_pages(spark):
    html = (
        '<div class="thing" data-fullname="t3_a" data-timestamp="2500"><p>unclosed<br>'
        '<a class="title" href="/r/x"> T <i>wo</i></a><a class="comments" href="/r/x/comments/a">1,5 comments</a>'
        '<div class="score unvoted">1.5k points</div></div></p></p>'
        '<div class="thing promoted" data-fullname="t3_b"><a class="comments" href="/comments/b">2</a></div>'
        '<div class="thing"><a class="comments" href="/comments/c">2</a></div>'
        '<div class="thing" data-fullname="t3_d"><a class="comments" href="http://h/d">3</a>'
    )
    (row,) = markup.forum_posts(pages(spark, html, None, "", "<div"), "page").collect()
    assert (row["post_id"], row["title"], row["score"], row["num_comments"]) == ("a", "Two", 1500, 15)
    assert row["created_utc"] == 2 and row["author"] == "[deleted]" and row["url"] == "https://old.reddit.com/r/x"


def test_untyped_rows_skip_posts_without_title_but_keep_positions(spark):
    html = '<div class="thing"></div>' + '<div class="thing"><a class="title" href="/x">A</a></div>' * 25
    rows = markup.listing_rows(pages(spark, html), "page", "html", "r/x").collect()
    assert [r["post_id"] for r in rows] == list(range(2, 21)) and rows[0]["score"] == "0"


def test_page_fields_take_rows_first_then_text(spark):
    html = (
        "<tr><td>Well Status</td><td>members only</td></tr><tr><th>WELL STATUS (now)</th><td> Active </td></tr>"
        "<tr><td>Well Status</td><td>Later</td></tr><p>Well Type</p> Oil <b>Township</b> Total Oil Prod 1,234 bbl"
    )
    row = markup.with_page_fields(pages(spark, html, "<p>x</p>")).orderBy("page").collect()
    assert (row[0]["well_status"], row[0]["well_type"], row[0]["oil_produced"]) == ("Active", "Oil", "1,234")
    assert row[0]["closest_city"] is None and row[1]["well_status"] is None


def test_nested_documents_are_one_per_parent(spark):
    parents = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, n string")
    children = spark.range(1000).select(F.when(F.col("id") < 990, 1).otherwise(2).alias("k"), "id", F.col("id").alias("v"), (F.col("id") % 3).alias("third"))
    rows = {r["k"]: r for r in export.nested_documents(parents, children, "k", ["id"], ["v"], "kids").collect()}
    assert sorted(rows) == [1, 2, 3] and rows[3]["kids"] == []
    assert [x["v"] for x in rows[1]["kids"]] == list(range(990)) and [x["v"] for x in rows[2]["kids"]] == list(range(990, 1000))
    parts = export.nested_documents(parents, children, "k", ["id"], ["v"], "kids", part="third").where("k = 1").collect()
    assert sorted(r["third"] for r in parts) == [0, 1, 2] and sum(len(r["kids"]) for r in parts) == 990


def test_json_keeps_nulls(spark):
    rows = spark.createDataFrame([(1, None)], "a int, b string")
    assert export.json_text(rows).head()["document"] == '{"a":1,"b":null}'


def test_summary_statuses(spark):
    table = spark.range(3)
    summary = profile.collection_summary({"a_b.csv": table, "c.csv": None, "d.csv": ValueError()})
    rows = {r["filename"]: r for r in summary.collect()}
    assert rows["a_b.csv"]["source"] == "A B" and rows["a_b.csv"]["records"] == 3
    assert rows["c.csv"]["status"] == "Not collected" and rows["d.csv"]["status"] == "Error"


def test_summary_has_widths_and_file_sizes(spark, tmp_path):
    rows = spark.createDataFrame([(i, f'say "{i}"\nand more', None) for i in range(50)], "a int, b string, c double").repartition(3)
    path = str(tmp_path / "rows")
    rows.write.option("header", True).option("escape", '"').csv(path)
    table = files.read_csv(spark, path, rows.schema)
    row = profile.collection_summary({"rows.csv": table}, {"rows.csv": path}).head()
    size = sum(f.stat().st_size for f in (tmp_path / "rows").glob("part-*"))
    assert (row["records"], row["columns"], row["size_kb"]) == (50, 3, round(size / 1024, 2))


def test_benchmark_log_and_speedups(spark):
    # Published times, seconds for the CPU and milliseconds for the others.
    lines = ["CPU execution time: 1", "CSV,CPU,512,1,0.317362", "CSV,GPU_NAIVE,512,10,0.714336", "CSV,BAD,x,1,2"]
    log = files.benchmark_log(spark.createDataFrame([(x,) for x in lines], "value string"))
    rows = profile.speedups(profile.mean_times(log.where("size IS NOT NULL"), ["CPU"]), "CPU").collect()
    assert {r["implementation"]: round(r["speedup"], 2) for r in rows} == {"CPU": 1.0, "GPU_NAIVE": 444.28}


class Session:
    """Stands in for a session with the given settings."""

    def __init__(self, **settings):
        self.conf = {k.replace("_", "."): v for k, v in settings.items()}


def test_scratch_folder_comes_from_the_session():
    shared = scratch_dir(Session(spark_checkpoint_dir="hdfs://h/tmp/", spark_master="yarn"), "x")
    assert shared.startswith("hdfs://h/tmp/x-")
    assert "tabloom-" in scratch_dir(Session(spark_master="local[4]"), "x")
    with pytest.raises(RuntimeError):
        scratch_dir(Session(spark_master="yarn"), "x")


@pytest.mark.parametrize("given, total", [([], (0, 0)), ([(0.0, 0.0), (None, None), (1.0, None)], (3, 1))])
def test_map_summary(spark, given, total):
    row = profile.map_summary(spark.createDataFrame(given, "latitude double, longitude double")).head()
    assert (row["total"], row["plotted"]) == total


QUOTED = "id long, text string, n int"


def quoted_file(path, rows, end):
    def cell(x):
        return "" if x is None else '"' + x.replace('"', '""') + '"' if x == "" or set(x) & set('",\n') else x

    lines = ["id,text,n", *(f"{i},{cell(x)},{n}" for i, x, n in rows)]
    path.write_bytes(end.join(lines).encode() + (end.encode() if end != "\n" else b""))


@pytest.mark.parametrize("end, most", [("\n", 1 << 18), ("\r\n", 1 << 18), ("\n", 0)])
def test_quoted_csv_is_read_in_splits(spark, tmp_path, end, most):
    rng = random.Random(5)
    texts = ["plain", 'with, "quotes"', "two\nlines", "\n\n", 'a "\n" b', "", None, ("long " * 40 + "\n") * 30 + "end", 'é,"ü"\n,1,2\n3,x,4']
    for name in "ab":
        quoted_file(tmp_path / f"{name}.csv", [(i, rng.choice(texts), i % 9) for i in range(500)], end)
    was = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = quoted.read_quoted_csv(spark, str(tmp_path), QUOTED, most_splits=most)
        whole = files.read_csv(spark, str(tmp_path), QUOTED)
        assert whole.rdd.getNumPartitions() <= 2
        assert spark.read.text(str(tmp_path / "a.csv")).rdd.getNumPartitions() > 30

        def rows(frame):
            return sorted(map(tuple, frame.collect()), key=repr)

        assert rows(got) == rows(whole) and len(rows(got)) == 1000
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def test_quoted_csv_without_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,text,n\n")
    (tmp_path / "b.csv").write_text("")
    (tmp_path / "c.csv").write_text('id,text,n\n1,"never\nclosed,3\n')
    assert [r["id"] for r in quoted.read_quoted_csv(spark, str(tmp_path), QUOTED).collect()] == [1]
