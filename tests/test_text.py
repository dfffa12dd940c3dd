import collections
import random
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabloom.functions import text as tx
from tabloom.functions import values


def value(spark, column, given, kind="string"):
    row = spark.createDataFrame([(given,)], f"x {kind}").select(column(F.col("x")).alias("y")).head()
    return row["y"]


@pytest.mark.parametrize(
    "title, cleaned, words, hint",
    [
        ("Pregnancy and workout", "Pregnancy and workout", "pregnancy,workout", "pregnancy"),
        ("GYM JAMS", "GYM JAMS", "gym,jams", "gym"),
        ("Shipping Container Gym vs Shed Gym", "Shipping Container Gym vs Shed Gym", "gym,shipping,container,shed", "gym"),
        ("How do you track your rests??", "How do you track your rests", "how,track,rests", "how"),
        ("advice? 16F", "advice 16F", "advice,16f", "advice"),
        ("👋", "", "", "general"),
        (None, "", "", "general"),
    ],
)
def test_cleaning_and_keywords(spark, title, cleaned, words, hint):
    df = spark.createDataFrame([(title,)], "x string").withColumn("c", tx.clean_text(F.col("x")))
    row = df.withColumn("k", tx.top_keywords(F.col("c"))).select("c", "k", tx.topic_hint(F.col("k")).alias("h")).head()
    assert (row["c"], ",".join(row["k"]), row["h"]) == (cleaned, words, hint)


@pytest.mark.parametrize(
    "raw, cleaned",
    [
        ("see /u/bob now", "see USER now"),
        ("u/bob http://a.b/c?d www.x.y end", "u bob end"),
        ("a &lt;b&gt;c&lt;/b&gt; &amp;amp; d", "a c d"),
        ("x<script>var t='</p>';</script>y<!-- z --><br>w", "x y w"),
        ("1 < 2 and 3 > 2", "1 2 and 3 2"),
        ("café au lait", "caf au lait"),
    ],
)
def test_clean_text_rules(spark, raw, cleaned):
    assert value(spark, tx.clean_text, raw) == cleaned


@pytest.mark.parametrize("raw, out", [(None, "N/A"), ("<b></b>", "N/A"), ("a<b>b</b>é  c", "ab c"), ("", "N/A")])
def test_ascii_text(spark, raw, out):
    assert value(spark, tx.ascii_text, raw) == out


@pytest.mark.parametrize("raw, out", [(None, "0"), (" 1,234 ", "1234"), ("None", "0"), ("", "0"), ("7.5", "7.5")])
def test_numeric_text(spark, raw, out):
    assert value(spark, tx.numeric_text, raw) == out


def test_mask_author(spark):
    assert value(spark, tx.mask_author, "bob") == "user_887420"
    assert {value(spark, tx.mask_author, n) for n in (None, "", "[deleted]", "None")} == {"[deleted]"}


def test_slug(spark):
    assert value(spark, tx.slug, "  Oasis B-12 #3 ") == "oasis-b-12-3"


def test_counts_match_a_counter(spark):
    rng = random.Random(3)
    docs = [" ".join(rng.choice("alpha beta gamma delta Beta 77 the".split()) for _ in range(rng.randint(0, 60))) for _ in range(40)]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "id int, x string")
    rows = df.select(
        "id", tx.token_counts(tx.keyword_tokens(F.col("x"))).alias("c"), tx.top_keywords(F.col("x"), 3).alias("k"),
        tx.term_counts(F.split("x", " ")).alias("t"),
    ).collect()
    for row in rows:
        tokens = [t.lower() for t in docs[row["id"]].split() if len(t) > 2 and t != "the"]
        counter = collections.Counter(tokens)
        assert {r["token"]: r["n"] for r in row["c"]} == dict(counter)
        assert {r["token"]: r["first_pos"] for r in row["c"]} == {t: tokens.index(t) for t in counter}
        assert row["k"] == [w for w, _ in counter.most_common(3)]
        assert {r["token"]: r["n"] for r in row["t"]} == dict(collections.Counter(docs[row["id"]].split(" ")))


@pytest.mark.parametrize("raw, out", [("1.2k points", 1200), ("37 points", 37), ("1,234 points", 1), ("•", 0), ("12", 0)])
def test_score_number(spark, raw, out):
    assert value(spark, values.score_number, raw) == out


@pytest.mark.parametrize("raw, out", [("1,234 comments", 1234), ("comment", 0)])
def test_comment_number(spark, raw, out):
    assert value(spark, values.comment_number, raw) == out


@pytest.mark.parametrize("names, out", [("ABCD", "A, B, C et al."), ("AB", "A, B"), ("ABC", "A, B, C"), ("", "")])
def test_author_line(spark, names, out):
    given = [(n,) for n in names]
    assert value(spark, values.author_line, given, "array<struct<name:string>>") == out


@pytest.mark.parametrize(
    "text, latitude, longitude",
    [
        ("N 48° 01' 29.869\"  W 103° 30' 15.5\"", 48.024964, -103.504306),
        ("48° 01' 29.869\" N, 103° 30' 15.5\" W", 48.024964, -103.504306),
        ("N 48° 01' 29.869\" then 103° 30' 15.5\" W", 48.024964, -103.504306),
        ("n 12° 1' 1\" N 46° 0' 0\" N 49° 0' 0\" E 101˚ 0’ 0”", 46.0, -101.0),
        ("Latitude: 47.1234 Longitude: 102.5678", 47.1234, -102.5678),
        ("latitude: 47.1234", None, None),
        ("N 48° 01' 1.2.3\"", None, None),
        ("", None, None),
        (None, None, None),
    ],
)
def test_coordinates(spark, text, latitude, longitude):
    found = value(spark, values.coordinates, text)
    assert (found["latitude"], found["longitude"]) == (latitude, longitude)


@pytest.mark.parametrize(
    "county, part",
    [(None, "mckenzie-county"), ("", "mckenzie-county"), ("Williams Co.", "williams-county"), ("Golden Valley", "golden-valley-county")],
)
def test_county_slug(spark, county, part):
    assert value(spark, values.county_slug, county) == part


@pytest.mark.parametrize("api, out", [("33 053 12345", "33-053-12345"), ("33053123456", "33-053-123456"), ("3305312345", "3305312345")])
def test_dashed_api(spark, api, out):
    assert value(spark, values.dashed_api, api) == out


def test_well_url_strips_name_tail(spark):
    row = spark.createDataFrame([("33-1", "Big Well 3H Directional Survey")], "a string, n string")
    url = row.select(values.well_url(F.col("a"), F.col("n"), F.lit("dunn-county"), "http://h").alias("u")).head()["u"]
    assert url == "http://h/north-dakota/dunn-county/wells/big-well-3h/33-1"


def test_small_formats(spark):
    assert value(spark, values.file_title, "forum_posts.csv") == "Forum Posts"
    assert value(spark, lambda c: values.shortened(c, 3), "abcd") == "abc..."
    assert value(spark, lambda c: values.shortened(c, 3), "abc") == "abc"
    assert value(spark, values.epoch_millis_to_seconds, "1999") == 1
    assert value(spark, lambda c: values.absolute_url(c, "http://h"), "/a") == "http://h/a"


def test_long_texts_are_cleaned_a_few_at_a_time():
    texts = [None if i % 7 == 0 else f"&lt;b&gt;x{i}&lt;/b&gt;" + " &amp;amp;" * 4000 for i in range(300)]
    tracemalloc.start()
    found = tx._escaped_markup_to_text.func(pa.array(texts))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [x is None for x in found.to_pylist()] == [x is None for x in texts] and found[1].as_py().startswith(" x1  & &")
    assert most < 8 << 20
