"""Line dedup by site-relative frequency.

Pages are grouped by host; a line's ratio is the share of the host's pages that contain it, and lines whose ratio
exceeds the boilerplate ratio are dropped from all pages of that host. What a host drops is bounded by the mean
number of lines of its pages divided by the ratio, so it travels to its pages as one array. The lines are counted by hash and stored; where what
all hosts drop is small (``shipped`` lines), it goes to every task and no text is shuffled. Beyond that pages
meet their host's array in a join by host, in which Spark splits the pages of a large host among tasks.

Cases: a null text is empty and has one empty line; blank lines are neither counted nor dropped; a line counts
once per page and repeated rows are pages of their own; null is a host like any other; a line must be on ``least`` pages, so small
hosts keep lines that only one page has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.grams import stored

RATIO, LEAST = 0.02, 3
# Dropped lines (8 bytes each, beside the host's name) that are shipped to all tasks.
SHIPPED = 1 << 22


def drop_site_lines(pages: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                    ratio: float = RATIO, least: int = LEAST, shipped: int = SHIPPED) -> DataFrame:
    """doc_id, source (the host), n_lines, n_dropped and the text without its boilerplate lines, for each page."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(host_col).cast("string").alias("source"),
        F.split(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "\n", -1).alias("lines"),
    )
    worded = F.filter("lines", lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    rows = rows.withColumn("keys", F.array_distinct(F.transform(worded, lambda x: F.xxhash64(x))))
    totals = rows.groupBy("source").agg(F.count("*").alias("pages")).withColumnRenamed("source", "host")
    counts = rows.select("source", F.explode("keys").alias("key")).groupBy("source", "key").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    common = counts.join(totals, F.col("source").eqNullSafe(F.col("host"))).filter(F.col("n") > F.lit(ratio) * F.col("pages"))
    common = stored(common.select("host", "key"), "site-lines")
    dropped = common.groupBy("host").agg(F.collect_list("key").alias("dropped"))
    size = common.agg(F.count("*").alias("n"), F.sum(F.octet_length("host")).alias("bytes")).first()
    if size["n"] + (size["bytes"] or 0) // 8 <= shipped:
        dropped = F.broadcast(dropped)
    joined = rows.join(dropped, F.col("source").eqNullSafe(F.col("host")), "left")
    hit = F.coalesce(F.array_intersect("keys", "dropped"), F.array().cast("array<bigint>"))
    joined = joined.withColumn("hit", hit)
    kept = F.when(F.size("hit") == 0, F.col("lines")).otherwise(F.filter("lines", lambda x: ~F.array_contains("hit", F.xxhash64(x))))
    joined = joined.withColumn("kept", kept)
    return joined.select("doc_id", "source", F.size("lines").cast("long").alias("n_lines"),
                         (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"), F.array_join("kept", "\n").alias("text"))


SQL = rf"""
with pages as (select doc_id, source, string_split(coalesce(text, ''), chr(10)) as lines from documents),
seen as (select source, unnest(list_distinct(list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) as line from pages),
totals as (select source, count(*) as n from pages group by source),
dropped as (
  select s.source, list(s.line) as lines from (select source, line, count(*) as n from seen group by source, line) s
  join totals t on s.source is not distinct from t.source
  where s.n >= {LEAST} and s.n > {RATIO} * t.n group by s.source),
kept as (
  select p.doc_id, p.source, p.lines,
         list_filter(p.lines, lambda x: not list_contains(coalesce(d.lines, []), x)) as rest
  from pages p left join dropped d on p.source is not distinct from d.source)
select doc_id, source, len(lines) as n_lines, len(lines) - len(rest) as n_dropped, array_to_string(rest, chr(10)) as text from kept
"""
