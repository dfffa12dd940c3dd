"""Sources: payloads and pages are written from the tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.functions import text as tx
from tabloom.functions import values
from tabloom.functions.fixed_values import FORUM_BASE, FORUM_JSON_BASE
from tabloom.operators import export, ranking
from tabloom.plans import Query
from tabloom.session import load, scratch_dir, spread
from tabloom.sources import files, markup, payloads, quoted

NOW = "2025-01-01 00:00:00"


def _listings(spark, folder):
    """One listing of 25 posts per supplier; every third post lacks optional keys."""
    child = """transform(sequence(1, 25), i -> named_struct('kind', 't3', 'data', named_struct(
        'title', concat(s_name, ' post ', i),
        'author', if(i % 3 = 0, NULL, concat('a', s_suppkey)),
        'score', if(i % 3 = 0, NULL, s_nationkey * i),
        'num_comments', i,
        'created_utc', 1700000000.0D + s_suppkey * 60 + i,
        'selftext', repeat(concat(s_name, ' '), i),
        'permalink', concat('/r/x/comments/', s_suppkey, '_', i, '/'),
        'subreddit', 'x')))"""
    payload = F.to_json(F.struct(F.struct(F.expr(child).alias("children")).alias("data")))
    return load(spark, folder, "supplier").select("s_suppkey", payload.alias("payload"))


def listing_flatten(spark, folder):
    now = F.lit(NOW)
    return payloads.listing_posts(_listings(spark, folder), "payload", ["s_suppkey"], now=now)


def listing_top_scores(spark, folder):
    """Five best scores over all listings; the earlier post wins a tie."""
    posts = payloads.listing_posts(_listings(spark, folder), "payload", ["s_suppkey"], now=F.lit(NOW))
    order = [F.desc("score"), F.asc("s_suppkey"), F.asc("post_id")]
    return ranking.top_rows(posts, order, 5).select("s_suppkey", "post_id", "title", "score", "num_comments")


def summary_lookup(spark, folder):
    """Seven ids per search, of which five are looked up and the third is unknown."""
    suppliers = load(spark, folder, "supplier").withColumn("term", F.col("s_name"))
    ids = "transform(sequence(1, 7), i -> CAST(s_suppkey * 100 + i AS STRING))"
    searches = suppliers.select(
        "term", F.to_json(F.struct(F.struct(F.expr(ids).alias("idlist")).alias("esearchresult"))).alias("search")
    )
    articles = """map_from_entries(transform(filter(sequence(1, 7), i -> i <> 3), i -> named_struct(
        'k', CAST(s_suppkey * 100 + i AS STRING),
        'v', named_struct('title', concat('Study ', i, ' of ', s_name),
             'authors', transform(sequence(1, i), a -> named_struct('name', concat('Author ', a))),
             'fulljournalname', 'Journal', 'pubdate', concat(2000 + i, ' Jan'), 'source', 'J'))))"""
    listed = F.replace(
        F.to_json(F.struct(F.expr(articles).alias("result"))),
        F.lit('{"result":{'), F.lit('{"result":{"uids":["1","2"],'),
    )
    summaries = suppliers.select("term", listed.alias("summary"))
    return payloads.search_articles(searches, summaries, "term", "search", "summary", now=F.lit(NOW))


def author_lines(spark, folder):
    """Words of each conversation turn as author names."""
    rows = load(spark, folder, "conversations")
    names = F.transform(F.split("text", " "), lambda w: F.struct(w.alias("name")))
    return rows.select("conv_id", "turn", values.author_line(names).alias("authors"))


def _sightings(spark, folder):
    events = load(spark, folder, "events").select("user_id", "event_id", "event_type", "value")
    return [events.where(F.col("event_type") == kind) for kind in ("purchase", "view", "click", "signup", "error")]


def listing_union_dedup(spark, folder):
    return ranking.precedence_union(_sightings(spark, folder), "user_id", ["event_id"])


def listing_union_target(spark, folder):
    return ranking.precedence_union(_sightings(spark, folder), "user_id", ["event_id"], target_count=60)


def tagged_union(spark, folder):
    """Results of several searches, duplicates kept and tagged with the search."""
    docs = load(spark, folder, "part").select("p_partkey", "p_name", "p_type", "p_size")
    parts = [
        docs.where(condition).select("p_partkey", "p_name").withColumn("search_term", F.lit(term))
        for term, condition in (("red", "p_name LIKE '%red%'"), ("economy", "p_type = 'ECONOMY'"), ("large", "p_size > 25"))
    ]
    return ranking.stacked(parts)


def source_fallback(spark, folder):
    """Per customer the orders of the best status that has any."""
    rows = load(spark, folder, "orders").select(
        "o_orderkey", "o_custkey",
        F.expr("CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END").alias("priority"),
    )
    return ranking.first_source(rows, "o_custkey", "priority")


def drift_union(spark, folder):
    """Rows with typed scores and rows with score text in one table."""
    typed = load(spark, folder, "orders").select(
        F.col("o_orderkey").alias("post_id"), F.col("o_custkey").cast("bigint").alias("score"),
        F.col("o_orderstatus").alias("selftext"),
    )
    texts = load(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("post_id"),
        F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(" points")).alias("score"),
        F.concat(F.col("l_linenumber").cast("string"), F.lit(" comments")).alias("comments"),
    )
    cast = texts.select(
        "post_id", values.score_number(F.col("score")).alias("score"),
        values.comment_number(F.col("comments")).alias("num_comments"),
    )
    return ranking.stacked([typed, cast])


def score_texts(spark, folder):
    parts = load(spark, folder, "part").select(
        "p_partkey",
        F.expr("""CASE WHEN p_size < 10 THEN concat(p_size, '.', p_size % 10, 'k points')
                       WHEN p_size < 20 THEN concat(p_size, ',', lpad(p_size, 3, '0'), ' Points')
                       WHEN p_size < 30 THEN concat(p_size, ' point')
                       WHEN p_size < 40 THEN concat(p_size, ' votes')
                       WHEN p_size < 45 THEN '9999999999k points' ELSE '99999999999999999999 points' END""").alias("score"),
        F.expr("""CASE WHEN p_size < 25 THEN concat(p_size, ',', lpad(p_size, 3, '0'), ' comments')
                       WHEN p_size < 45 THEN 'comment' ELSE '3,000,000,000 comments' END""").alias("comments"),
    )
    return parts.select(
        "p_partkey", F.coalesce(values.score_number(F.col("score")), F.lit(0)).alias("score"),
        F.coalesce(values.comment_number(F.col("comments")), F.lit(0)).alias("comments"),
    )


def url_forms(spark, folder):
    rows = load(spark, folder, "supplier").select(
        "s_suppkey",
        F.expr("CASE WHEN s_acctbal > 5000 THEN concat('/r/x/', s_suppkey) ELSE concat('http://h/', s_suppkey) END").alias("url"),
        F.concat(F.lit("  "), "s_name", F.lit("  B-12 #"), F.col("s_nationkey").cast("string"), F.lit(" ")).alias("name"),
        F.concat(F.lit("t3_"), F.col("s_suppkey").cast("string")).alias("fullname"),
        (F.col("s_suppkey") * 1000 + 999 + 1_700_000_000_000).alias("millis"),
    )
    return rows.select(
        "s_suppkey",
        values.absolute_url(F.col("url"), FORUM_BASE).alias("url"),
        tx.slug(F.col("name")).alias("slug"),
        values.bare_id(F.col("fullname")).alias("post_id"),
        values.epoch_millis_to_seconds(F.col("millis")).alias("created_utc"),
        values.epoch_text(values.epoch_millis_to_seconds(F.col("millis"))).alias("created"),
        values.shortened(F.col("name"), 25).alias("short"),
    )


def _forum_pages(spark, folder):
    """A page per customer: a post, an advertisement, a link post and one without title."""
    html = """concat('<html><body><div id="siteTable">',
 '<div class="thing id-t3_', c_custkey, '" data-fullname="t3_', c_custkey, '" data-timestamp="', (1700000000 + c_custkey) * 1000 + 7, '">',
 '<div class="score unvoted">', c_nationkey, ' points</div><br>',
 '<a class="title may-blank" href="/r/x/comments/', c_custkey, '/t/">', c_mktsegment, ' &amp; <b>more</b> </a>',
 '<a class="author" href="/u/a">', c_name, '</a>',
 '<div class="expando"><div class="usertext-body"><p>Body of ', c_custkey, '</p><p>second &lt;line&gt;</p></div></div>',
 '<a class="comments" href="/r/x/comments/', c_custkey, '/t/">1,', lpad(c_nationkey, 3, '0'), ' comments</a></div>',
 '<div class="thing promotedlink" data-fullname="t3_ad', c_custkey, '"><a class="title" href="/ad">Buy</a></div>',
 '<div class="thing link" data-fullname="t3_l', c_custkey, '"><a class="title" href="http://e.example/">Out</a>',
 '<a class="comments" href="http://e.example/c">comment</a></div>',
 '<div class="thing self" data-fullname="t3_s', c_custkey, '" data-timestamp="1000"><div class="score">3</div>',
 '<a class="comments" href="https://h/comments/s', c_custkey, '">comment</a></div></div></body></html>')"""
    return spread(load(spark, folder, "customer")).select("c_custkey", F.expr(html).alias("html"))


def forum_posts(spark, folder):
    return markup.forum_posts(_forum_pages(spark, folder), "c_custkey")


def forum_listing(spark, folder):
    return markup.listing_rows(_forum_pages(spark, folder), "c_custkey", "html", "r/x", now=F.lit(NOW))


def promoted_filter(spark, folder):
    pages = markup.listing_elements(_forum_pages(spark, folder), "c_custkey")
    return pages.groupBy("classes").agg(F.count("*").alias("posts")).where(~F.col("classes").startswith("thing id-"))


def html_links(spark, folder):
    links = markup.page_links(load(spark, folder, "pages"), "page_id")
    return links.select("page_id", F.col("position").cast("bigint").alias("position"), "href", "text")


def html_link_forms(spark, folder):
    """Links in every form the standard has, one page per customer: quotes in other values, both quotes, none, markup inside."""
    html = """concat('<title class="a>b">', c_name, ' &amp; Co</title><!-- <a href="/no">no</a> -->',
  '<a title="x>y" href="/a/', c_custkey, '">A <b title="p>q">', c_mktsegment, '</b></a><script>"<a href=/js>js</a>"</script>',
  '<A HREF=\\'/b?x=', c_nationkey, '&amp;y=1\\' >B</A ><a href=/c/', c_custkey, '>C<a\n data-href="/no" href = "/d" title="p>q" href="/e">D</a>',
  '<a name="', c_custkey, '">no address</a><abbr href="/no">no</abbr><a href="/open">open')"""
    pages = spread(load(spark, folder, "customer")).select("c_custkey", F.expr(html).alias("html"))
    links = markup.page_links(pages, "c_custkey").select("c_custkey", F.col("position").cast("bigint").alias("position"), "href", "text")
    titles = pages.select("c_custkey", F.lit(-1).cast("bigint").alias("position"), F.lit("").alias("href"), markup.page_title(F.col("html")).alias("text"))
    return links.unionByName(titles)


def html_titles(spark, folder):
    return load(spark, folder, "pages").select("page_id", markup.page_title(F.col("html")).alias("title"))


def _well_pages(spark, folder):
    """Table pages for some customers, running text for others, hidden values in both."""
    html = """CASE WHEN c_nationkey < 12 THEN concat('<html><table><tr><th>Well Status</th><td> <b>&lt;5</b><i title="a>b">', c_mktsegment,
  '</i></td></tr><tr><td>Note</td></tr><TR class="r"><td><b>Well Type</b></td><td>Oil &amp; Gas<br></td></tr>',
  '<tr><td>Closest City</td><td>Members Only</td></tr>',
  '<tr><td>Total Oil Prod</td><td>', c_custkey, ',000</td></tr></table></html>')
 ELSE concat('<html><body><p>Well Status</p><div>', c_mktsegment, '</div><p>Well Type <i>Gas</i></p> Township 150 ',
  'Closest City ', c_name, ' Latitude 48 <span>Total Gas Prod</span> <b>', c_custkey, ',5</b></body></html>') END"""
    return spread(load(spark, folder, "customer")).select("c_custkey", F.expr(html).alias("html"))


def kv_page_fields(spark, folder):
    return markup.with_page_fields(_well_pages(spark, folder)).drop("html")


def page_fallback_lookup(spark, folder):
    """Pages exist under the county for some wells, under the default for others."""
    suppliers = load(spark, folder, "supplier")
    wells = suppliers.select(
        "s_suppkey",
        F.expr("CASE WHEN s_acctbal < 0 THEN NULL ELSE concat('33', lpad(s_nationkey, 3, '0'), lpad(s_suppkey, 6, '0')) END").alias("api_number"),
        F.concat("s_name", F.lit(" Well File No 7")).alias("well_name"),
        F.expr("CASE WHEN s_nationkey < 7 THEN 'Dunn Co' WHEN s_nationkey < 16 THEN 'Grand Forks' END").alias("county"),
    )
    base = "https://www.drillingedge.com/north-dakota/"
    tail = "concat('/wells/supplier-', lpad(s_suppkey, 9, '0'), '/33-', lpad(s_nationkey, 3, '0'), '-', lpad(s_suppkey, 6, '0'))"
    county = "CASE WHEN s_nationkey < 7 THEN 'dunn-county' ELSE 'grand-forks-county' END"
    empty = [F.lit(None).cast("string").alias(c) for c in ("closest_city", "oil_produced", "gas_produced")]
    own = suppliers.where("s_nationkey < 16").select(
        F.expr(f"concat('{base}', {county}, {tail})").alias("url"),
        F.expr("CASE WHEN s_nationkey < 10 THEN 'Active' END").alias("well_status"),
        F.lit("").alias("well_type"), *empty,
    )
    default = suppliers.select(
        F.expr(f"concat('{base}mckenzie-county', {tail})").alias("url"),
        F.lit("Inactive").alias("well_status"), F.lit("Gas").alias("well_type"), *empty,
    )
    return markup.page_lookup(
        wells, own.unionByName(default), values.county_slug(F.col("county")), F.lit("mckenzie-county")
    ).select("s_suppkey", "well_status", "well_type", "closest_city")


def page_assembly(spark, folder):
    pages = load(spark, folder, "conversations")
    whole = files.joined_pages(pages, "conv_id", "turn", "text")
    return whole.withColumn("text_length", F.col("text_length").cast("bigint"))


def engaged_posts(spark, folder):
    posts = load(spark, folder, "orders").select(
        F.col("o_orderkey").alias("post_id"), F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("created_utc"),
        F.expr("CASE o_orderstatus WHEN 'F' THEN concat('/r/comments/', o_orderkey) WHEN 'O' THEN '/r/x' END").alias("permalink"),
        F.expr("CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE 5 END").alias("score"),
        F.expr("CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END").alias("num_comments"),
    )
    return files.engaged_posts(posts)


def needs_enrichment(spark, folder):
    wells = load(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"),
        F.expr("CASE c_mktsegment WHEN 'BUILDING' THEN NULL WHEN 'MACHINERY' THEN 'N/A' ELSE c_mktsegment END").alias("well_status"),
    )
    return files.needs_enrichment(wells, "well_status").orderBy("id")


def csv_round_trip(spark, folder):
    """Write quoted line breaks, quotes and commas to CSV and scan them again."""
    rows = load(spark, folder, "part").select(
        "p_partkey", F.concat("p_name", F.lit('\n"x", '), "p_type").alias("title"), "p_size", "p_retailprice"
    )
    path = scratch_dir(spark, "csv")
    export.write_csv(rows, path)
    return quoted.read_quoted_csv(spark, path, "p_partkey bigint, title string, p_size int, p_retailprice double")


def json_round_trip(spark, folder):
    rows = load(spark, folder, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").cast("decimal(12,2)").alias("price"),
        F.struct("o_orderstatus", "o_orderpriority").alias("state"),
    )
    path = scratch_dir(spark, "json")
    export.write_json(rows, path)
    back = spark.read.schema(
        "o_orderkey bigint, day date, price double, state struct<o_orderstatus: string, o_orderpriority: string>"
    ).json(path)
    return back.select("o_orderkey", "day", "price", "state.*")


_TAIL = f"'{NOW}' AS"
_FORUM = "CAST(c_custkey AS VARCHAR)"
_SCORES = """CASE WHEN p_size < 10 THEN p_size * 1000::BIGINT + p_size * 100 WHEN p_size < 30 THEN p_size
  WHEN p_size BETWEEN 40 AND 44 THEN 9999999999000 ELSE 0 END"""

QUERIES = {
    "listing_flatten": Query(
        listing_flatten,
        f"""SELECT s_suppkey, i::INTEGER AS post_id, s_name || ' post ' || i AS title,
  CASE WHEN i % 3 = 0 THEN '' ELSE 'a' || s_suppkey END AS author,
  (CASE WHEN i % 3 = 0 THEN 0 ELSE s_nationkey * i END)::INTEGER AS score, i::INTEGER AS num_comments,
  strftime(make_timestamp((1700000000 + s_suppkey * 60 + i) * 1000000), '%Y-%m-%d %H:%M:%S') AS created_utc,
  substr(repeat(s_name || ' ', i), 1, 200) AS selftext,
  'https://www.reddit.com/r/x/comments/' || s_suppkey || '_' || i || '/' AS url, 'x' AS subreddit, {_TAIL} scraped_at
FROM supplier, generate_series(1, 20) AS g(i)""",
    ),
    "listing_top_scores": Query(
        listing_top_scores,
        """SELECT s_suppkey, i::INTEGER AS post_id, s_name || ' post ' || i AS title,
  (CASE WHEN i % 3 = 0 THEN 0 ELSE s_nationkey * i END)::INTEGER AS score, i::INTEGER AS num_comments
FROM supplier, generate_series(1, 20) AS g(i) ORDER BY score DESC, s_suppkey, i LIMIT 5""",
    ),
    "summary_lookup": Query(
        summary_lookup,
        f"""SELECT CAST(s_suppkey * 100 + i AS VARCHAR) AS pmid, 'Study ' || i || ' of ' || s_name AS title,
  CASE i WHEN 1 THEN 'Author 1' WHEN 2 THEN 'Author 1, Author 2' ELSE 'Author 1, Author 2, Author 3 et al.' END AS authors,
  'Journal' AS journal, (2000 + i) || ' Jan' AS pub_date, 'J' AS source, s_name AS search_term,
  'https://pubmed.ncbi.nlm.nih.gov/' || (s_suppkey * 100 + i) || '/' AS article_url, {_TAIL} fetched_at,
  i::INTEGER AS position
FROM supplier, generate_series(1, 5) AS g(i) WHERE i <> 3""",
    ),
    "author_lines": Query(
        author_lines,
        """SELECT conv_id, turn, array_to_string(string_split(text, ' ')[1:3], ', ') ||
  CASE WHEN len(string_split(text, ' ')) > 3 THEN ' et al.' ELSE '' END AS authors FROM conversations""",
    ),
    "listing_union_dedup": Query(
        listing_union_dedup,
        """SELECT user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY
  list_position(['purchase', 'view', 'click', 'signup', 'error'], event_type), event_id) = 1""",
    ),
    "listing_union_target": Query(
        listing_union_target,
        """SELECT user_id, event_id, event_type, value FROM (
  SELECT *, list_position(['purchase', 'view', 'click', 'signup', 'error'], event_type) AS part FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY part, event_id) = 1)
ORDER BY part, event_id LIMIT 60""",
    ),
    "tagged_union": Query(
        tagged_union,
        """SELECT p_partkey, p_name, 'red' AS search_term FROM part WHERE p_name LIKE '%red%'
UNION ALL SELECT p_partkey, p_name, 'economy' FROM part WHERE p_type = 'ECONOMY'
UNION ALL SELECT p_partkey, p_name, 'large' FROM part WHERE p_size > 25""",
    ),
    "source_fallback": Query(
        source_fallback,
        """WITH t AS (SELECT o_orderkey, o_custkey,
  CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS priority FROM orders)
SELECT * FROM t QUALIFY priority = min(priority) OVER (PARTITION BY o_custkey)""",
    ),
    "drift_union": Query(
        drift_union,
        """SELECT o_orderkey AS post_id, o_custkey::BIGINT AS score, o_orderstatus AS selftext, NULL::BIGINT AS num_comments
FROM orders UNION ALL SELECT l_orderkey, l_quantity::BIGINT, NULL, l_linenumber::BIGINT FROM lineitem""",
    ),
    "score_texts": Query(
        score_texts,
        f"""SELECT p_partkey, {_SCORES} AS score,
  CASE WHEN p_size < 25 THEN p_size * 1000::BIGINT + p_size WHEN p_size < 45 THEN 0 ELSE 3000000000 END AS comments FROM part""",
    ),
    "url_forms": Query(
        url_forms,
        """SELECT s_suppkey, CASE WHEN s_acctbal > 5000 THEN 'https://old.reddit.com/r/x/' ELSE 'http://h/' END || s_suppkey AS url,
  'supplier-' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') || '-b-12-' || s_nationkey AS slug,
  CAST(s_suppkey AS VARCHAR) AS post_id, 1700000000 + s_suppkey AS created_utc,
  strftime(make_timestamp((1700000000 + s_suppkey) * 1000000), '%Y-%m-%d %H:%M:%S') AS created,
  substr('  ' || s_name || '  B-12', 1, 25) || '...' AS short
FROM supplier""",
    ),
    "forum_posts": Query(
        forum_posts,
        f"""SELECT c_custkey, 1 AS position, {_FORUM} AS post_id, 't3_' || {_FORUM} AS fullname,
  1700000000 + c_custkey AS created_utc, c_mktsegment || ' &more' AS title,
  'Body of ' || {_FORUM} || ' second <line>' AS selftext, c_name AS author, c_nationkey::BIGINT AS score,
  1000::BIGINT + c_nationkey AS num_comments, 'https://old.reddit.com/r/x/comments/' || {_FORUM} || '/t/' AS url,
  'https://old.reddit.com/r/x/comments/' || {_FORUM} || '/t/' AS permalink, 1 AS is_self, 0 AS over_18, 0 AS stickied
FROM customer
UNION ALL
SELECT c_custkey, 4, 's' || {_FORUM}, 't3_s' || {_FORUM}, 1, '', '', '[deleted]', 0, 0, '',
  'https://h/comments/s' || {_FORUM}, 1, 0, 0 FROM customer""",
    ),
    "forum_listing": Query(
        forum_listing,
        f"""SELECT c_custkey, 1 AS post_id, c_mktsegment || ' & more' AS title, c_name AS author,
  c_nationkey || ' points' AS score, '1,' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') || ' comments' AS comments,
  'https://www.reddit.com/r/x/comments/' || {_FORUM} || '/t/' AS url, 'r/x' AS subreddit, {_TAIL} scraped_at FROM customer
UNION ALL SELECT c_custkey, 2, 'Buy', '', '0', '0', 'https://www.reddit.com/ad', 'r/x', '{NOW}' FROM customer
UNION ALL SELECT c_custkey, 3, 'Out', '', '0', 'comment', 'http://e.example/', 'r/x', '{NOW}' FROM customer""",
    ),
    "promoted_filter": Query(
        promoted_filter,
        """SELECT unnest(['thing promotedlink', 'thing link', 'thing self']) AS classes, count(*) AS posts FROM customer""",
    ),
    "html_links": Query(
        html_links,
        """WITH found AS (SELECT page_id, regexp_extract_all(html, '<a [^>]*?href="[^"]*"[^>]*>[^<]*</a>') AS links FROM pages),
flat AS (SELECT page_id, unnest(links) AS link, generate_subscripts(links, 1) - 1 AS position FROM found)
SELECT page_id, position, regexp_extract(link, 'href="([^"]*)"', 1) AS href, trim(regexp_extract(link, '>([^<]*)<', 1)) AS text
FROM flat""",
    ),
    "html_link_forms": Query(
        html_link_forms,
        """SELECT c_custkey, unnest([-1, 0, 1, 2, 3])::BIGINT AS position,
  unnest(['', '/a/' || c_custkey, '/b?x=' || c_nationkey || '&y=1', '/c/' || c_custkey, '/d']) AS href,
  unnest([c_name || ' & Co', 'A ' || c_mktsegment, 'B', 'C', 'D']) AS text FROM customer""",
    ),
    "html_titles": Query(
        html_titles,
        """SELECT page_id, regexp_replace(replace(replace(trim(regexp_extract(html, '<title>([^<]*)</title>', 1)),
  '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g') AS title FROM pages""",
    ),
    "kv_page_fields": Query(
        kv_page_fields,
        """SELECT c_custkey, CASE WHEN c_nationkey < 12 THEN '<5 ' ELSE '' END || c_mktsegment AS well_status,
  CASE WHEN c_nationkey < 12 THEN 'Oil & Gas' ELSE 'Gas' END AS well_type,
  CASE WHEN c_nationkey < 12 THEN NULL ELSE c_name END AS closest_city,
  CASE WHEN c_nationkey < 12 THEN c_custkey || ',000' END AS oil_produced,
  CASE WHEN c_nationkey < 12 THEN NULL ELSE c_custkey || ',5' END AS gas_produced FROM customer""",
    ),
    "page_fallback_lookup": Query(
        page_fallback_lookup,
        """SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN NULL WHEN s_nationkey < 10 THEN 'Active'
    ELSE 'Inactive' END AS well_status,
  CASE WHEN s_acctbal < 0 THEN NULL WHEN s_nationkey < 10 THEN '' ELSE 'Gas' END AS well_type,
  CAST(NULL AS VARCHAR) AS closest_city FROM supplier""",
    ),
    "page_assembly": Query(
        page_assembly,
        """SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS text,
  length(string_agg(text, chr(10) ORDER BY turn)) AS text_length
FROM conversations WHERE text <> '' GROUP BY 1""",
    ),
    "engaged_posts": Query(
        engaged_posts,
        """SELECT o_orderkey AS post_id, CAST(epoch(o_orderdate) AS BIGINT) AS created_utc, '/r/comments/' || o_orderkey AS permalink,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE 5 END AS score, CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END AS num_comments
FROM orders WHERE o_orderstatus = 'F' AND (o_orderpriority <> '1-URGENT' OR o_totalprice > 250000)""",
    ),
    "needs_enrichment": Query(
        needs_enrichment,
        """SELECT c_custkey AS id, CASE c_mktsegment WHEN 'MACHINERY' THEN 'N/A' END AS well_status
FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""",
    ),
    "csv_round_trip": Query(
        csv_round_trip,
        """SELECT p_partkey, p_name || chr(10) || '"x", ' || p_type AS title, p_size, p_retailprice FROM part""",
    ),
    "json_round_trip": Query(
        json_round_trip,
        """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, o_totalprice AS price, o_orderstatus, o_orderpriority FROM orders""",
    ),
}
