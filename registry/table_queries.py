"""Queries that run the generic operators on the test tables directly."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import query
from vacancia.functions import arrays, dates, rules
from vacancia.functions.text import dedup_key, html_to_text, map_values, role_key
from vacancia.operators import aggregates as agg
from vacancia.operators import dedupe, joins, overlay, profiling, quality, ranking, similarity
from vacancia.operators import filters as flt
from vacancia.session import workspace
from vacancia.sources import web_pages
from vacancia.testbed import table

# -- deduplication -----------------------------------------------------------------------


@query(
    "dedupe_latest",
    """SELECT user_id, event_id, ts, event_type FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS FIRST, event_id DESC NULLS FIRST) = 1""",
)
def dedupe_latest(spark, sf):
    rows = table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type")
    return dedupe.latest_per_key(rows, ["user_id"], ["ts", "event_id"])


@query(
    "dedupe_latest_null_keys_kept",
    """WITH e AS (SELECT CASE WHEN user_id % 3 != 0 THEN user_id END AS user_id, event_id FROM events)
    SELECT * FROM e QUALIFY user_id IS NULL OR row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""",
)
def dedupe_latest_null_keys_kept(spark, sf):
    rows = table(spark, sf, "events").select(
        F.when(F.col("user_id") % 3 != 0, F.col("user_id")).alias("user_id"), "event_id"
    )
    return dedupe.latest_per_key(rows, ["user_id"], ["event_id"], null_keys="keep")


@query(
    "dedupe_priority",
    """SELECT p_partkey, p_name, p_brand, p_type FROM part
    QUALIFY row_number() OVER (PARTITION BY lower(trim(p_name)) || ' | ' || lower(trim(p_brand))
      ORDER BY CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'STANDARD' THEN 2 END NULLS LAST, p_partkey) = 1""",
)
def dedupe_priority(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    rank = F.when(F.col("p_type") == "ECONOMY", 1).when(F.col("p_type") == "STANDARD", 2)
    return dedupe.best_per_expression(rows, dedup_key("p_name", "p_brand"), rank, ["p_partkey"])


FINGERPRINTS = """WITH d AS (
  SELECT doc_id, source, lower(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) AS t, lang,
    list_sort(list_distinct(string_split(source || ' ' || lang, ' '))) AS tags FROM documents) """


def fingerprint_rows(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        "source",
        F.col("text").alias("t"),
        "lang",
        F.split(F.concat_ws(" ", "source", "lang"), " ").alias("tags"),
    )


@query(
    "fingerprint_cap",
    FINGERPRINTS
    + """SELECT doc_id, source FROM (SELECT * FROM d
      QUALIFY row_number() OVER (PARTITION BY t, lower(trim(lang)), tags ORDER BY doc_id) = 1)
    QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 3""",
)
def fingerprint_cap(spark, sf):
    unique = dedupe.fingerprint_dedup(fingerprint_rows(spark, sf), ["t", "lang"], ["tags"], "doc_id")
    return dedupe.cap_per_group(unique, ["source"], 3, "doc_id").select("doc_id", "source")


@query(
    "fingerprint_groups",
    FINGERPRINTS
    + """SELECT md5(t) AS t, lower(trim(lang)) AS lang, array_to_string(tags, ',') AS tags, count(*) AS n, min(doc_id) AS first
    FROM d GROUP BY ALL HAVING count(*) > 1""",
)
def fingerprint_groups(spark, sf):
    groups = dedupe.fingerprint_groups(fingerprint_rows(spark, sf), ["t", "lang"], ["tags"], "doc_id")
    return groups.withColumn("tags", F.array_join("tags", ",")).withColumn("t", F.md5("t"))


@query(
    "cap_report",
    """SELECT source, count(*) AS total, least(count(*), 3) AS kept, count(*) - least(count(*), 3) AS left_out
    FROM documents GROUP BY ALL""",
)
def cap_report(spark, sf):
    return dedupe.cap_report(table(spark, sf, "documents"), ["source"], 3)


@query(
    "cap_large",
    """SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_returnflag
      ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) <= 1500""",
)
def cap_large(spark, sf):
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    rows = table(spark, sf, "lineitem").select("l_returnflag", *order)
    capped = dedupe.cap_per_group(rows, ["l_returnflag"], 1500, order)
    return capped.select("l_returnflag", "l_orderkey", "l_linenumber", "l_partkey")


# The other engine's edit distance counts bytes: its side spells each letter beyond ASCII as one
# control character, which leaves every distance as it is.
ACCENTED = "éèêçñíóüöäßáúàëïîôùûœ"
PLAIN = "translate(lower({}), '" + ACCENTED + "', " + " || ".join(f"chr({i + 1})" for i in range(len(ACCENTED))) + ")"
PAGES = """WITH p AS (SELECT page_id, split_part(url, '/', 3) AS site, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
    DATE '2024-01-01' + CAST(page_id % 28 AS INTEGER) AS day FROM pages),
  d AS (SELECT * FROM p QUALIFY row_number() OVER (
    PARTITION BY lower(trim(title)) || ' | ' || lower(trim(site)) ORDER BY page_id) = 1)
"""


@query(
    "fuzzy_pairs",
    PAGES
    + f"""SELECT a.page_id AS id_a, b.page_id AS id_b, a.title AS title_a, b.title AS title_b,
      a.site AS company_a, b.site AS company_b, a.day AS day_a, b.day AS day_b
    FROM d a JOIN d b ON a.page_id < b.page_id AND abs(date_diff('day', a.day, b.day)) <= 3
      AND length(a.title) > 0 AND length(b.title) > 0
      AND levenshtein({PLAIN.format("a.title")}, {PLAIN.format("b.title")}) / greatest(length(a.title), length(b.title)) <= 0.15
      AND levenshtein(lower(a.site), lower(b.site)) / greatest(length(a.site), length(b.site)) <= 0.35""",
)
def fuzzy_pairs(spark, sf):
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    rows = table(spark, sf, "pages").select(
        "page_id",
        F.split_part("url", F.lit("/"), F.lit(3)).alias("site"),
        title.alias("title"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 28).cast("int")).alias("day"),
    )
    unique = dedupe.best_per_expression(rows, dedup_key("title", "site"), F.lit(1), ["page_id"])
    return similarity.fuzzy_pairs(unique, "page_id", "title", "site", "day")


# -- joins and set operations ------------------------------------------------------------


@query(
    "anti_unlabelled",
    "SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
)
def anti_unlabelled(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "source")
    return joins.unlabelled(rows, table(spark, sf, "labels"), "doc_id")


@query(
    "anti_null_aware_empty",
    """SELECT o_custkey FROM orders WHERE o_custkey NOT IN
      (SELECT CASE WHEN c_custkey % 7 != 0 THEN c_custkey END FROM customer)""",
)
def anti_null_aware_empty(spark, sf):
    known = table(spark, sf, "customer").select(
        F.when(F.col("c_custkey") % 7 != 0, F.col("c_custkey")).alias("o_custkey")
    )
    return joins.unlabelled(table(spark, sf, "orders").select("o_custkey"), known, "o_custkey", null_aware=True)


@query(
    "coverage_by_source",
    """SELECT source, count(l.doc_id) AS labelled, count(*) AS total
    FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id) GROUP BY ALL""",
)
def coverage_by_source(spark, sf):
    return joins.coverage(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id", "source")


@query(
    "labels_attached",
    "SELECT d.doc_id, d.lang, l.quality, l.toxic AS label_toxic FROM documents d LEFT JOIN labels l USING (doc_id)",
)
def labels_attached(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "lang")
    return joins.attach(rows, table(spark, sf, "labels"), ["doc_id"], rename={"toxic": "label_toxic"})


@query(
    "id_reconcile",
    """WITH a AS (SELECT DISTINCT c_custkey AS id FROM customer), b AS (SELECT DISTINCT o_custkey + 100 AS id FROM orders)
    SELECT count(a.id) AS n_left, count(b.id) AS n_right, count(*) FILTER (a.id = b.id) AS matched,
      count(*) FILTER (b.id IS NULL) AS left_only, count(*) FILTER (a.id IS NULL) AS right_only
    FROM a FULL JOIN b ON a.id = b.id""",
)
def id_reconcile(spark, sf):
    a = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    b = table(spark, sf, "orders").select((F.col("o_custkey") + 100).alias("id"))
    return joins.reconcile_ids(a, b, "id")


@query(
    "union_of_tables",
    """SELECT kind, count(*) AS n, count(detail) AS with_detail FROM (
      SELECT 'customer' AS kind, c_mktsegment AS detail FROM customer UNION ALL SELECT 'supplier', NULL FROM supplier)
    GROUP BY ALL""",
)
def union_of_tables(spark, sf):
    frames = [
        table(spark, sf, "customer").select(F.lit("customer").alias("kind"), F.col("c_mktsegment").alias("detail")),
        table(spark, sf, "supplier").select(F.lit("supplier").alias("kind")),
    ]
    merged = joins.union_all(frames, allow_missing=True)
    return merged.groupBy("kind").agg(F.count("*").alias("n"), F.count("detail").alias("with_detail"))


@query(
    "row_counts",
    """SELECT 'orders' AS name, count(*) AS n FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem
    UNION ALL SELECT 'events', count(*) FROM events""",
)
def row_counts(spark, sf):
    return agg.row_counts({name: table(spark, sf, name) for name in ("orders", "lineitem", "events")})


@query(
    "topk_restricted",
    """WITH top AS (SELECT l_suppkey FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, l_suppkey LIMIT 5)
    SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem WHERE l_suppkey IN (SELECT l_suppkey FROM top)
    GROUP BY ALL""",
)
def topk_restricted(spark, sf):
    rows = ranking.restrict_topk(table(spark, sf, "lineitem"), "l_suppkey", 5)
    return rows.groupBy("l_suppkey", "l_returnflag").agg(F.count("*").alias("n"))


@query(
    "mapped_values",
    """SELECT CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'unknown' END AS status,
      count(*) AS n FROM orders GROUP BY ALL""",
)
def mapped_values(spark, sf):
    status = map_values("o_orderstatus", {"F": "finished", "O": "open"}, F.lit("unknown"))
    return agg.bucket_counts(table(spark, sf, "orders"), status, "status")


# -- extraction, text and rules ----------------------------------------------------------


@query(
    "json_extract",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
      json_extract_string(props, '$.missing') AS missing FROM events""",
)
def json_extract(spark, sf):
    doc = F.try_parse_json("props")
    return table(spark, sf, "events").select(
        "event_id",
        F.try_variant_get(doc, "$.k", "bigint").alias("k"),
        F.try_variant_get(doc, "$.missing", "string").alias("missing"),
    )


@query(
    "json_key_profile",
    """WITH k AS (SELECT unnest(json_keys(props)) AS key, props, event_id FROM events)
    SELECT key, count(*) AS non_null, count(*) AS present, arg_min(json_extract_string(props, '$.' || key), event_id)
      AS sample, (SELECT count(*) FROM events) AS total,
      round_even(100.0 * count(*) / (SELECT count(*) FROM events), 1)::DOUBLE AS population_pct FROM k GROUP BY key""",
)
def json_key_profile(spark, sf):
    return profiling.json_key_profile(table(spark, sf, "events"), "props", "event_id")


@query(
    "html_text",
    """SELECT page_id, trim(regexp_replace(regexp_replace(
        replace(replace(replace(replace(html, '&amp;', '&'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'),
        '<[^>]+>', ' ', 'g'), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g')) AS text FROM pages""",
)
def html_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", html_to_text("html").alias("text"))


def listing_pages(spark, sf):
    """Pages with a JSON-LD listing made of their own links."""
    links = F.regexp_extract_all("html", F.lit(r'<a href="([^"]*)">'), F.lit(1))
    items = F.transform(links, lambda u: F.struct(u.alias("url"), F.concat(F.lit("Job at "), u).alias("name")))
    graph = F.array(F.struct(F.lit("ItemList").alias("@type"), items.alias("itemListElement")))
    script = F.concat(
        F.lit('<script type="application/ld+json">'), F.to_json(F.struct(graph.alias("@graph"))), F.lit("</script>")
    )
    return table(spark, sf, "pages").select("page_id", F.concat("html", script).alias("html"))


@query(
    "page_listings",
    """WITH l AS (SELECT page_id AS page, unnest(regexp_extract_all(html, '<a href="([^"]*)">', 1)) AS url,
      generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)">', 1), 1) - 1 AS pos FROM pages)
    SELECT page, CAST(pos AS INTEGER) AS pos, 'Job at ' || url AS title, url FROM l WHERE url != ''
    QUALIFY row_number() OVER (PARTITION BY url ORDER BY page, pos) = 1""",
)
def page_listings(spark, sf):
    return web_pages.listings(listing_pages(spark, sf), "html", "page_id")


@query(
    "page_postings",
    """SELECT url AS source_url, 'Job ' || page_id AS title,
      CASE page_id % 4 WHEN 0 THEN 'Entry level' WHEN 1 THEN 'Junior' WHEN 2 THEN 'Mid level' END AS seniority
    FROM pages WHERE page_id % 3 != 2""",
)
def page_postings(spark, sf):
    labels = F.get(
        F.array(*[F.lit(v) for v in ("Entry level", "Junior", "Mid level", "Expert")]),
        (F.col("page_id") % 4).cast("int"),
    )
    kind = F.when(F.col("page_id") % 3 == 2, "Organization").otherwise("JobPosting")
    node = F.struct(kind.alias("@type"), F.concat(F.lit("Job "), "page_id").alias("title"))
    box = '<div class="d-flex align-items-start gap-sm"><i class="fa-regular fa-trophy"></i><span>'
    page = F.concat(
        F.lit('<div id="main"><div class="x"><p>Intro<br></div>' + box),
        labels,
        F.lit("</span></div></div>" + box + "Junior</span></div>"),
        F.lit('<script type="application/ld+json">'),
        F.to_json(F.struct(F.array(node).alias("@graph"))),
        F.lit("</script>"),
        "html",
    )
    pages = table(spark, sf, "pages").select("url", page.alias("html"))
    found = web_pages.postings(pages, "html", "url")
    title = F.try_variant_get(F.try_parse_json("payload"), "$.title", "string")
    label = F.try_variant_get(F.try_parse_json("payload"), "$.seniority", "string")
    return found.select("source_url", title.alias("title"), label.alias("seniority"))


@query(
    "title_bucket",
    """SELECT CASE WHEN p_name ILIKE '%red%ring%' THEN 'red ring' WHEN p_name ILIKE '%ring%' OR p_name ILIKE '%bolt%'
      THEN 'fastener' ELSE 'no_match' END AS bucket, count(*) AS n FROM part GROUP BY ALL""",
)
def title_bucket(spark, sf):
    bucket = rules.bucket_by_ilike(
        "p_name", [("red ring", ["%red%ring%"]), ("fastener", ["%ring%", "%bolt%"])], "no_match"
    )
    return agg.bucket_counts(table(spark, sf, "part"), bucket)


@query(
    "exclude_titles",
    """SELECT p_partkey, p_name FROM part
    WHERE NOT regexp_matches(lower(p_name), '(red|steel|widget)')""",
)
def exclude_titles(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", "p_name")
    return flt.exclude_titles(rows, "p_name", ["red", "steel", "widget"])


@query(
    "keyword_matrix",
    """SELECT p_type, count(*) AS total, count(*) FILTER (regexp_matches(lower(p_name), '\\bred\\b')) AS has_red,
      count(*) FILTER (regexp_matches(lower(p_name), 'ring|bolt')) AS has_fastener,
      count(*) FILTER (NOT regexp_matches(lower(p_name), 'red|ring|bolt')) AS none FROM part GROUP BY ALL""",
)
def keyword_matrix(spark, sf):
    patterns = {"has_red": r"\bred\b", "has_fastener": "ring|bolt"}
    return profiling.keyword_matrix(
        table(spark, sf, "part"), "p_name", patterns, ["p_type"], ("none", "red|ring|bolt")
    )


@query(
    "malformed_flags",
    "SELECT p_partkey, regexp_matches(lower(p_name), '^(red|owner$)') AS is_malformed FROM part",
)
def malformed_flags(spark, sf):
    flagged = flt.flag_regex(table(spark, sf, "part"), "p_name", "^(red|owner$)", "is_malformed")
    return flagged.select("p_partkey", "is_malformed")


@query(
    "stack_class",
    """SELECT CASE WHEN list_has_any(string_split(lower(p_name), ' '), ['red', 'blue']) THEN 'modern'
      WHEN list_has_any(string_split(lower(p_name), ' '), ['ring', 'bolt']) THEN 'traditional' ELSE 'neither' END
      AS stack_type, count(*) AS n FROM part GROUP BY ALL""",
)
def stack_class(spark, sf):
    words = F.split("p_name", " ")
    label = arrays.classify_by_sets(words, [("modern", ["red", "blue"]), ("traditional", ["ring", "bolt"])], "neither")
    return agg.bucket_counts(table(spark, sf, "part"), label, "stack_type")


# -- counts and statistics ---------------------------------------------------------------


@query("role_counts", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY ALL")
def role_counts(spark, sf):
    return agg.counts(table(spark, sf, "orders"), ["o_orderstatus"])


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "role_source_crosstab",
    "SELECT o_orderstatus, "
    + ", ".join(f"count(*) FILTER (o_orderpriority = '{p}') AS \"{p}\"" for p in PRIORITIES)
    + " FROM orders GROUP BY ALL",
)
def role_source_crosstab(spark, sf):
    return agg.crosstab(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority", PRIORITIES)


@query(
    "row_pct",
    "SELECT o_orderstatus, "
    + ", ".join(
        f"round_even(count(*) FILTER (o_orderpriority = '{p}')::DOUBLE / count(*), 3) AS \"{p}\"" for p in PRIORITIES
    )
    + " FROM orders GROUP BY ALL",
)
def row_pct(spark, sf):
    return agg.crosstab_pct(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority", PRIORITIES, 3)


@query(
    "crosstab_by_total",
    "SELECT l_suppkey, "
    + ", ".join(f"count(*) FILTER (l_returnflag = '{v}') AS \"{v}\"" for v in ("A", "N", "R"))
    + " FROM lineitem GROUP BY ALL",
)
def crosstab_by_total(spark, sf):
    pivot = agg.crosstab(table(spark, sf, "lineitem"), "l_suppkey", "l_returnflag", ["A", "N", "R"])
    return agg.order_by_total(pivot, "l_suppkey")


@query(
    "share_in_group",
    """SELECT o_orderstatus, o_orderpriority, n, round(n / sum(n) OVER (PARTITION BY o_orderstatus), 6) AS pct
    FROM (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL)""",
)
def share_in_group(spark, sf):
    counted = agg.counts(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])
    return agg.share(counted, "o_orderstatus").withColumn("pct", F.round("pct", 6))


@query(
    "complete_grid",
    """WITH v AS (SELECT unnest(['A', 'N', 'R', 'X']) AS l_returnflag), k AS (SELECT DISTINCT l_suppkey FROM lineitem)
    SELECT l_suppkey, v.l_returnflag, count(l.l_suppkey) AS n FROM k CROSS JOIN v
    LEFT JOIN lineitem l USING (l_suppkey, l_returnflag) GROUP BY ALL""",
)
def complete_grid(spark, sf):
    return agg.complete_grid(table(spark, sf, "lineitem"), "l_suppkey", "l_returnflag", ["A", "N", "R", "X"])


@query(
    "distinct_counts",
    """SELECT count(DISTINCT o_custkey) AS o_custkey, count(DISTINCT o_orderpriority) AS o_orderpriority,
      count(DISTINCT o_orderdate) AS o_orderdate FROM orders""",
)
def distinct_counts(spark, sf):
    return agg.distinct_counts(table(spark, sf, "orders"), ["o_custkey", "o_orderpriority", "o_orderdate"])


@query(
    "median_by_key",
    """SELECT l_returnflag, l_linestatus, round(median(l_extendedprice), 4) AS median, count(*) AS n
    FROM lineitem GROUP BY ALL""",
)
def median_by_key(spark, sf):
    result = agg.median_n(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice")
    return result.withColumn("median", F.round("median", 4))


@query(
    "stats5_by_key",
    """SELECT o_orderstatus, round(median(o_totalprice), 2) AS median, count(*) AS n, min(o_totalprice) AS min,
      max(o_totalprice) AS max, round(stddev_samp(o_totalprice), 2) AS std FROM orders GROUP BY ALL""",
)
def stats5_by_key(spark, sf):
    result = agg.stats5(table(spark, sf, "orders"), ["o_orderstatus"], "o_totalprice", None)
    return result.withColumn("median", F.round("median", 2)).withColumn("std", F.round("std", 2))


@query(
    "describe_by_key",
    """SELECT o_orderpriority, count(*) AS count, round(avg(o_totalprice), 2) AS mean,
      round(stddev_samp(o_totalprice), 2) AS std, round(min(o_totalprice), 2) AS min,
      round(quantile_cont(o_totalprice, 0.25), 2) AS q25, round(median(o_totalprice), 2) AS median,
      round(quantile_cont(o_totalprice, 0.75), 2) AS q75, round(max(o_totalprice), 2) AS max
    FROM orders GROUP BY ALL""",
)
def describe_by_key(spark, sf):
    result = agg.describe_by(table(spark, sf, "orders"), ["o_orderpriority"], "o_totalprice")
    names = [c for c in result.columns if c not in ("o_orderpriority", "count")]
    return result.select("o_orderpriority", "count", *[F.round(c, 2).alias(c) for c in names])


@query(
    "describe_overall",
    """SELECT count(*) AS count, round(avg(l_quantity), 4) AS mean, round(stddev_samp(l_quantity), 4) AS std,
      min(l_quantity) AS min, quantile_cont(l_quantity, 0.25) AS q25, median(l_quantity) AS median,
      quantile_cont(l_quantity, 0.75) AS q75, max(l_quantity) AS max FROM lineitem""",
)
def describe_overall(spark, sf):
    result = agg.describe_by(table(spark, sf, "lineitem"), [], "l_quantity")
    return result.withColumn("mean", F.round("mean", 4)).withColumn("std", F.round("std", 4))


@query(
    "medians_by_key",
    """SELECT l_shipmonth, round(median(l_quantity), 4) AS l_quantity, round(median(l_extendedprice), 4) AS l_extendedprice
    FROM (SELECT month(l_shipdate) AS l_shipmonth, * FROM lineitem) GROUP BY ALL""",
)
def medians_by_key(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("l_shipmonth", F.month("l_shipdate").cast("bigint"))
    result = agg.medians(rows, ["l_shipmonth"], ["l_quantity", "l_extendedprice"], store_at=workspace(spark))
    return result.select(
        "l_shipmonth", *[F.round(c, 4).alias(c) for c in ("l_quantity", "l_extendedprice")]
    )


@query(
    "box_summary",
    """SELECT o_orderpriority, count(*) AS count, round(min(o_totalprice), 4) AS min,
      round(quantile_cont(o_totalprice, 0.25), 4) AS q25, round(median(o_totalprice), 4) AS median,
      round(quantile_cont(o_totalprice, 0.75), 4) AS q75, round(max(o_totalprice), 4) AS max
    FROM orders WHERE o_totalprice <= 300000 GROUP BY ALL HAVING count(*) >= 10""",
)
def box_summary(spark, sf):
    result = agg.box_summary(table(spark, sf, "orders"), "o_orderpriority", "o_totalprice", 10, 300_000)
    names = ["min", "q25", "median", "q75", "max"]
    return result.select("o_orderpriority", "count", *[F.round(c, 4).alias(c) for c in names])


@query(
    "bool_rate",
    """SELECT source, count(*) FILTER (quality = 1) AS yes, count(*) AS total,
      round(count(*) FILTER (quality = 1)::DOUBLE / count(*), 6) AS rate
    FROM documents LEFT JOIN labels USING (doc_id) GROUP BY ALL""",
)
def bool_rate(spark, sf):
    rows = joins.attach(table(spark, sf, "documents"), table(spark, sf, "labels"), ["doc_id"])
    return agg.bool_rate(rows, F.col("quality") == 1, ["source"]).withColumn("rate", F.round("rate", 6))


@query(
    "agreement_rate",
    """SELECT source, count(*) FILTER (quality = toxic) AS agree, count(*) AS total,
      round(count(*) FILTER (quality = toxic)::DOUBLE / count(*), 6) AS rate
    FROM documents JOIN labels USING (doc_id) GROUP BY ALL""",
)
def agreement_rate(spark, sf):
    rows = joins.attach(table(spark, sf, "documents"), table(spark, sf, "labels"), ["doc_id"])
    result = agg.agreement(rows, "quality", "toxic", ["source"], normalise=False)
    return result.withColumn("rate", F.round("rate", 6))


@query(
    "role_key_agreement",
    """SELECT count(*) FILTER (replace(replace(lower(p_name), ' ', '_'), '-', '_') = lower(p_type)) AS agree,
      count(*) AS total, round(count(*) FILTER (replace(lower(p_name), ' ', '_') = lower(p_type))::DOUBLE / count(*), 6)
      AS rate FROM part""",
)
def role_key_agreement(spark, sf):
    return agg.agreement(table(spark, sf, "part"), "p_name", "p_type").withColumn("rate", F.round("rate", 6))


@query(
    "divergent_labels",
    """SELECT event_type, k, count(*) AS n FROM (SELECT event_type, CASE WHEN value > 20 THEN 'view' ELSE 'click' END AS k
      FROM events) WHERE k IS DISTINCT FROM CASE event_type WHEN 'purchase' THEN 'view' WHEN 'click' THEN 'click' END
    GROUP BY ALL""",
)
def divergent_labels(spark, sf):
    rows = table(spark, sf, "events").withColumn("k", F.when(F.col("value") > 20, "view").otherwise("click"))
    return agg.divergent(rows, "event_type", "k", map_values("event_type", {"purchase": "view", "click": "click"}))


@query(
    "distribution_with_null",
    """WITH r AS (SELECT quality FROM documents LEFT JOIN labels USING (doc_id))
    SELECT quality AS value, count(*) AS n, round_even(100.0 * count(*) / (SELECT count(*) FROM r), 1)::DOUBLE AS pct
    FROM r GROUP BY ALL""",
)
def distribution_with_null(spark, sf):
    rows = joins.attach(table(spark, sf, "documents"), table(spark, sf, "labels"), ["doc_id"])
    return agg.distribution(rows, "quality")


@query(
    "rounded_hist",
    "SELECT round_even(l_discount, 1) AS bucket, count(*) AS n FROM lineitem GROUP BY ALL",
)
def rounded_hist(spark, sf):
    return agg.rounded_hist(table(spark, sf, "lineitem"), "l_discount", 1)


@query(
    "histogram_fixed",
    """SELECT bin, CAST(bin * 5.0 AS DOUBLE) AS bin_start, count(*) AS n FROM (
      SELECT least(CAST(floor(value / 5.0) AS BIGINT), 19) AS bin FROM events WHERE value BETWEEN 0 AND 100)
    GROUP BY ALL""",
)
def histogram_fixed(spark, sf):
    return agg.fixed_hist(table(spark, sf, "events"), "value", 0.0, 100.0, 20)


@query(
    "hit_rate",
    """SELECT source, count(*) AS total, count(quality) AS filled,
      round_even(100.0 * count(quality) / count(*), 1)::DOUBLE AS hit_rate_pct
    FROM documents LEFT JOIN labels USING (doc_id) GROUP BY ALL""",
)
def hit_rate(spark, sf):
    rows = joins.attach(table(spark, sf, "documents"), table(spark, sf, "labels"), ["doc_id"])
    return agg.hit_rate(rows, "quality", "source")


@query(
    "cumulative_by_group",
    """SELECT day, event_type, n, CAST(sum(n) OVER (PARTITION BY event_type ORDER BY day) AS BIGINT) AS cumulative
    FROM (SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY ALL)""",
)
def cumulative_by_group(spark, sf):
    return agg.cumulative(table(spark, sf, "events"), "ts", ["event_type"])


@query(
    "trend_total",
    """SELECT day, n, CAST(sum(n) OVER (ORDER BY day) AS BIGINT) AS cumulative
    FROM (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY ALL)""",
)
def trend_total(spark, sf):
    return agg.cumulative(table(spark, sf, "orders"), "o_orderdate")


@query(
    "weekly_trend_start",
    "SELECT CAST(date_trunc('week', ts) AS DATE) AS week, count(*) AS n FROM events GROUP BY ALL",
)
def weekly_trend_start(spark, sf):
    return agg.weekly_trend(table(spark, sf, "events"), dates.week_start("ts"))


@query(
    "weekly_trend_end_filled",
    """WITH w AS (SELECT o_custkey, CAST(date_trunc('week', o_orderdate) AS DATE) + 6 AS week, count(*) AS n FROM orders GROUP BY ALL),
    g AS (SELECT o_custkey, CAST(unnest(generate_series(min(week), max(week), INTERVAL 7 DAY)) AS DATE) AS week FROM w GROUP BY o_custkey)
    SELECT o_custkey, week, coalesce(n, 0) AS n FROM g LEFT JOIN w USING (o_custkey, week)""",
)
def weekly_trend_end_filled(spark, sf):
    # Customers order in few of their weeks, so most weeks of a customer are filled in.
    return agg.weekly_trend(table(spark, sf, "orders"), dates.week_end("o_orderdate"), fill=True, by=["o_custkey"])


# -- ranking -----------------------------------------------------------------------------

TOKENS = "(SELECT source, lang, unnest(string_split(lower(text), ' ')) AS value FROM documents)"


@query(
    "topk_tokens",
    f"SELECT value, count(*) AS n FROM {TOKENS} GROUP BY ALL ORDER BY n DESC, value LIMIT 20",
)
def topk_tokens(spark, sf):
    return ranking.topk(table(spark, sf, "documents"), F.split(F.lower("text"), " "), 20)


@query(
    "topk_tokens_by_group",
    f"""SELECT lang, value, n, CAST(row_number() OVER (PARTITION BY lang ORDER BY n DESC, value) AS INTEGER) AS rank
    FROM (SELECT lang, value, count(*) AS n FROM {TOKENS} GROUP BY ALL) QUALIFY rank <= 10""",
)
def topk_tokens_by_group(spark, sf):
    return ranking.topk_by(table(spark, sf, "documents"), F.split(F.lower("text"), " "), "lang", 10)


@query(
    "token_heatmap",
    "SELECT value, "
    + ", ".join(f"count(*) FILTER (source = 'src{i}') AS src{i}" for i in range(20))
    + f""", count(*) AS total FROM {TOKENS} WHERE source IS NOT NULL
    GROUP BY value ORDER BY total DESC, value LIMIT 20""",
)
def token_heatmap(spark, sf):
    sources = [f"src{i}" for i in range(20)]
    return ranking.heatmap(table(spark, sf, "documents"), F.split(F.lower("text"), " "), "source", sources, 20)


@query(
    "topk_composition",
    """WITH top AS (SELECT p_brand FROM part GROUP BY 1 ORDER BY count(*) DESC, p_brand LIMIT 4)
    SELECT p_brand, p_type, count(*) AS n FROM part WHERE p_brand IN (SELECT p_brand FROM top) GROUP BY ALL""",
)
def topk_composition(spark, sf):
    return ranking.topk_composition(table(spark, sf, "part"), "p_brand", "p_type", 4)


@query("facet_values", "SELECT p_brand AS value, count(*) AS n FROM part GROUP BY ALL")
def facet_values(spark, sf):
    return ranking.facet_values(table(spark, sf, "part"), "p_brand", by_frequency=True)


@query(
    "volume_rank",
    """SELECT value, n, CAST(row_number() OVER (ORDER BY n DESC, value) AS INTEGER) AS rank
    FROM (SELECT p_brand AS value, count(*) AS n FROM part GROUP BY ALL)""",
)
def volume_rank(spark, sf):
    return ranking.volume_rank(table(spark, sf, "part"), "p_brand")


@query(
    "latest_row_per_customer",
    """SELECT o_custkey, o_orderkey, o_orderdate FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def latest_row_per_customer(spark, sf):
    rows = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return ranking.latest_row(rows, ["o_custkey"], "o_orderdate", ["o_orderkey"])


@query(
    "ordered_work_list",
    "SELECT source, doc_id FROM documents ORDER BY source, doc_id",
)
def ordered_work_list(spark, sf):
    return ranking.ordered(table(spark, sf, "documents").select("source", "doc_id"), ["source", "doc_id"])


# -- filters -----------------------------------------------------------------------------

EXPLORER = flt.ExplorerSpec(
    facets={"c_mktsegment": ["BUILDING", "MACHINERY"], "o_orderpriority": ["1-URGENT", "5-LOW"]},
    required=["o_totalprice"],
    ranges=[("o_totalprice", "high", 50_000, 250_000)],
    recent=("day", 1500),
    search=(["c_name", "o_orderstatus"], "00[1-5]|f"),
)
EXPLORER_ROWS = """FROM customer JOIN orders ON c_custkey = o_custkey"""
EXPLORER_SQL = """c_mktsegment IN ('BUILDING', 'MACHINERY') AND o_orderpriority IN ('1-URGENT', '5-LOW')
  AND o_totalprice IS NOT NULL AND o_totalprice + 10000 >= 50000 AND o_totalprice <= 250000
  AND CAST(o_orderdate AS DATE) >= DATE '1998-12-31' - 1500 AND CAST(o_orderdate AS DATE) < DATE '1999-01-01'
  AND (regexp_matches(lower(c_name), '00[1-5]|f') OR regexp_matches(lower(o_orderstatus), '00[1-5]|f'))"""


def customer_orders(spark, sf):
    orders = table(spark, sf, "orders").withColumn("day", F.to_date("o_orderdate"))
    orders = orders.withColumn("high", F.col("o_totalprice") + 10_000)
    return table(spark, sf, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"))


@query("explorer_filter", f"SELECT o_orderkey, c_name, o_totalprice {EXPLORER_ROWS} WHERE {EXPLORER_SQL}")
def explorer_filter(spark, sf):
    predicate = flt.explorer_predicate(EXPLORER, F.lit("1998-12-31").cast("date"))
    return customer_orders(spark, sf).where(predicate).select("o_orderkey", "c_name", "o_totalprice")


@query(
    "explorer_summary",
    f"SELECT count(*) AS total, count(*) FILTER ({EXPLORER_SQL}) AS filtered {EXPLORER_ROWS}",
)
def explorer_summary(spark, sf):
    return flt.explorer_summary(customer_orders(spark, sf), EXPLORER, F.lit("1998-12-31").cast("date"))


@query(
    "publisher_deny_list",
    """SELECT s_nationkey, count(*) AS n FROM supplier WHERE s_name NOT IN ('Supplier#000000001', 'Supplier#000000002')
      AND s_nationkey IN (1, 2, 3, 4, 5) GROUP BY ALL""",
)
def publisher_deny_list(spark, sf):
    spec = flt.SearchSpec(
        deny={"s_name": ["Supplier#000000001", "Supplier#000000002"]}, allow={"s_nationkey": [1, 2, 3, 4, 5]}
    )
    found = flt.search(table(spark, sf, "supplier"), spec, newest_first=False)
    return found.groupBy("s_nationkey").agg(F.count("*").alias("n"))


@query(
    "drop_value_keep_null",
    """SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id) WHERE quality != 1 OR quality IS NULL""",
)
def drop_value_keep_null(spark, sf):
    rows = joins.attach(table(spark, sf, "documents"), table(spark, sf, "labels"), ["doc_id"])
    return flt.drop_value_keep_null(rows.select("doc_id", "quality"), "quality", 1)


@query("outliers", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 400000")
def outliers(spark, sf):
    return flt.outliers(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 400_000)


@query(
    "min_group_size",
    """SELECT user_id, count(*) AS n FROM events GROUP BY ALL HAVING count(*) >= 70""",
)
def min_group_size(spark, sf):
    rows = flt.min_group_size(table(spark, sf, "events"), "user_id", 70)
    return rows.groupBy("user_id").agg(F.count("*").alias("n"))


@query(
    "backfill_candidates",
    """SELECT event_id, ts FROM events WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) >= 50""",
)
def backfill_candidates(spark, sf):
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
    rows = table(spark, sf, "events").select("event_id", "ts", F.when(k < 50, k).alias("k"))
    return flt.backfill_candidates(rows, "k", "ts").select("event_id", "ts")


@query(
    "filled_by_fallback",
    """SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL AND n_chars IS NOT NULL""",
)
def filled_by_fallback(spark, sf):
    rows = joins.attach(table(spark, sf, "documents"), table(spark, sf, "labels"), ["doc_id"])
    return flt.filled_by_fallback(rows, "quality", "n_chars").select("doc_id")


@query(
    "excluded_count",
    "SELECT count(*) FILTER (o_orderstatus = 'P') AS n_excluded FROM orders",
)
def excluded_count(spark, sf):
    return flt.exclude_value(table(spark, sf, "orders"), "o_orderstatus", "P")[1]


# -- overlays ----------------------------------------------------------------------------


@query(
    "overlay_values",
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'PATCHED' ELSE c_mktsegment END AS c_mktsegment FROM customer""",
)
def overlay_values(spark, sf):
    customers = table(spark, sf, "customer")
    rows = customers.select("c_custkey", "c_mktsegment")
    patch = customers.where("c_acctbal < 0").select("c_custkey", F.lit("PATCHED").alias("c_mktsegment"))
    return overlay.overlay(rows, patch, "c_custkey", ["c_mktsegment"])


@query(
    "flag_corrections",
    """SELECT doc_id, CASE WHEN lang = 'fr' THEN 0 ELSE toxic END AS toxic FROM labels LEFT JOIN documents USING (doc_id)""",
)
def flag_corrections(spark, sf):
    ids = table(spark, sf, "documents").where("lang = 'fr'").select("doc_id")
    rows = table(spark, sf, "labels").select("doc_id", "toxic")
    return overlay.set_by_ids(rows, ids, "doc_id", "toxic", F.lit(0))


@query("deleted_by_ids", "SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey = 3)")
def deleted_by_ids(spark, sf):
    ids = table(spark, sf, "customer").where("c_nationkey = 3").select(F.col("c_custkey").alias("o_custkey"))
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return overlay.delete_by_ids(rows, ids, "o_custkey").select("o_orderkey")


# -- profiles and quality ----------------------------------------------------------------


@query(
    "null_rates",
    """WITH r AS (SELECT doc_id, quality, toxic FROM documents LEFT JOIN labels USING (doc_id))
    SELECT 'doc_id' AS "column", round(1 - count(doc_id)::DOUBLE / count(*), 6) AS null_rate FROM r
    UNION ALL SELECT 'quality', round(1 - count(quality)::DOUBLE / count(*), 6) FROM r
    UNION ALL SELECT 'toxic', round(1 - count(toxic)::DOUBLE / count(*), 6) FROM r""",
)
def null_rates(spark, sf):
    rows = joins.attach(table(spark, sf, "documents"), table(spark, sf, "labels"), ["doc_id"])
    rates = profiling.null_rates(rows, ["doc_id", "quality", "toxic"])
    return rates.withColumn("null_rate", F.round("null_rate", 6))


@query(
    "empty_array_rates",
    """SELECT 'words' AS "column", round(avg(CASE WHEN p_name LIKE '%red%' THEN 0 ELSE 1 END), 6) AS empty_rate FROM part""",
)
def empty_array_rates(spark, sf):
    words = F.filter(F.split("p_name", " "), lambda w: w.contains("red"))
    rates = profiling.empty_rates(table(spark, sf, "part").withColumn("words", words), ["words"])
    return rates.withColumn("empty_rate", F.round("empty_rate", 6))


@query(
    "column_profile",
    """WITH r AS (SELECT source, lang, quality FROM documents LEFT JOIN labels USING (doc_id))
    SELECT source, 'lang' AS "column", count(lang) AS non_null, count(*) AS total,
      round_even(100.0 * count(lang) / count(*), 1)::DOUBLE AS population_pct, min(lang) AS sample FROM r GROUP BY source
    UNION ALL SELECT source, 'quality', count(quality), count(*),
      round_even(100.0 * count(quality) / count(*), 1)::DOUBLE, CAST(min(quality) AS VARCHAR) FROM r GROUP BY source""",
)
def column_profile(spark, sf):
    rows = joins.attach(table(spark, sf, "documents"), table(spark, sf, "labels"), ["doc_id"])
    return profiling.column_profile(rows.select("source", "lang", "quality"), "source")


@query(
    "text_audit",
    """SELECT lang, count(*) AS total, count(text) AS present, count(*) FILTER (text IS NULL OR text = '') AS missing,
      round(avg(length(text)), 4) AS avg_length, CAST(min(length(text)) AS INTEGER) AS min_length,
      CAST(max(length(text)) AS INTEGER) AS max_length FROM documents GROUP BY ALL""",
)
def text_audit(spark, sf):
    result = profiling.text_audit(table(spark, sf, "documents"), "text", ["lang"])
    return result.withColumn("avg_length", F.round("avg_length", 4))


@query(
    "blank_audit",
    """SELECT role, count(*) FILTER (text = '') AS blank, count(*) FILTER (text != '') AS non_blank,
      count(*) FILTER (text IS NULL) AS missing FROM conversations GROUP BY ALL""",
)
def blank_audit(spark, sf):
    return profiling.blank_audit(table(spark, sf, "conversations"), "text", ["role"])


@query(
    "presence_audit",
    """SELECT l_returnflag, count(*) AS total, count(*) FILTER (l_discount > 0) AS discounted,
      count(*) FILTER (l_tax = 0) AS untaxed,
      round_even(100.0 * count(*) FILTER (l_discount > 0) / count(*), 1)::DOUBLE AS discounted_pct,
      round_even(100.0 * count(*) FILTER (l_tax = 0) / count(*), 1)::DOUBLE AS untaxed_pct
    FROM lineitem GROUP BY ALL""",
)
def presence_audit(spark, sf):
    conditions = {"discounted": F.col("l_discount") > 0, "untaxed": F.col("l_tax") == 0}
    return profiling.presence_audit(table(spark, sf, "lineitem"), conditions, ["l_returnflag"])


@query(
    "tristate_audit",
    """WITH r AS (SELECT source, quality = 1 AS good, CASE WHEN doc_id % 2 = 0 THEN n_chars END AS size
      FROM documents LEFT JOIN labels USING (doc_id))
    SELECT source, count(*) AS total, count(*) FILTER (good) AS good_true, count(*) FILTER (NOT good) AS good_false,
      count(*) FILTER (good IS NULL) AS good_null, count(*) FILTER (good AND size IS NOT NULL) AS good_true_with_size,
      count(*) FILTER (NOT good AND size IS NOT NULL) AS good_false_with_size FROM r GROUP BY ALL""",
)
def tristate_audit(spark, sf):
    rows = joins.attach(table(spark, sf, "documents"), table(spark, sf, "labels"), ["doc_id"]).select(
        "source",
        (F.col("quality") == 1).alias("good"),
        F.when(F.col("doc_id") % 2 == 0, F.col("n_chars")).alias("size"),
    )
    return profiling.tristate_audit(rows, ["good"], ["source"], "size")


@query(
    "dq_rules",
    """SELECT rule, "column", failures, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM (
      SELECT 'unique' AS rule, 'o_custkey' AS "column",
        (SELECT count(*) FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1)) AS failures
      UNION ALL SELECT 'unique', 'o_orderkey',
        (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1))
      UNION ALL SELECT 'not_null', 'o_orderdate', count(*) FILTER (o_orderdate IS NULL) FROM orders
      UNION ALL SELECT 'accepted_values', 'o_orderstatus', count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) FROM orders)""",
)
def dq_rules(spark, sf):
    return quality.run_rules(
        table(spark, sf, "orders"),
        [
            quality.Unique("o_custkey"),
            quality.Unique("o_orderkey"),
            quality.NotNull("o_orderdate"),
            quality.Accepted("o_orderstatus", ["F", "O"]),
        ],
    )


@query(
    "dq_failing_rows",
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('F', 'O')",
)
def dq_failing_rows(spark, sf):
    bad = quality.failing_rows(table(spark, sf, "orders"), quality.Accepted("o_orderstatus", ["F", "O"]))
    return bad.select("o_orderkey", "o_orderstatus")


@query(
    "dq_freshness",
    """SELECT event_type, max(ts) AS latest,
      round(floor(epoch(TIMESTAMP '2024-02-03 06:00:00') - floor(epoch(max(ts)))) / 3600.0, 6) AS age_hours,
      CASE WHEN floor(epoch(TIMESTAMP '2024-02-03 06:00:00') - floor(epoch(max(ts)))) / 3600.0 > 144 THEN 'error'
        WHEN floor(epoch(TIMESTAMP '2024-02-03 06:00:00') - floor(epoch(max(ts)))) / 3600.0 > 72 THEN 'warn'
        ELSE 'pass' END AS status FROM events GROUP BY ALL""",
)
def dq_freshness(spark, sf):
    rule = quality.Freshness("ts", as_of=F.lit("2024-02-03 06:00:00").cast("timestamp"))
    result = quality.freshness(table(spark, sf, "events"), rule, ["event_type"])
    return result.withColumn("age_hours", F.round("age_hours", 6))


@query(
    "copy_counts",
    """SELECT 'orders' AS "table", count(*) AS old, count(*) AS new, 'ok' AS status FROM orders
    UNION ALL SELECT 'labels', (SELECT count(*) FROM labels), (SELECT count(*) FROM labels WHERE quality = 1), 'mismatch'""",
)
def copy_counts(spark, sf):
    orders, labels = table(spark, sf, "orders"), table(spark, sf, "labels")
    return quality.count_check([("orders", orders, orders), ("labels", labels, labels.where("quality = 1"))])


ORDER_ROW = """'{"o_custkey":' || o_custkey || ',"o_orderdate":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f')
      || '","o_orderkey":' || o_orderkey || ',"o_orderpriority":"' || o_orderpriority || '","o_orderstatus":"' || o_orderstatus || '"}'"""
LABEL_ROW = """'{"doc_id":' || doc_id || ',"quality":' || coalesce(CAST(quality AS VARCHAR), 'null')
      || ',"toxic":' || coalesce(CAST(toxic AS VARCHAR), 'null') || '}'"""


def digest_sql(name, row, source):
    halves = " || '-' || ".join(
        f"CAST(coalesce(sum(CAST('0x' || substr(h, {at}, 16) AS UBIGINT)), 0) AS VARCHAR)" for at in (1, 17)
    )
    return f"{name} AS (SELECT count(*) AS n, {halves} AS digest FROM (SELECT md5({row}) AS h FROM {source}))"


@query(
    "copy_contents",
    "WITH "
    + ", ".join(
        [
            digest_sql("o", ORDER_ROW, "orders"),
            digest_sql("l", LABEL_ROW, "labels"),
            digest_sql("fewer", LABEL_ROW, "labels WHERE quality = 1"),
            digest_sql(
                "other", LABEL_ROW,
                """(SELECT doc_id, quality, CASE WHEN doc_id = (SELECT min(doc_id) FROM labels) THEN 1 - toxic ELSE toxic END AS toxic
                FROM labels)""",
            ),
        ]
    )
    + """ SELECT c.name AS "table", c.old, c.new, c.old_digest, c.new_digest, c.status FROM (
      SELECT 'orders' AS name, o.n AS old, o.n AS new, o.digest AS old_digest, o.digest AS new_digest, 'ok' AS status FROM o
      UNION ALL SELECT 'labels', l.n, fewer.n, l.digest, fewer.digest, 'mismatch' FROM l, fewer
      UNION ALL SELECT 'cells', l.n, other.n, l.digest, other.digest, 'changed' FROM l, other) AS c""",
)
def copy_contents(spark, sf):
    """A whole copy in another order, one with rows missing, one with a single other cell."""
    orders, labels = table(spark, sf, "orders").drop("o_totalprice"), table(spark, sf, "labels")
    first = labels.agg(F.min("doc_id").alias("m")).scalar()
    cell = F.when(F.col("doc_id") == first, 1 - F.col("toxic")).otherwise(F.col("toxic"))
    return quality.content_check(
        [
            ("orders", orders, orders.repartition("o_custkey").select(*reversed(orders.columns))),
            ("labels", labels, labels.where("quality = 1")),
            ("cells", labels, labels.withColumn("toxic", cell)),
        ]
    )


@query(
    "role_keys",
    "SELECT DISTINCT replace(replace(lower(p_name), ' ', '_'), '-', '_') AS key FROM part",
)
def role_keys(spark, sf):
    return table(spark, sf, "part").select(role_key("p_name").alias("key")).distinct()
