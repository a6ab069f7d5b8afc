"""Registered queries on reading and writing, upkeep columns, gates, policies and responses, each with its oracle SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import names, tables, text
from quern.operators import aggregates, curation, filters, joins, pairs, responses, review, rules, sampling, schema
from quern.operators.graph import shared_folder
from quern.plans.catalog import _DECIDED_SQL, _PAIR_ROWS, _STATE_SQL, _TYPES_SQL, _pairs, _proposed, _state, _typed, query
from quern.plans.records import over_records, records, table
from quern.sources import tables as sources

_TRIM = r"regexp_replace(coalesce({}, ''), '^\s+|\s+$', '', 'g')"


def _fresh(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# Reading and writing


@query("SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer")
def s5_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers written as lines of JSON and read back."""
    at, columns = _fresh(spark, "json"), ["c_custkey", "c_name", "c_mktsegment", "c_acctbal"]
    table(spark, sf_dir, "customer").select(*columns).write.json(at)
    return sources.scan_json(spark, at, "c_custkey long, c_name string, c_mktsegment string, c_acctbal double")


@query("SELECT page_id, url, md5(html) AS digest FROM pages")
def s5_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as arrays of objects, one on a line of its own in each file, and read back."""
    at = _fresh(spark, "array")
    rows = F.array_join(F.collect_list(F.to_json(F.struct("page_id", "url", "html"))), ", ")
    table(spark, sf_dir, "pages").groupBy(F.floor(F.col("page_id") / 100).alias("file")).agg(F.concat(F.lit("["), rows, F.lit("]")).alias("value")).select("value").write.text(at)
    return sources.scan_json(spark, at, "page_id long, url string, html string", "array").select("page_id", "url", F.md5("html").alias("digest"))


@query("SELECT 'page \"' || page_id || '\" {' AS name, page_id, url, md5(html) AS digest FROM pages")
def s5_json_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as objects of objects, by names that need escapes, and read back."""
    at = _fresh(spark, "object")
    name = F.concat(F.lit('"page \\"'), F.col("page_id").cast("string"), F.lit('\\" {": '))
    rows = F.array_join(F.collect_list(F.concat(name, F.to_json(F.struct("page_id", "url", "html")))), ",\n ")
    table(spark, sf_dir, "pages").groupBy(F.floor(F.col("page_id") / 100).alias("file")).agg(F.concat(F.lit("{"), rows, F.lit("}")).alias("value")).select("value").write.text(at)
    return sources.scan_json(spark, at, "page_id long, url string, html string", "object", "name").select("name", "page_id", "url", F.md5("html").alias("digest"))


@query(r"SELECT CAST(doc_id AS VARCHAR) AS doc_id, coalesce(lang, '') AS lang, md5(coalesce(regexp_replace(text, '\r\n?', chr(10), 'g'), '')) AS digest FROM documents WHERE doc_id % 2 = 0 OR lang = 'en'")
def s1_s12_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A filtered view of whole texts exported as CSV and scanned again; line ends come back as one kind."""
    at = _fresh(spark, "csv")
    sources.export_csv(table(spark, sf_dir, "documents").filter("doc_id % 2 = 0 or lang = 'en'").select(F.col("doc_id").cast("string"), "lang", "text"), at)
    return sources.scan_text(spark, at, ["doc_id", "lang", "text"]).select("doc_id", "lang", F.md5(F.regexp_replace("text", r"\r\n?", "\n")).alias("digest"))


@query("SELECT CAST(user_id AS VARCHAR) AS key, min(event_id) AS pos FROM events GROUP BY user_id")
def s4_requested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys from a table of requests with repeats, each once, in the order of its first request."""
    lines = table(spark, sf_dir, "events").select(F.concat(F.lit(" "), F.col("user_id").cast("string")).alias("key"), "event_id")
    return sources.requested_from(lines, "key", "event_id")


@query("SELECT c_custkey, CAST(c_custkey % 5 AS INT) AS mark FROM customer WHERE c_custkey % 2 = 1")
def s7_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of three writes the first stays as it is and the last is current."""
    at, rows = _fresh(spark, "versions"), table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") % 5).cast("int").alias("mark"))
    sources.write_first(rows, at, "1")
    sources.write_first(rows.limit(0), at, "1")
    sources.write_version(rows.filter("c_custkey % 2 = 1"), at, "2")
    return sources.current(spark, at)


@query(over_records("SELECT row_id, pmid, species, title FROM rec WHERE species = ''"))
def s9_residual_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.residual_queue(records(spark, sf_dir), F.col("species") == "", ["row_id", "pmid", "species", "absent", "title"])


@query(over_records("""SELECT 'reviews' AS sheet, row_id, year, NULL AS species FROM rec WHERE paper_type = 'review'
    UNION ALL SELECT 'blank species', row_id, NULL, species FROM rec WHERE species = ''"""))
def s10_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    at, rows = _fresh(spark, "sheets"), records(spark, sf_dir)
    sources.write_sheets({"reviews": rows.filter("paper_type = 'review'").select("row_id", "year"), "blank species": rows.filter("species = ''").select("row_id", "species")}, at)
    read = spark.read.parquet(at).select("sheet", "row_id", "year", "species")
    return read.withColumn("species", F.when(F.col("sheet") == "blank species", F.coalesce("species", F.lit(""))))


_STRIPPED = "trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace({}, '<[^>]+>', ' ', 'g'), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&nbsp;', ' '), '\\s+', ' ', 'g'))"


@query(rf"""WITH s AS (SELECT page_id, unnest(string_split(regexp_replace(coalesce(html, ''), '(?i)(<h[1-6][\s>])', chr(1) || '\1', 'g'), chr(1))[2:]) AS p,
        generate_subscripts(string_split(regexp_replace(coalesce(html, ''), '(?i)(<h[1-6][\s>])', chr(1) || '\1', 'g'), chr(1))[2:], 1) AS i FROM pages),
    b AS (SELECT page_id, i, lower({_STRIPPED.format("regexp_extract(p, '(?is)^<h[1-6][^>]*>(.*?)</h[1-6]>', 1)")}) AS title,
        array_to_string(list_transform(regexp_extract_all(p, '(?is)<p[\s>].*?</p>'), lambda x: {_STRIPPED.format("x")}), ' ') AS body FROM s),
    k AS (SELECT *, CASE WHEN regexp_matches(title, '[%$*#]') THEN 'special' WHEN regexp_matches(title, '.') THEN 'plain' ELSE '' END AS kind FROM b)
    SELECT page_id, left(coalesce(string_agg(body, ' ' ORDER BY i) FILTER (WHERE kind = 'special'), ''), 10000) AS special,
        left(coalesce(string_agg(body, ' ' ORDER BY i) FILTER (WHERE kind = 'plain'), ''), 10000) AS plain FROM k WHERE body <> '' GROUP BY page_id HAVING bool_or(kind <> '')""")
def s6_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = sources.sections(table(spark, sf_dir, "pages"), block="p", limit=10_000, special=r"[%$*#]", plain=r".")
    return made.select("page_id", "special", "plain")


_ARTICLE = ("<article id=''{0}''><title>An article</title><sec><title>Materials and <i>methods</i></title><p>First {0}.</p><!-- <sec><p>no</p></sec> --><sec><title>Cells</title><p>Grown &amp; kept {1}.</p></sec>"
    "<sec><title>Findings {1}</title><p>Seen early.</p></sec><p>Last of methods.</p></sec><sec><title>{2}</title><sec><p>Nested <b>twice</b> {0}.</p></sec></sec></article>")


@query("""SELECT CAST(page_id AS VARCHAR) AS id, 'First ' || page_id || '. Grown & kept ' || page_id % 7 || '. Last of methods.' AS methods,
    'Seen early.' || CASE WHEN page_id % 2 = 0 THEN ' Nested twice ' || page_id || '.' ELSE '' END AS results FROM pages""")
def s6_nested_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles with sections in sections, many in a file, written and scanned again; a section without a kind has that of the one around it."""
    at, key = _fresh(spark, "articles"), F.col("page_id")
    text_ = _ARTICLE.replace("''", "'")
    for place, what in (("{0}", key), ("{1}", key % 7), ("{2}", F.when(key % 2 == 0, "Results").otherwise("Discussion"))):
        text_ = F.replace(F.lit(text_) if isinstance(text_, str) else text_, F.lit(place), what.cast("string"))
    table(spark, sf_dir, "pages").select(text_.alias("value")).write.text(at)
    found = sources.sections(sources.scan_articles(spark, at), methods="method", results="result|finding")
    return found.select(F.regexp_extract("html", "<article id='([0-9]+)'", 1).alias("id"), "methods", "results")


# Columns and scalars


@query(over_records("SELECT row_id, species AS species_raw, upper(species) AS species, '' AS manual_label, '' AS manual_notes FROM rec"))
def p2_p12_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = schema.snapshot(records(spark, sf_dir), ["species"]).withColumn("species", F.upper("species"))
    return schema.blank_columns(schema.snapshot(kept, ["species"]), ["manual_label", "manual_notes"]).select("row_id", "species_raw", "species", "manual_label", "manual_notes")


@query(over_records("""SELECT row_id, CASE source WHEN 'fulltext' THEN 'Full text' ELSE source END AS read_from, CASE WHEN species = '' THEN '' ELSE 'https://example.org/' || species || '/' END AS link FROM rec"""))
def p6_p7_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).select("row_id", text.label(F.col("source"), {"fulltext": "Full text", "absent": "x"}).alias("read_from"), text.url("https://example.org/", F.col("species")).alias("link"))


@query(over_records(f"""SELECT row_id, CASE WHEN source = 'fulltext' THEN 'used' WHEN held IS NOT NULL THEN 'cached' ELSE 'none' END AS fulltext_status FROM rec LEFT JOIN
    (SELECT DISTINCT CAST(doc_id % 500 AS VARCHAR) AS held FROM documents WHERE doc_id % 3 = 0 AND {_TRIM.format("text")} <> '') h ON pmid = held"""))
def p11_fulltext_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = F.when(F.col("doc_id") % 3 == 0, F.col("text")).otherwise(" \n")
    cached = table(spark, sf_dir, "documents").select((F.col("doc_id") % 500).cast("string").alias("pmid"), F.lit(None).cast("string").alias("methods_text"), whole.alias("results_text"))
    return schema.fulltext_status(records(spark, sf_dir), cached).select("row_id", "fulltext_status")


@query(f"""WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
    t AS (SELECT doc_id, {_TRIM.format("line")} AS line, min(i) AS i FROM l GROUP BY ALL)
    SELECT doc_id, count(*) FILTER (WHERE line <> '') AS lines, md5(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE line <> ''), '')) AS digest FROM t GROUP BY doc_id""")
def x21_unique_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = text.unique_in_order(F.split(F.coalesce("text", F.lit("")), "\n"))
    made = table(spark, sf_dir, "documents").select("doc_id", lines.alias("l"))
    return made.select("doc_id", F.size("l").cast("long").alias("lines"), F.md5(F.array_join("l", "\n")).alias("digest"))


_UNGIVEN = "CASE row_id % 4 WHEN 0 THEN ' Not Specified' WHEN 1 THEN '' WHEN 2 THEN 'unknown ' ELSE factors END"


@query(over_records(f"SELECT row_id, CASE WHEN row_id % 2 = 0 THEN 'not specified' WHEN row_id % 4 = 1 THEN '' ELSE factors END AS factors FROM rec"))
def x26_collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).select("row_id", text.collapse_unspecified(F.expr(_UNGIVEN)).alias("factors"))


@query("""SELECT l_orderkey, l_linenumber, CASE l_orderkey % 4 WHEN 0 THEN format('{:.8g}', l_extendedprice / 7) WHEN 1 THEN format('{:.8g}', l_extendedprice / 7e10)
    WHEN 2 THEN format('{:.8g}', l_extendedprice * 70000) ELSE '' END AS kd FROM lineitem""")
def x29_number_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, price = F.col("l_orderkey"), F.col("l_extendedprice")
    given = F.when(key % 4 == 0, F.concat(F.lit(" "), (price / 7).cast("string"))).when(key % 4 == 1, F.concat(F.lit("about "), (price / 7e10).cast("string"), F.lit(" nM")))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", text.number_text(given.when(key % 4 == 2, (price * 70000).cast("string")).otherwise("none")).alias("kd"))


@query("""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]{3,}')) AS w, generate_subscripts(regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]{3,}'), 1) AS i FROM documents),
    f AS (SELECT doc_id, w, min(i) AS i FROM w WHERE w NOT IN ('the', 'and', 'que') GROUP BY ALL), l AS (SELECT doc_id, array_to_string(list(w ORDER BY i)[1:8], ' ') AS l FROM f GROUP BY doc_id)
    SELECT doc_id, coalesce(l, '') AS keywords FROM documents LEFT JOIN l USING (doc_id)""")
def x32_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(responses.keywords(F.col("text"), ("the", "and", "que")), " ").alias("keywords"))


@query("""SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'review' WHEN '2-HIGH' THEN 'other' ELSE 'research' END AS paper_type,
    CASE WHEN o_orderkey % 3 = 0 THEN CAST(year(o_orderdate) AS VARCHAR) WHEN o_orderkey % 5 = 0 THEN 'unknown' ELSE CAST(year(o_orderdate) AS VARCHAR) END AS year FROM orders""")
def x35_x37_paper(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, year = F.col("o_orderkey"), F.year("o_orderdate").cast("string")
    kinds = F.when(F.col("o_orderpriority") == "1-URGENT", F.array(F.lit("Journal Article"), F.lit("Systematic Review"))).when(F.col("o_orderpriority") == "2-HIGH", F.array(F.lit("Letter")))
    kinds = kinds.when(F.col("o_orderpriority") == "3-MEDIUM", F.array(F.lit("Journal Article")))
    free = F.when(key % 5 != 0, F.concat(year, F.lit(" Jan-Feb")))
    return table(spark, sf_dir, "orders").select("o_orderkey", names.paper_type(kinds).alias("paper_type"), names.publication_year(F.when(key % 3 == 0, year), free).alias("year"))


@query(r"""WITH s AS (SELECT doc_id, unnest(l) AS s, generate_subscripts(l, 1) AS i FROM (SELECT doc_id, string_split(regexp_replace(coalesce(text, ''), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) AS l FROM documents)),
    k AS (SELECT *, contains(lower(s), 'the')::INT + contains(lower(s), 'of')::INT + contains(lower(s), 'que')::INT + contains(lower(s), 'und')::INT AS n FROM s),
    r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, i) AS p FROM k WHERE n > 0)
    SELECT doc_id, left(coalesce(string_agg(s, ' ' ORDER BY i), ''), 400) AS excerpt FROM documents LEFT JOIN (SELECT * FROM r WHERE p <= 5) USING (doc_id) GROUP BY doc_id""")
def w11_excerpt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", responses.excerpt(F.col("text"), ["the", "of", "que", "und"], 5, 400).alias("excerpt"))


# Filters, joins and orders


@query("SELECT doc_id FROM documents WHERE regexp_matches(text, '(?i)th[ae]t|und ')")
def f11_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").filter(text.any_found(F.col("text"), ["th[ae]t", "und "])).select("doc_id")


@query(f"SELECT doc_id FROM documents WHERE length({_TRIM.format('text')}) >= 50")
def f15_long_enough(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").filter(responses.long_enough(F.col("text"))).select("doc_id")


@query(over_records("SELECT row_id, species FROM rec WHERE species IN ('human', 'mouse')"))
def f17_species(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).filter(filters.isin("species", ["human", "mouse", "human, mouse"])).select("row_id", "species")


@query("""SELECT CAST(c_custkey AS VARCHAR) AS pmid, n AS records FROM customer JOIN (SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey) USING (c_custkey)
    WHERE c_custkey % 2 = 0 AND n <> 1""")
def f18_selectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    patches = table(spark, sf_dir, "customer").filter("c_custkey % 2 = 0").select(F.col("c_custkey").cast("string").alias("pmid"))
    return curation.unmatched_patches(records(spark, sf_dir).select("pmid"), patches, ["pmid"], unique=True)


@query("SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS pmid FROM orders WHERE o_custkey % 2 = 0")
def f18_must_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Selectors that all fit; one that doesn't ends the job."""
    patches = table(spark, sf_dir, "orders").filter("o_custkey % 2 = 0").select(F.col("o_custkey").cast("string").alias("pmid")).distinct()
    return curation.must_match(records(spark, sf_dir).select("pmid"), patches, ["pmid"])


@query(over_records("SELECT row_id, pmid FROM rec WHERE CAST(pmid AS BIGINT) IN (SELECT user_id FROM events WHERE event_type = 'error')"))
def j5_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "events").filter("event_type = 'error'").select(F.col("user_id").cast("string").alias("pmid"))
    return joins.known(records(spark, sf_dir).select("row_id", "pmid"), "pmid", keys)


@query(over_records("""SELECT row_id FROM (SELECT row_id, row_number() OVER (ORDER BY CASE WHEN row_id % 7 = 0 THEN 'yes' ELSE 'no' END DESC, confidence, row_id % 100 DESC, CASE WHEN row_id % 3 = 0 THEN 'yes' ELSE 'no' END DESC, row_id) AS n FROM rec)
    WHERE n <= 200"""))
def l1_adjudication_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 200 records that people should decide."""
    key, yes = F.col("row_id"), lambda c: F.when(c, "yes").otherwise("no")
    rows = records(spark, sf_dir).withColumns({"manual_recommended": yes(key % 7 == 0), "model_confidence": F.col("confidence"), "review_priority": key % 100, "topic_focused": yes(key % 3 == 0)})
    return rows.orderBy(*review.adjudication_order(), "row_id").limit(200).select("row_id")


_MODES = {
    "review_only": filters.View(review_only=True),
    "review_of_status": filters.View(review_only=True, single_status=["unclear"]),
    "without_single": filters.View(hide_single=True),
    "status_over_hide": filters.View(hide_single=True, single_status=["unclear"]),
    "all_rows": filters.View(hide_duplicates=None, hide_unspecified=False, hide_rejected=False, hide_review=False),
}
_REJECTED = "(validation_action IN ('remove', 'hide_incomplete_recipe', 'hide_single_tf', 'hide_model_adjudicated') OR row_id % 11 = 0)"
_SHOWN = f"NOT twin AND factors <> 'not specified' AND NOT review AND NOT {_REJECTED}"


@query(over_records(f"""SELECT row_id, review AS review_only, review AND single = 'unclear' AS review_of_status, {_SHOWN} AND single = '' AS without_single,
    {_SHOWN} AND single = 'unclear' AS status_over_hide, true AS all_rows FROM s""", _STATE_SQL))
def f7_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _state(spark, sf_dir).withColumns({"validation_recipe_valid": F.when(F.col("row_id") % 11 == 0, "No").otherwise(""), "is_broad_duplicate": F.col("is_broad_duplicate") == "True"})
    return rows.select("row_id", *[view.column().alias(n) for n, view in _MODES.items()])


_BASE = "confidence <> 'low' AND paper_type = 'research' AND single = '' AND NOT review AND validation_action <> 'remove'"


@query(over_records(f"""SELECT row_id, {_BASE} AND NOT twin AND factors <> 'not specified' AS curated, {_BASE} AND NOT twin AND factors <> 'not specified' AND row_id % 11 <> 0 AS with_answers,
    {_BASE} AND row_id % 10 <> 0 AND factors <> 'not specified' AS exact, {_BASE} AND NOT twin AND factors NOT IN ('not specified', 'ECONOMY') AS stricter FROM s""", _STATE_SQL))
def f10_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four definitions of what is shown: as curated, minus rejected answers, by exact duplicates, and with more words for missing factors."""
    key = F.col("row_id")
    rows = _state(spark, sf_dir).withColumns({"validation_recipe_valid": F.when(key % 11 == 0, "No").otherwise(""), "is_duplicate": F.when(key % 10 == 0, "True").otherwise("False")})
    policies = {"curated": rules.visible(), "with_answers": rules.visible(rejected_answers=True), "exact": rules.visible(broad=False), "stricter": rules.visible(missing=(*tables.UNSPECIFIED, "economy"))}
    return rows.select("row_id", *[c.alias(n) for n, c in policies.items()])


@query(over_records(f"""SELECT row_id, contains(lower(t), 'tf') AS tf, contains(lower(t), 'small') AS small, t <> '' AND NOT contains(lower(t), 'tf') AS non_tf FROM (SELECT row_id, {_TYPES_SQL} AS t FROM rec)"""))
def f3_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed(spark, sf_dir).select("row_id", *[filters.factor_class("factor_type", k).alias(k) for k in ("tf", "small", "non_tf")])


# Curation


@query(over_records("""SELECT row_id, coalesce(note, '') AS validation_known_issue, CASE WHEN k.pmid IS NULL OR a = '' THEN validation_action WHEN a = 'keep' AND validation_action <> '' THEN validation_action ELSE a END AS validation_action,
    CASE WHEN k.pmid IS NULL OR a = '' THEN review WHEN a = 'keep' THEN CASE WHEN review = '' THEN 'False' ELSE review END ELSE 'True' END AS validation_needs_review,
    CASE WHEN k.pmid IS NULL THEN 'weak' WHEN a = 'remove' THEN 'weak' ELSE 'weak;known' END AS validation_error_category, CASE WHEN k.pmid IS NULL THEN 'seen' ELSE 'seen || ' || note END AS validation_notes
    FROM (SELECT *, CASE WHEN row_id % 9 = 0 THEN 'True' ELSE '' END AS review FROM rec) r LEFT JOIN
    (SELECT CAST(c_custkey AS VARCHAR) AS pmid, CASE c_custkey % 3 WHEN 0 THEN 'remove' WHEN 1 THEN 'keep' ELSE '' END AS a, 'issue ' || c_custkey AS note FROM customer WHERE c_custkey % 20 = 3) k USING (pmid)"""))
def m2_known_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    action, tag = F.when(key % 3 == 0, "remove").when(key % 3 == 1, "keep").otherwise(""), F.when(key % 3 == 0, "weak").otherwise("known")
    patches = table(spark, sf_dir, "customer").filter(key % 20 == 3).select(key.cast("string").alias("pmid"), action.alias("action"), tag.alias("tag"), F.concat(F.lit("issue "), key.cast("string")).alias("note"))
    rows = records(spark, sf_dir).withColumns({"validation_needs_review": F.when(F.col("row_id") % 9 == 0, "True").otherwise(""), "validation_error_category": F.lit("weak"), "validation_notes": F.lit("seen")})
    return curation.known_issues(rows, patches).select("row_id", "validation_known_issue", "validation_action", "validation_needs_review", "validation_error_category", "validation_notes")


@query(over_records("""SELECT row_id, CASE WHEN validation_action <> '' AND row_id % 4 <> 0 THEN 'False' ELSE 'True' END AS validation_needs_review,
    CASE WHEN row_id % 4 = 0 THEN 'needs_review_later' WHEN row_id % 4 = 1 THEN CASE WHEN validation_action <> '' THEN 'resolved_by_action' ELSE ' ' END ELSE 'x' END AS validation_resolution FROM rec"""))
def m4_close_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("row_id")
    said = F.when(key % 4 == 0, "needs_review_later").when(key % 4 == 1, " ").otherwise("x")
    rows = records(spark, sf_dir).withColumns({"validation_needs_review": F.lit("True"), "validation_resolution": said})
    return curation.close_out(rows, ("remove", "mark_duplicate")).select("row_id", "validation_needs_review", "validation_resolution")


@query(over_records("""SELECT row_id, CASE WHEN fit AND w THEN 'released' WHEN w THEN 'held' ELSE '' END AS release, CASE WHEN fit AND w THEN 'False' WHEN row_id % 3 = 0 THEN 'True' ELSE '' END AS validation_needs_review,
    CASE WHEN fit AND w THEN 'fetched | released' ELSE 'fetched' END AS validation_notes
    FROM (SELECT *, row_id % 2 = 0 AND row_id % 3 = 0 AS w, paper_type = 'research' AND factors <> 'not specified' AND trim(evidence_sentence, ' ' || chr(10) || chr(9)) <> '' AND species <> '' AND row_id % 18 <> 0 AND row_id % 5 <> 0 AS fit FROM rec)"""))
def m8_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("row_id")
    rows = records(spark, sf_dir).withColumns({
        "validation_needs_review": F.when(key % 3 == 0, "True").otherwise(""), "validation_notes": F.lit("fetched"), "validation_resolution": F.lit(""),
        "single_tf_flag": F.when(key % 18 == 0, "True").otherwise("False"), "conversion_scope": F.when(key % 5 == 0, "unclear").otherwise("x"),
    })
    return curation.release(rows, key % 2 == 0).select("row_id", "release", "validation_needs_review", "validation_notes")


@query(over_records("""SELECT row_id, CASE WHEN q <> 'none' AND s <> evidence_sentence THEN s ELSE evidence_sentence END AS evidence_sentence, CASE WHEN q = 'good' AND s <> evidence_sentence THEN 'False' ELSE 'True' END AS validation_needs_review,
    CASE WHEN q <> 'none' AND s <> evidence_sentence THEN '' ELSE 'No better evidence found.' END AS validation_notes FROM
    (SELECT *, CASE WHEN row_id % 3 = 0 OR row_id % 5 = 0 THEN 'good' WHEN row_id % 3 = 1 OR row_id % 5 = 1 THEN 'weak' ELSE 'none' END AS q,
        CASE WHEN row_id % 3 = 0 THEN CASE WHEN row_id % 2 = 0 THEN evidence_sentence ELSE 'abstract ' || pmid END WHEN row_id % 5 = 0 OR (row_id % 3 = 2 AND row_id % 5 = 1) THEN 'full ' || pmid
            ELSE CASE WHEN row_id % 2 = 0 THEN evidence_sentence ELSE 'abstract ' || pmid END END AS s FROM rec)"""))
def m9_evidence_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("row_id")
    first, second = F.when(key % 3 == 0, "good").when(key % 3 == 1, "weak").otherwise("none"), F.when(key % 5 == 0, "good").when(key % 5 == 1, "weak").otherwise("none")
    said = F.when(key % 2 == 0, F.col("evidence_sentence")).otherwise(F.concat(F.lit("abstract "), "pmid"))
    sentence, quality = curation.better_evidence(said, first, F.concat(F.lit("full "), "pmid"), second)
    rows = records(spark, sf_dir).withColumns({"new_sentence": sentence, "new_quality": quality, "validation_needs_review": F.lit("True"), "validation_notes": F.lit("")})
    return curation.evidence_update(rows).select("row_id", "evidence_sentence", "validation_needs_review", "validation_notes")


_SURE = "row_id % 3 <> 2 AND confidence = 'high' AND row_id % 4 <> 1"


def _answers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    key = F.col("row_id")
    rows = records(spark, sf_dir).withColumns({"factor_type": F.lit("other"), "validation_needs_review": F.lit("True"), "validation_notes": F.lit("seen")})
    factors = F.when(key % 4 == 0, "SOX2").when(key % 4 == 1, "Not specified").otherwise("OCT4, KLF4")
    answers = rows.filter(key % 3 != 2).select("row_id", factors.alias("extracted_factors"), F.when(key % 4 == 0, "TF").otherwise("").alias("extracted_factor_type"), "confidence", F.concat(F.col("title"), "title").alias("reasoning"))
    return rows, answers


@query(over_records(f"""SELECT row_id, CASE WHEN {_SURE} THEN CASE WHEN row_id % 4 = 0 THEN 'SOX2' ELSE 'OCT4, KLF4' END ELSE factors END AS factors, CASE WHEN {_SURE} AND row_id % 4 = 0 THEN 'TF' ELSE 'other' END AS factor_type,
    CASE WHEN {_SURE} THEN '' ELSE 'True' END AS validation_needs_review, CASE WHEN {_SURE} THEN 'fulltext_auto:' || left(title || title, 80) ELSE 'seen' END AS validation_notes FROM rec"""))
def m10_sure_fills(spark: SparkSession, sf_dir: str) -> DataFrame:
    applied, _ = curation.apply_sure(*_answers(spark, sf_dir))
    return applied.select("row_id", "factors", "factor_type", "validation_needs_review", "validation_notes")


@query(over_records(f"SELECT row_id, CASE WHEN row_id % 4 = 0 THEN 'SOX2' ELSE 'OCT4, KLF4' END AS extracted_factors, confidence FROM rec WHERE {_SURE}"))
def m10_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, applied = curation.apply_sure(*_answers(spark, sf_dir))
    return applied.select("row_id", "extracted_factors", "confidence")


def _any(column: str, patterns) -> str:
    """Whether one of the patterns is found, as the oracle's engine sees it; it has no lookahead, so what must not follow is asked by itself."""
    found = lambda p: f"regexp_matches({column}, '(?i){p.replace(chr(39), chr(39) * 2)}')"
    parts = [(head, tail[:-1]) for head, _, tail in (p.partition("(?!.*") for p in patterns)]
    return "(" + " OR ".join(f"({found(head)} AND NOT {found(head + '.*' + tail)})" if tail else found(head) for head, tail in parts) + ")"


def _noted(name: str) -> str:
    return "'" + tables.EVIDENCE_NOTES[name].replace("'", "''") + "'"


_PRIOR, _METHODS, _NEGATIVE, _VAGUE = tables.EVIDENCE_NOTES
_VAGUE_NAMES = ["defined factors", "Small molecules", "SOX2", "chemical, cytokines", "unknown"]


@query(over_records(f"""SELECT row_id, CASE WHEN p OR m OR n THEN 'True' WHEN v THEN 'False' ELSE '' END AS validation_needs_review, CASE WHEN v THEN 'hide_incomplete_recipe' ELSE validation_action END AS validation_action,
    CASE WHEN v THEN '{_VAGUE}' WHEN n THEN '{_NEGATIVE}' WHEN m THEN '{_METHODS}' WHEN p THEN '{_PRIOR}' ELSE '' END AS validation_resolution,
    array_to_string(list_filter([CASE WHEN p THEN {_noted(_PRIOR)} END, CASE WHEN m THEN {_noted(_METHODS)} END, CASE WHEN n THEN {_noted(_NEGATIVE)} END, CASE WHEN v THEN {_noted(_VAGUE)} END], lambda x: x IS NOT NULL), ' | ') AS validation_notes
    FROM (SELECT *, NOT p AND NOT n AND NOT m AND active AND confidence = 'medium' AND source = 'abstract' AND len(string_split(f, ',')) = 1 AND {_any("trim(f)", tables.VAGUE_FACTORS)} AS v
    FROM (SELECT *, NOT p AND active AND {_any("e", tables.METHODS_ONLY)} AS m FROM (SELECT *, active AND {_any("e", tables.PRIOR_WORK)} AS p, active AND {_any("e", tables.NEGATIVE)} AS n
    FROM (SELECT *, validation_action NOT IN ('remove', 'mark_duplicate') AS active, CASE row_id % 5 {" ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(_VAGUE_NAMES))} END AS f,
        CASE row_id % 7 WHEN 0 THEN 'We previously reported this.' WHEN 1 THEN 'It did not convert cells.' WHEN 2 THEN 'Cells were cultured in medium.' WHEN 3 THEN 'We previously reported it failed to convert.' WHEN 4 THEN 'Cells were treated with BMP4.' WHEN 5 THEN 'Cells were treated with BMP4 and converted.' ELSE 'Cells became neurons.' END AS e FROM rec))))"""))
def c4_evidence_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("row_id")
    said = F.when(key % 7 == 0, "We previously reported this.").when(key % 7 == 1, "It did not convert cells.").when(key % 7 == 2, "Cells were cultured in medium.").when(key % 7 == 3, "We previously reported it failed to convert.")
    said = said.when(key % 7 == 4, "Cells were treated with BMP4.").when(key % 7 == 5, "Cells were treated with BMP4 and converted.")
    vague = F.element_at(F.array(*map(F.lit, _VAGUE_NAMES)), (key % 5 + 1).cast("int"))
    rows = records(spark, sf_dir).withColumns({"is_duplicate": F.lit(False), "evidence_sentence": said.otherwise("Cells became neurons."), "factors": vague})
    made = rules.evidence_flags(schema.ensure_columns(rows, {"validation_needs_review": "", "validation_resolution": "", "validation_notes": ""}))
    return made.select("row_id", "validation_needs_review", "validation_action", "validation_resolution", "validation_notes")


# Responses and summaries

_ADJUDICATION = "struct<decision:string,confidence:string,recipe_valid:string,factor_assessment:string,cell_assessment:string,duplicate_assessment:string,suggested_factors:string,suggested_factor_type:string,manual_reason:string,rationale:string>"


@query(over_records("""SELECT row_id, CASE WHEN row_id % 7 = 0 OR row_id % 3 = 2 THEN 'needs_manual' WHEN row_id % 3 = 0 THEN 'auto_hide' ELSE 'auto_accept' END AS decision,
    CASE WHEN row_id % 7 = 0 OR row_id % 5 = 0 OR row_id % 4 = 1 THEN 'low' ELSE confidence END AS confidence, CASE WHEN row_id % 7 = 0 OR row_id % 2 = 0 THEN 'unclear' ELSE 'yes' END AS recipe_valid,
    CASE WHEN row_id % 7 = 0 OR row_id % 4 = 3 THEN '' ELSE 'SOX2' END AS suggested_factors, CASE WHEN row_id % 7 <> 0 AND row_id % 4 IN (0, 2) THEN 'TF, miRNA' ELSE '' END AS suggested_factor_type,
    CASE WHEN row_id % 7 = 0 THEN '' ELSE left(r, 160) || CASE WHEN length(r) > 160 THEN ' ...' ELSE '' END END AS manual_reason
    FROM (SELECT *, regexp_replace(title || title || title, '^\\s+|\\s+$', '', 'g') AS r FROM rec)"""))
def r4_adjudication(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("row_id")
    answer = F.struct(
        F.when(key % 3 == 0, " Auto_Hide").when(key % 3 == 1, "auto_accept").otherwise("perhaps").alias("decision"), F.when(key % 5 == 0, "certain").otherwise(F.upper("confidence")).alias("confidence"),
        F.when(key % 2 == 1, "YES").alias("recipe_valid"), F.when(key % 4 == 3, "").otherwise("SOX2").alias("suggested_factors"), F.when(key % 4 == 1, "protein").otherwise("TF,gene, miRNA").alias("suggested_factor_type"),
        F.concat("title", "title", "title").alias("manual_reason"),
    )
    typed = answer.withField("suggested_factor_type", F.when(key % 4 == 3, "").otherwise(answer["suggested_factor_type"]))
    raw = F.when(key % 7 == 0, "I can't say {").otherwise(F.concat(F.lit("Here: "), F.to_json(typed)))
    parsed = responses.parse(records(spark, sf_dir).select("row_id", raw.alias("raw")), "raw", _ADJUDICATION)
    return responses.adjudication(parsed).select("row_id", "decision", "confidence", "recipe_valid", "suggested_factors", "suggested_factor_type", "manual_reason")


@query(over_records("""SELECT row_id, CASE WHEN row_id % 4 = 0 THEN '' ELSE 'seen in ' || pmid END AS evidence_sentence, q AS evidence_quality, CASE WHEN q = 'good' THEN '' ELSE 'True' END AS validation_needs_review,
    CASE WHEN q = 'good' THEN '' ELSE 'evidence_quality_' || q END AS validation_resolution FROM (SELECT *, CASE row_id % 4 WHEN 0 THEN 'none' WHEN 1 THEN 'weak' ELSE 'good' END AS q FROM rec)"""))
def r5_evidence_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("row_id")
    answer = F.struct(F.concat(F.lit("seen in "), "pmid").alias("evidence_sentence"), F.when(key % 4 == 1, " Weak").when(key % 4 == 2, "good").alias("quality"))
    raw = F.when(key % 4 == 0, "nothing").otherwise(F.to_json(answer))
    parsed = responses.parse(records(spark, sf_dir).select("row_id", raw.alias("raw")), "raw", "struct<evidence_sentence:string,quality:string>")
    return curation.evidence_responses(parsed).select("row_id", "evidence_sentence", "evidence_quality", "validation_needs_review", "validation_resolution")


@query(over_records("""SELECT row_id, CASE WHEN row_id % 3 = 0 THEN 'recipe' ELSE 'skipped' END AS part, CASE WHEN row_id % 3 = 0 AND row_id % 2 = 0 THEN 'new source' ELSE source_cell END AS source_cell,
    CASE WHEN row_id % 3 = 0 THEN 'SOX2' ELSE factors END AS factors FROM rec"""))
def s11_r8_patents(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("row_id")
    answer = F.struct((key % 3 == 0).alias("has_recipe"), F.when(key % 2 == 0, "new source").otherwise(" ").alias("source_cell"), F.lit("SOX2").alias("factors"))
    raw = F.when(key % 3 == 2, "no").otherwise(F.to_json(answer))
    parsed = responses.parse(records(spark, sf_dir).withColumn("raw", raw), "raw", "struct<has_recipe:boolean,source_cell:string,factors:string>")
    found, other = responses.split_answers(parsed)
    kept = responses.merged_fields(found, ["source_cell", "factors"]).withColumn("part", F.lit("recipe"))
    return kept.select("row_id", "part", "source_cell", "factors").unionByName(other.withColumn("part", F.lit("skipped")).select("row_id", "part", "source_cell", "factors"))


@query(over_records("SELECT row_id, species FROM rec WHERE species NOT IN ('', 'human')"))
def e6_invalid_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = records(spark, sf_dir).withColumn("species", F.upper("species"))
    return sampling.invalid_answers(said, "species", ("human", "rat")).select("row_id", F.lower("species").alias("species"))


@query(over_records("SELECT row_id, species, lower(target_cell) AS target_cell FROM rec WHERE species <> ''"))
def e6_checked_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = records(spark, sf_dir).withColumn("species", F.concat(F.lit(" "), F.upper("species")))
    return sampling.checked_answers(said, "species", ("human", "mouse"), ["target_cell"]).select("row_id", "species", "target_cell")


@query(over_records("""SELECT count(*) AS rows, count(*) FILTER (WHERE open) AS manual, count(*) FILTER (WHERE NOT open AND hide) AS hides, count(*) FILTER (WHERE NOT open AND merge) AS merges,
    count(*) FILTER (WHERE NOT open AND acc AND NOT stale AND NOT clears AND NOT dup) AS accepts, count(*) FILTER (WHERE risk = 'low' AND w) AS low_risk_writes, count(*) FILTER (WHERE risk = 'medium' AND w) AS medium_risk_writes,
    count(*) FILTER (WHERE risk = 'high' AND w) AS high_risk_writes FROM (SELECT *, NOT open AND (hide OR merge OR stale OR clears) AS w FROM y)""", _DECIDED_SQL))
def a19_proposal_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = aggregates.proposal_counts(_proposed(spark, sf_dir))
    return made.select("rows", "manual", "hides", "merges", "accepts", "low_risk_writes", "medium_risk_writes", "high_risk_writes")


@query(f"""WITH {_PAIR_ROWS} SELECT 'interaction_label' AS field, label AS value, count(*) AS n FROM p GROUP BY label UNION ALL
    SELECT 'binder_type', CASE WHEN l_quantity > 25 THEN 'nanobody' ELSE 'miniprotein' END, count(*) FROM lineitem GROUP BY 2 UNION ALL SELECT 'source_rank', CAST(l_linenumber % 2 AS VARCHAR), count(*) FROM lineitem GROUP BY 2""")
def a17_track_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.track_counts(_pairs(spark, sf_dir), ["interaction_label", "binder_type", "source_rank"])
