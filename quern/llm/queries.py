"""The registered queries of the operators, one for each, and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import classlm, decontaminate, langid, licenses, linededup, mixing, packing, periodic, rules, search, secrets, simhash, substrings
from quern.llm.base import SPACES, table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites are the documents' sources."""
    return linededup.drop_boilerplate(table(spark, sf_dir, "documents"), site="source").select("doc_id", "source", "text", "n_chars")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of 2,048 tokens. Null and empty texts are one piece of id 0; rows that share a doc_id, or a null one, each get their pieces."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of phrases and notices in whole texts. Null and empty texts have no words, no labels and score 0; each row has its own."""
    found = licenses.find_licenses(table(spark, sf_dir, "documents"))
    joined = {c: F.array_join(c, ",") for c in ("base_labels", "labels")}
    return found.withColumns(joined)


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items of which a window is a copy. Null, empty and word-less texts match nothing; rows that share a doc_id, or a null one, are one document."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _held_out(parts: int):
    """Whether a document is kept from learning: by the CRC of its doc_id as text; a null doc_id is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(parts)) == 2, F.lit(False))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class bigram scores, learned from the rows that are not held out. Null and empty texts have one token, their end; a null doc_id is learned from."""
    scored = classlm.score_texts(table(spark, sf_dir, "documents"), ~_held_out(7))
    return scored.select("doc_id", _held_out(7).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages by string kernels, learned from labelled rows that are not held out. Null texts and those without a letter are ``und`` with score 0; a null doc_id is not learned from."""
    found = langid.identify(table(spark, sf_dir, "documents"), ~_held_out(4))
    return found.select("doc_id", _held_out(4).alias("held_out"), "lang_pred", "score")


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in whole texts. Null and empty texts have none, and the digest of an empty list; each row has its own."""
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secrets.span_list("base"), 256).alias("base_sha256"),
        secrets.span_list("spans").alias("spans"),
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger with the verdict of the current policy. Null and empty texts have no words and fail ``few_words``."""
    found = rules.ledger(table(spark, sf_dir, "documents"))
    base = F.col("failed").bitwiseAND(F.lit(rules.mask(rules.BASE))) != 0
    return found.select(
        *["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), (~base & rules.keeps()).alias("kept")],
        *["n_letters", "n_lines", "failed", F.lit(rules.CURRENT).alias("policy")],
    )


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every policy and each of its rules: how many documents it fails, and how many it alone fails, from one stored ledger."""
    kept, out = rules.stored(table(spark, sf_dir, "documents")), None
    for policy in rules.POLICIES:
        one = rules.ablations(kept, policy).select(F.lit(policy).alias("policy"), "rule", "n_failed", "n_only")
        out = one if out is None else out.unionByName(one)
    return out


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 200 bytes and more that stand earlier. Null and empty texts have none; rows alike in doc_id and text are one document, and a null doc_id is last and stays null."""
    return substrings.repeated_passages(table(spark, sf_dir, "documents")).drop("print")


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four-word shingles, four differing bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words_per_shingle=4, radius=4)


def _with_repeats(docs: DataFrame) -> DataFrame:
    """One document in ten, by the CRC of its doc_id, with its words from some place on replaced by repeats of the first few of them."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", SPACES), lambda w: w != "")
    held = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"), F.when(F.pmod(h, F.lit(10)) == 0, words).alias("words"))
    placed = held.withColumn("a", F.expr("if(size(words) > 0, g % size(words), null)")).withColumn("p", F.expr("1 + (size(words) - a) div (3 + g % 8)"))
    again = F.expr("array_join(transform(sequence(0L, size(words) - 1L), i -> words[cast(if(i < a, i, a + (i - a) % p) as int)]), ' ')")
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), again).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of 12 words or more. Texts without words and those without runs have no longest run (nulls); a null doc_id has no repeats put in."""
    found = periodic.periodic_runs(_with_repeats(table(spark, sf_dir, "documents")))
    best = found.withColumn("best", periodic.longest(F.col("runs")))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.back")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.less")).alias("period"),
        F.expr("1000L * best.length div -best.less").alias("exponent_milli"),
        F.sha2(periodic.run_list(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources weigh 5, 2, 1 in turn; no document is taken more than three times. Null texts have no words; a null source is the last one."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of each benchmark item. Items and documents without terms list nothing and are not listed."""
    return search.ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (
        *(op1_line_dedup, op2_best_fit_packing, op3_license_scans, op4_benchmark_decontamination, op5_lm_scoring),
        *(op6_language_id, op7_secret_scans, op8_quality_rules, op9_substring_dedup, op10_simhash_near_dedup),
        *(op11_periodic_runs, op12_mixing, op13_ranked_search),
    )
} | {"quality_ablations": quality_ablations}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def _licenses_sql() -> str:
    """Phrases by place, and every window of every template, over all words of all texts."""
    quoted = lambda text: "[" + ", ".join(f"'{w.decode()}'" for w in sorted(set(licenses.words(text.encode())))) + "]::VARCHAR[]"
    notices = ", ".join(f"({k}, '{label}', {quoted(t)}, {quoted(marks)}, {len(licenses.words(t.encode()))})" for k, (label, marks, t) in enumerate(licenses.TEMPLATES))
    places = [
        (label, "list_filter(range(len(w)), lambda i: " + " AND ".join(f"w[i + {k + 1}] = '{x}'" for k, x in enumerate(phrase.split())) + ")") for phrase, label in licenses.PHRASES
    ]
    return f"""
        WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_WORDS}) AS w FROM documents),
        p AS (SELECT doc_id, len(w) AS n_words, {", ".join(f"{sql} AS p{k}" for k, (_, sql) in enumerate(places))} FROM d),
        b AS (SELECT doc_id, n_words, list_concat({", ".join(f"p{k}" for k in range(len(places)))}) AS places,
            list_filter([{", ".join(f"CASE WHEN len(p{k}) > 0 THEN '{label}' END" for k, (label, _) in enumerate(places))}], lambda x: x IS NOT NULL) AS base FROM p),
        notice(k, label, tokens, marks, width) AS (VALUES {notices}),
        token AS (SELECT k, label, width, len(tokens) AS size, len(marks) AS n_marks, ceil({licenses.CONTAINMENT} * len(tokens) - 0.000000001) AS need, unnest(tokens) AS word, marks FROM notice),
        word AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
        hit AS (SELECT doc_id, k, label, width, size, need, n_marks, word, i, list_contains(marks, word) AS mark, lead(i) OVER (PARTITION BY doc_id, k, word ORDER BY i) AS again FROM word JOIN token USING (word)),
        win AS (SELECT doc_id, k, label, size, need, n_marks, width, again, i AS a, count(DISTINCT word) OVER w AS n, count(DISTINCT CASE WHEN mark THEN word END) OVER w AS m FROM hit
            WINDOW w AS (PARTITION BY doc_id, k ORDER BY i RANGE BETWEEN CURRENT ROW AND width - 1 FOLLOWING)),
        best AS (SELECT * FROM win WHERE n >= need AND m = n_marks AND (again IS NULL OR again >= a + width)),
        seen AS (SELECT b.doc_id, b.k, b.a, h.word, min(h.i) AS i FROM best b JOIN hit h ON h.doc_id = b.doc_id AND h.k = b.k AND h.i BETWEEN b.a AND b.a + b.width - 1 GROUP BY ALL),
        good AS (SELECT b.*, z FROM best b JOIN (SELECT doc_id, k, a, max(i) AS z FROM seen GROUP BY ALL) USING (doc_id, k, a)),
        kept AS (SELECT * FROM good g WHERE NOT EXISTS (SELECT 1 FROM good o WHERE o.doc_id = g.doc_id AND o.label <> g.label AND o.n > g.n
            AND 2 * (least(g.z, o.z) - greatest(g.a, o.a) + 1) > g.z - g.a + 1)),
        m AS (SELECT doc_id, list(DISTINCT label) AS found, max(n / size) AS best FROM kept GROUP BY doc_id)
        SELECT doc_id, n_words::BIGINT AS n_words, len(places)::BIGINT AS n_base, list_min(places)::BIGINT AS first_word, list_max(places)::BIGINT AS last_word,
            array_to_string(list_sort(base), ',') AS base_labels, array_to_string(list_sort(list_distinct(list_concat(base, coalesce(found, [])))), ',') AS labels,
            CASE WHEN len(places) > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::DOUBLE AS score FROM b LEFT JOIN m USING (doc_id)"""


_TRIMMED = "trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"

_MEASURED = r"""d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
            list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
        word AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i, len(words) AS n FROM d),
        win AS (SELECT doc_id, i, i + 7 <= n AS whole, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS s FROM word),
        rep AS (SELECT doc_id, i, whole AND count(*) OVER (PARTITION BY doc_id, whole, s) > 1 AS again FROM win),
        cov AS (SELECT doc_id, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS covered FROM rep),
        r AS (SELECT doc_id, count(*) FILTER (WHERE covered) AS n_repeat_words FROM cov GROUP BY doc_id),
        m AS (SELECT d.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
            (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
            length(regexp_replace(text, '[^\pL]+', '', 'g'))::BIGINT AS n_letters, len(lines)::BIGINT AS n_lines,
            (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
            FROM d LEFT JOIN r USING (doc_id))"""
_FAILED = """v AS (SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
            + CASE WHEN word_chars < 2 * greatest(n_words, 1) THEN 8 ELSE 0 END + CASE WHEN word_chars > 15 * greatest(n_words, 1) THEN 16 ELSE 0 END
            + CASE WHEN n_dup_lines >= 3 AND 10 * n_dup_lines > 3 * n_lines THEN 32 ELSE 0 END + CASE WHEN n_letters * 5 < word_chars * 3 THEN 64 ELSE 0 END
            + CASE WHEN n_lines <= 1 AND n_words > 10000 THEN 128 ELSE 0 END)::BIGINT AS failed FROM m)"""

ORACLE_SQL: dict[str, str] = {
    "op1_line_dedup": f"""
        WITH split AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
        line AS (SELECT doc_id, source, unnest(lines) AS line, generate_subscripts(lines, 1) AS at FROM split),
        keyed AS (SELECT *, {_TRIMMED} AS body FROM line),
        total AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
        boiler AS (
            SELECT k.source, k.body FROM keyed k JOIN total t ON k.source IS NOT DISTINCT FROM t.source WHERE k.body <> ''
            GROUP BY k.source, k.body, t.pages HAVING count(DISTINCT doc_id) >= {linededup.LEAST_PAGES} AND count(DISTINCT doc_id) > {linededup.RATIO} * t.pages),
        kept AS (
            SELECT k.doc_id, string_agg(k.line, chr(10) ORDER BY k.at) AS text FROM keyed k
            WHERE NOT EXISTS (SELECT 1 FROM boiler b WHERE b.source IS NOT DISTINCT FROM k.source AND b.body = k.body) GROUP BY k.doc_id)
        SELECT d.doc_id, d.source, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
            CASE WHEN d.text IS NULL THEN NULL ELSE length(coalesce(k.text, '')) END AS n_chars
        FROM documents d LEFT JOIN kept k USING (doc_id)""",
    "op3_license_scans": _licenses_sql(),
    "op8_quality_rules": f"""
        WITH {_MEASURED}, {_FAILED}
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 AS base_failed, failed & 127 = 0 AS kept, n_letters, n_lines, failed, 'v2' AS policy FROM v""",
    "op13_ranked_search": r"""
        WITH word AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM documents),
        asked AS (SELECT item_id, translate(unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM benchmark),
        item AS (SELECT item_id, term, count(*) AS times FROM asked GROUP BY ALL),
        tf AS (SELECT doc_id, term, count(*) AS tf FROM word GROUP BY ALL),
        doc AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
        total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM doc),
        df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
        w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, total),
        m AS (SELECT doc_id, 75 + (25 * n * docs) // terms AS m FROM doc, total),
        scored AS (SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
            FROM item JOIN tf USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
        placed AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM scored WHERE score > 0)
        SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM placed WHERE rank <= 20""",
    "quality_ablations": f"""
        WITH {_MEASURED}, {_FAILED},
        policy(policy, mask) AS (VALUES ('v1', 3), ('v2', 127)),
        rule(rule, bit) AS (VALUES ('few_words', 1), ('repeated_windows', 2), ('symbols', 4), ('short_words', 8), ('long_words', 16), ('repeated_lines', 32), ('few_letters', 64))
        SELECT policy, rule, count(*) FILTER (WHERE failed & bit <> 0) AS n_failed, count(*) FILTER (WHERE failed & mask = bit) AS n_only
        FROM v, policy, rule WHERE mask & bit <> 0 GROUP BY policy, rule""",
}
