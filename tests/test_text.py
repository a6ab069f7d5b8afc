from pyspark.sql import functions as F

from quern.functions import text

CASES = {
    "split_nested": [
        ("miR-302 (a, b, c), Oct3/4 (Pou5f1)", ["miR-302 (a, b, c)", "Oct3/4 (Pou5f1)"]),
        ("a),b,(c,d", ["a)", "b", "(c,d"]),
        (" x ; ,y", ["x", "y"]),
        ("", []),
        (None, []),
        ("((a,b),c);d", ["((a,b),c)", "d"]),
    ],
    "factor_key": [
        ("CEBPalpha", "CEBPA"), ("PU.1, OCT4", "OCT4 | SPI1"), ("OCT4, OCT4", "OCT4 | OCT4"), ("c-Myc; cMYC", "C-MYC | C-MYC"), ("Not Specified", "not specified"), ("", ""),
        ("Oct3/4 (Pou5f1), Sox2", "OCT4 | SOX2"), ("TGF-β  one", "TGF-B ONE"), ("unknown, Klf4", "KLF4 | not specified"),
    ],
    "species": [("Mice; Homo sapiens", "human, mouse"), ("dog/rats, mouse,mouse", "mouse, rat, dog"), ("", "")],
    "title_key": [("  The β-Cell: A  story ", "cell a story"), ("An apple", "apple")],
    "search_text": [("T-cell/β_x (Y)", "t cell beta x y")],
    "strip_html": [("<p>a &amp; b</p>\n<b>c</b>", "a & b c")],
    "item_count": [("not specified", 0), ("a, b (c, d)", 2), ("", 0)],
    "strip": [(" \ta b\n", "a b")],
}


def test_scalar_functions(spark):
    for name, cases in CASES.items():
        rows = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, s string").repartition(2)
        got = dict(rows.select("i", getattr(text, name)(F.col("s"))).collect())
        for i, (given, want) in enumerate(cases):
            assert got[i] == want, (name, given)


def test_notes_and_tags(spark):
    row = spark.range(1).select(
        text.append_tag(F.lit("a; b"), F.lit("b")).alias("same"),
        text.append_tag(F.lit(""), F.lit("x")).alias("first"),
        text.append_note(F.lit("old"), F.lit("new")).alias("note"),
        text.append_note(F.lit("old new"), F.lit("new")).alias("held"),
        text.append_note(F.lit("old new"), F.lit("new"), by=" | ", repeat=True).alias("again"),
        text.manual_note(F.lit("tag; mine | tag"), "tag").alias("mine"),
        text.with_auto_tag(F.lit(""), "tag").alias("tag"),
        text.preview(F.array(*map(F.lit, "abcde")), 3).alias("preview"),
        text.truncate(F.lit("abcdef"), 3).alias("cut"),
        text.percent(F.lit(1), F.lit(8)).alias("percent"),
        text.tolerant_number(F.lit("<5 nM")).alias("number"),
        text.valid_sequence(F.lit("ACDJ")).alias("bad"),
    ).first()
    assert tuple(row) == ("a;b", "x", "old || new", "old new", "old new | new", "mine", "tag", "a; b; c; ... (+2 more)", "abc ...", 12.5, 5.0, False)


def test_strip_knows_the_white_space_of_all_scripts(spark):
    """One character at both ends: trimmed where the pattern's Unicode class trims it."""
    chars = spark.range(1, 0x3100).filter("id not between 55296 and 57343").select(F.expr("decode(unhex(lpad(hex(id), 4, '0')), 'UTF-16BE')").alias("c")).withColumn("t", F.concat("c", "c", F.lit("a b"), "c"))
    assert chars.filter(~text.strip(F.col("t")).eqNullSafe(F.regexp_replace("t", r"(?U)^\s+|\s+$", ""))).count() == 0
    assert chars.filter(text.sequence(F.col("t")) != F.upper(F.regexp_replace("t", r"(?U)\s+", ""))).count() == 0
