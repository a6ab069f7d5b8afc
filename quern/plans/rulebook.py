"""Registered queries that apply the rule tables to names which Spark derives from the tables; their SQL applies the same rules.

A name is a usual one, picked by the part of an order line and put into upper case, before the part's type, after the part's name or
beside another name, by its supplier. The oracle's engine has no look-around, so what may not stand beside a match is asked by itself.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import names, tables, text
from quern.operators import curation, duplicates, filters, inverted, rules
from quern.plans.catalog import ORACLE_SQL, query
from quern.plans.records import table

CELLS = (
    "iPSCs", "hiPSC", "human induced pluripotent stem cells (hiPSCs)", "pluripotent stem cell", "naive pluripotent stem cell", "induced cardiomyocyte-like cells (iCM)", "cardiomyocytes", "beating cardiomyocyte",
    "atrial cardiomyocyte-like cell", "hepatocyte-like cells", "iHep", "functional hepatocytes", "induced neuron", "induced neuron (iN)", "neuronal cells", "functional neurons", "dopaminergic neuron",
    "motor neurons", "GABAergic interneuron", "glutamatergic neuron", "retinal ganglion cell", "insulin-producing cell", "pancreatic β-cells", "pancreatic beta cell", "beta-like cells", "macrophage-like cells",
    "M2 macrophage-like", "monocyte-derived macrophages", "inner hair cells", "supporting cell", "osteoblast", "myofibroblast", "skeletal muscle myotube", "human foreskin fibroblasts", "mouse tail-tip fibroblasts",
    "MEFs", "mouse embryonic fibroblast (MEF)", "neonatal cardiac fibroblasts", "adult human dermal fibroblasts", "senescent mouse fibroblast", "human somatic cells", "PBMC", "peripheral blood mononuclear cells (PBMCs)",
    "bone marrow-derived mesenchymal stem cells (BMSC)", "human MSCs", "adipose-derived stem cells (ADSC)", "human embryonic stem cell (hESC)", "mESCs", "ESC", "primary human hepatocytes", "liver cell", "reactive astrocytes",
    "CD19+ B lymphocytes", "pre-B cell", "human urine-derived cells", "urine cells", "Müller glial cells", "Muller glia", "pancreatic acinar cells", "pancreatic ductal cell", "hepatic stellate cell", "HUVECs",
    "human umbilical vein endothelial cells (HUVEC)", "vascular endothelial cell", "spermatogonial stem cell", "keratinocyte", "neural stem cell (NSC)", "T-cells", "CD4+ Treg", "natural killer cell", "NK cell",
    "dendritic cell", "small cell lung cancer", "neuroendocrine tumor cell", "human and mouse fibroblast", "pig islet", "neuron of the adult rat", "zebrafish retina", "bovine granulosa cell", "patient-derived fibroblasts", "unspecified", "",
)
FACTORS = (
    "OCT3/4", "Oct-4", "POU5F1", "Sox-2", "SOX2", "klf4", "Klf4", "c-Myc", "cMYC", "Nanog", "Ascl1", "Ngn2", "Neurogenin 2", "NEUROG3", "NeuroD1", "Gata4", "Tbx5", "Mef2c", "Hand2", "Foxa2", "Foxa3", "HNF4α", "Hnf1a", "Brn2",
    "Brn3b", "Pdx1", "Pax6", "Nurr1", "GATA-1", "Gfi1", "Dlx2", "Sox10", "Sox9", "Atoh1", "CHIR-99021", "A-83-01", "forskolin", "dorsomorphin", "Y-27632", "repSox", "5-azacytidine", "valproic acid", "activin A",
    "basic fibroblast growth factor", "hepatocyte growth factor", "oncostatin M", "epidermal growth factor", "TGF beta", "TGF-β", "ascorbic acid", "shp53", "miR-302", "let-7", "p53 shRNA", "BMP4", "FGF2", "VPA", "hOCT4", "PU.1",
    "C/EBPα", "Ptf1a", "ETV2", "defined factors", "small molecules", "cytokines", "n/a", "none", "some prose only", "OSKM", "Lin28", "XYZ", "",
)
SPECIES = ("Mice", "Homo sapiens", "human", "Human and mouse", "rats", "swine", "cow", "Zebrafish", "dog", "cats", "murine", "Mus musculus", "not specified", "NA", "pig; human", "rat/mouse", "")


def _pick(of: tuple[str, ...], at: str) -> str:
    quoted = [n.replace("'", "''") for n in of]
    return f"CASE {at} % {len(of)} " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(quoted)) + " END"


def _names_sql(of: tuple[str, ...], beside: str = " ") -> str:
    """The names of order lines, for the oracle."""
    name, other = _pick(of, "l_partkey"), _pick(of, "(l_partkey + l_suppkey * 7 + l_orderkey)")
    return f"CASE l_suppkey % 5 WHEN 0 THEN {name} WHEN 1 THEN upper({name}) WHEN 2 THEN concat({name}, ' ', lower(p_type)) WHEN 3 THEN concat(p_name, ' ', {name}) ELSE concat({name}, '{beside}', {other}) END"


def _picked(of: tuple[str, ...], at: Column) -> Column:
    """``_pick`` as an array's item: a CASE of so many branches makes code that is compiled late or not at all, and asks every branch of a row."""
    return F.get(F.array(*map(F.lit, of)), (at % len(of)).cast("int"))


def _names(spark: SparkSession, sf_dir: str, of: tuple[str, ...], beside: str = " ") -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    joined = lines.join(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    name, other = _picked(of, F.col("l_partkey")), _picked(of, F.col("l_partkey") + F.col("l_suppkey") * 7 + F.col("l_orderkey"))
    kind, space = F.col("l_suppkey") % 5, F.lit(" ")
    given = F.when(kind == 0, name).when(kind == 1, F.upper(name)).when(kind == 2, F.concat(name, space, F.lower("p_type"))).when(kind == 3, F.concat("p_name", space, name))
    return joined.select("l_orderkey", "l_linenumber", given.otherwise(F.concat(name, F.lit(beside), other)).alias("given"))


def _over(of: tuple[str, ...], value: str, name: str, beside: str = " ", *steps: str) -> str:
    """Oracle: ``value`` of the last step over the names; steps are select lists over the one before."""
    inner = f"SELECT l_orderkey, l_linenumber, {_names_sql(of, beside)} AS given FROM lineitem JOIN part ON l_partkey = p_partkey"
    for step in steps:
        inner = f"SELECT *, {step} FROM ({inner})"
    return f"SELECT l_orderkey, l_linenumber, given, {value} AS {name} FROM ({inner})"


def _applied(spark: SparkSession, sf_dir: str, of: tuple[str, ...], name: str, rule: Callable[[Column], Column], beside: str = " ") -> DataFrame:
    return names.by_distinct(_names(spark, sf_dir, of, beside), "given", name, rule)


# Rules as SQL

_Q = lambda s: "'" + s.replace("'", "''") + "'"
_TRIM = "trim(given)"


def _has(column: str, pattern: str, flags: str = "(?i)") -> str:
    return "false" if pattern == "(?!)" else f"regexp_matches({column}, {_Q(flags + pattern)})"


def _first(column: str, rules_: list[tuple[str, str]], otherwise: str, flags: str = "(?i)") -> str:
    """The value of the first rule found; a rule that excludes a word from the start on is two conditions."""

    def one(pattern: str) -> str:
        if not pattern.startswith("^(?!.*"):
            return _has(column, pattern, flags)
        unless, _, found = pattern[len("^(?!.*") :].partition(").*")
        return f"({_has(column, found, flags)} AND NOT {_has(column, unless, flags)})"

    return "CASE " + " ".join(f"WHEN {one(p)} THEN {_Q(v)}" for p, v in rules_) + f" ELSE {otherwise} END"


def _whole(column: str, rules_: list[tuple[str, str]], flags: str = "") -> str:
    """The value of the first rule that is the whole name; what may not follow then can't."""
    return _first(column, [(f"^(?:{p.removesuffix(r'(?!\s*\()')})$", v) for p, v in rules_], column, flags)


def _mapped(column: str, values: dict[str, str], otherwise: str) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {_Q(k)} THEN {_Q(v)}" for k, v in values.items()) + f" ELSE {otherwise} END"


def _replaced(column: str, pairs: list[tuple[str, str]]) -> str:
    return reduce(lambda c, kv: f"regexp_replace({c}, {_Q(kv[0])}, {_Q(kv[1])}, 'g')", pairs, column)


def _items(column: str, separators: str = ",") -> str:
    return f"list_filter(list_transform(regexp_split_to_array({column}, '[{separators}]'), lambda x: trim(x)), lambda x: x <> '')"


# Queries


@query(_over(FACTORS, f"array_to_string(list_transform({_items('given')}, lambda x: {_whole('x', tables.FACTOR_RULES)}), ', ')", "standard", ", "))
def x10_factor_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _applied(spark, sf_dir, FACTORS, "standard", names.standard_factors, ", ")


@query(_over(CELLS, _whole("t", tables.CELL_RULES, "(?i)"), "standard", " ", f"{_TRIM} AS t"))
def x9_target_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _applied(spark, sf_dir, CELLS, "standard", names.standard_target)


@query(_over(CELLS, _whole("t", tables.SOURCE_RULES, "(?i)"), "standard", " ", f"{_TRIM} AS t"))
def x9_source_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _applied(spark, sf_dir, CELLS, "standard", names.standard_source)


_SPELLED = _replaced("x", [(rf"(?i)(^|[^-A-Za-z0-9]){k}s?\b", rf"\1{v}") for k, v in tables.CELL_ABBREVIATIONS.items()])
_FULL = sorted(set(tables.CELL_ABBREVIATIONS.values()), key=len, reverse=True)


@query(_over(CELLS, _replaced(_mapped("spelled", tables.CELL_SYNONYMS, "spelled"), [(rf"(?i)\b({n}s?)\s*\(\s*{n}s?\s*\)", r"\1") for n in _FULL]), "standard", " ",
    rf"regexp_replace({_TRIM}, '([\p{{L}}\p{{N}}_]+)-[Cc]ells?\b', '\1 cell', 'g') AS hyphen",
    rf"list_transform(regexp_split_to_array(hyphen, '\([^)]*\)'), lambda x: {_SPELLED}) AS outside, regexp_extract_all(hyphen, '\([^)]*\)') AS inside",
    "array_to_string(list_transform(list_zip(outside, inside), lambda z: coalesce(z[1], '') || coalesce(z[2], '')), '') AS spelled"))
def x11_cell_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _applied(spark, sf_dir, CELLS, "standard", names.standard_cell)


@query(_over(CELLS, _replaced("bare", [(rf"(?i)\b{h}s$", h) for h in tables.PLURAL_HEADS]), "standard", " ", f"trim(regexp_replace({_TRIM}, {_Q(tables.TRAILING_ABBREVIATION)}, '', 'g')) AS bare"))
def x12_singular_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _applied(spark, sf_dir, CELLS, "standard", lambda c: names.singular(names.without_abbreviation(c)))


_KEY_TEXT = "trim(regexp_replace(regexp_replace(" + reduce(lambda c, kv: f"replace({c}, '{kv[0]}', '{kv[1]}')", tables.GREEK_NAMES.items(), f"lower({_TRIM})") + r", '[-_/]+', ' ', 'g'), '\s+', ' ', 'g')) AS k"


def _broad_sql(rules_: list[tuple[str, str]]) -> str:
    return f"CASE WHEN k = '' THEN '' WHEN {_has('k', tables.BROAD_PLURIPOTENT)} AND NOT {_has('k', tables.BROAD_NOT_PLURIPOTENT)} THEN 'induced pluripotent stem cell' ELSE {_first('k', rules_, _TRIM)} END"


@query(_over(CELLS, _broad_sql(tables.BROAD_SHARED + tables.BROAD_TARGET), "broad", " ", _KEY_TEXT))
def x14_broad_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _applied(spark, sf_dir, CELLS, "broad", lambda c: duplicates.broad_class(c, "target"))


@query(_over(CELLS, _broad_sql(tables.BROAD_SHARED), "broad", " ", _KEY_TEXT))
def x14_broad_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _applied(spark, sf_dir, CELLS, "broad", lambda c: duplicates.broad_class(c, "source"))


@query(_over(CELLS, "CASE " + " ".join(f"WHEN {_has('t', found)} AND NOT {_has('t', unless)} THEN {_Q(usual)}" for found, unless, usual in tables.CANONICAL_TARGETS) + " ELSE t END", "target", " ", f"{_TRIM} AS t"))
def x15_canonical_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _applied(spark, sf_dir, CELLS, "target", rules.canonical_target)


@query(_over(CELLS, "array_to_string(list_filter([" + ", ".join(f"CASE WHEN {_has('lower(given)', p, '')} THEN {_Q(n)} END" for n, p in tables.CELL_CATEGORIES.items()) + "], lambda x: x IS NOT NULL), ', ')", "categories"))
def x16_category_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _applied(spark, sf_dir, CELLS, "categories", lambda c: F.array_join(text.labels_found(F.lower(c), tables.CELL_CATEGORIES), ", "))


_ORDER = "[" + ", ".join(map(_Q, tables.SPECIES_ORDER)) + "]"


def _species_steps(column: str) -> tuple[str, str]:
    known = f"list_transform({_items(column, ',/;')}, lambda x: {_mapped('x', tables.SPECIES_ALIASES, 'x')}) AS l"
    return known, f"array_to_string(list_concat(list_filter({_ORDER}, lambda x: list_contains(l, x)), list_filter(l, lambda x, i: NOT list_contains({_ORDER}, x) AND list_position(l, x) = i)), ', ') AS known"


@query(_over(SPECIES, "known", "species", ", ", f"lower({_TRIM}) AS low", *_species_steps("low")))
def x22_species_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _applied(spark, sf_dir, SPECIES, "species", text.species, ", ")


@query(_over(SPECIES, "CASE WHEN low IN ('', 'unknown', 'not specified', 'na', 'n, a', 'unclear') THEN 'unclear' WHEN known IN (" + ", ".join(map(_Q, tables.STRICT_SPECIES)) + ") THEN known ELSE 'other' END", "species", ", ",
    f"replace(replace(lower({_TRIM}), ' and ', ', '), '/', ', ') AS low", *_species_steps("low")))
def x22_strict_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _applied(spark, sf_dir, SPECIES, "species", text.strict_species, ", ")


def _one_of(names_: tuple[str, ...]) -> str:
    return f"^({'|'.join(names_)})$"


@query(_over(FACTORS, f"CASE WHEN {_has('low', tables.MIRNA, '')} THEN 'miRNA' WHEN {_has('low', tables.KNOCKDOWN, '')} THEN 'knockdown' WHEN {_has('low', _one_of(tables.CYTOKINES), '')} THEN 'cytokine' "
    f"WHEN {_has('low', _one_of(tables.SMALL_MOLECULES), '')} THEN 'small_molecule' WHEN gene IN ({', '.join(map(_Q, tables.KNOWN_TF))}) THEN 'TF' ELSE 'other' END", "type", " ",
    rf"lower({_TRIM}) AS low, regexp_replace(translate(trim(regexp_replace(given, '\([^)]*\)', '', 'g')), 'αβ', 'AB'), '^[hm]([A-Z])', '\1') AS g",
    "upper(regexp_replace(regexp_replace(regexp_replace(g, 'c-MYC|cMYC|C-MYC', 'MYC', 'g'), 'OCT3/4|POU5F1', 'OCT4', 'g'), '[^A-Za-z0-9]', '', 'g')) AS gene"))
def x24_type_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _applied(spark, sf_dir, FACTORS, "type", rules.factor_type)


_PLAIN_TOKENS = r"regexp_replace(regexp_replace(replace(replace(lower(trim(given)), 'β', 'beta'), 'α', 'alpha'), '[-_/]+', ' ', 'g'), '[^a-z0-9 ]+', '', 'g') AS plain"


@query(_over(FACTORS, f"array_to_string(list_sort(list_distinct(list_transform(list_filter(string_split(plain, ' '), lambda w: w <> ''), lambda w: {_mapped('w', tables.TOKEN_ALIASES, 'w')}))), ' ')", "tokens", ", ", _PLAIN_TOKENS))
def x34_token_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _applied(spark, sf_dir, FACTORS, "tokens", lambda c: F.array_join(rules.token_set(c), " "), ", ")


@query(_over(FACTORS, "NOT (low = '' OR low IN (" + ", ".join(map(_Q, tables.MISSING_FACTORS)) + ") OR " + " OR ".join(_has("low", p, "") for p in tables.GENERIC_FACTORS) + ") AND len(list_filter(items, lambda p: "
    + _has("p", tables.NAMED_FACTOR, "") + ")) > 0", "specific", ", ", f"lower({_TRIM}) AS low, {_items('given', ',;')} AS items"))
def f13_specific_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _applied(spark, sf_dir, FACTORS, "specific", rules.is_specific, ", ")


def _status_sql() -> str:
    # Word ends know ASCII letters alone in the oracle's engine, so the Greek letter is spelled in the patterns and the name.
    spelled = lambda p: p.replace("Α", "QALPHA")
    chain = f"CASE WHEN {_has('up', spelled(tables.STANDALONE), '')} THEN 'standalone_valid'"
    for factor, targets in tables.STANDALONE_FOR:
        chain += f" WHEN {_has('up', spelled(factor), '')} THEN CASE WHEN {_has('lower(target)', targets, '')} THEN 'standalone_valid' ELSE 'unclear' END"
    return chain + f" WHEN {_has('up', tables.COCKTAIL, '')} THEN 'cocktail_member' ELSE 'unclear' END"


_TARGET = _pick(CELLS, "(l_orderkey + l_linenumber)")


def _target() -> Column:
    return _picked(CELLS, F.col("l_orderkey") + F.col("l_linenumber"))



@query(_over(FACTORS, _status_sql(), "status", " ", rf"replace(upper(trim(regexp_replace(given, '\s+', ' ', 'g'))), 'Α', 'QALPHA') AS up, {_TARGET} AS target"))
def c3_status_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _names(spark, sf_dir, FACTORS).withColumn("status", names.single_status(F.col("given"), _target()))


def _species_in_names_sql() -> tuple[str, str]:
    context = tables.CELL_CONTEXT
    near = lambda w: rf"\b(?:{w})\b(?:\W+\w+){{0,6}}\W+(?:{context})\b|\b(?:{context})\b(?:\W+\w+){{0,6}}\W+\b(?:{w})\b"
    found = {n: _has(_TRIM, "|".join(([near(w)] if n != "zebrafish" else []) + list(tables.SPECIES_LINES.get(n, ())))) for n, w in tables.SPECIES_WORDS.items()}
    found["human"] = f"({found['human']} OR {_has(_TRIM, tables.HUMAN_DERIVED)})"
    hits = "list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in found.items()) + "], lambda x: x IS NOT NULL) AS hits"
    return hits, "CASE WHEN len(hits) = 1 THEN hits[1] WHEN array_to_string(hits, ',') = 'human,mouse' THEN 'human, mouse' ELSE '' END"


@query(_over(CELLS, _species_in_names_sql()[1], "species", " ", _species_in_names_sql()[0]))
def c6_species_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _applied(spark, sf_dir, CELLS, "species", rules.species_in_names)


_TITLES = ("direct conversion of cells", "lineage switch", "partial reprogramming", "in vivo reprogramming of glia", "lineage plasticity", "a phenotypic conversion", "cells of the inner ear", "a study of cells", "")
_SCOPED = f"{_TARGET} AS t, CASE WHEN l_orderkey % 3 = 0 THEN {_pick(_TITLES, 'l_orderkey')} ELSE '' END AS title"


def _scope_sql() -> str:
    t = tables
    both, unlike = "(trim(given) <> '' AND trim(t) <> '')", "(trim(given) <> '' AND trim(t) <> '' AND lower(trim(given)) <> lower(trim(t)))"
    all_ = lambda p: _has("lower(given || ' ' || t || ' ' || title || ' ')", p)
    chain = [
        (_has("t", "|".join(t.PLURIPOTENT_TARGET)), "classical_reprogramming"), (_has("given", t.STEM_SOURCE), "directed_differentiation"), (all_(t.LINEAGE_WORDS), "lineage_conversion"),
        (all_("|".join(t.STATE_WORDS)), "cell_state_modulation"), (f"{_has('given', t.TUMOUR_SOURCE)} AND {_has('t', t.TUMOUR_TARGET)}", "cell_state_modulation"),
        (f"{_has('t', t.SKELETAL_TARGET)} AND {_has('given', t.SKELETAL_SOURCE)}", "directed_differentiation"), (f"{_has('t', t.BONE_TARGET)} AND {both}", "lineage_conversion"),
        (f"{all_(t.INNER_EAR)} AND {unlike}", "lineage_conversion"), (f"{all_(t.RETINA)} AND {both}", "lineage_conversion"), (f"{all_(t.GERMLINE)} AND {unlike}", "lineage_conversion"),
        (all_(t.IN_VIVO), "lineage_conversion"), (f"{all_(t.INNATE + '|' + t.COMMON_CELLS)} AND {unlike}", "lineage_conversion"),
    ]
    return "CASE " + " ".join(f"WHEN {c} THEN '{v}'" for c, v in chain) + " ELSE 'unclear' END"


@query(_over(CELLS, _scope_sql(), "scope", " ", _SCOPED))
def c1_scope_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.when(F.col("l_orderkey") % 3 == 0, _picked(_TITLES, F.col("l_orderkey"))).otherwise("")
    return _names(spark, sf_dir, CELLS).withColumn("scope", rules.conversion_scope(F.col("given"), _target(), title, F.lit("")))


_SAID = ("cells of the human and mouse embryo", "transplanted hESC in a mouse model", "murine tissue", "rats and pigs", "bovine", "a study of cells", "patient-derived cells", "cow", "")
_READ = ("swine", "no species", "zebrafish larvae", "human donors")
_GIVEN = "CASE WHEN l_linenumber = 1 AND l_orderkey % 3 = 0 THEN 'Mice' WHEN l_linenumber = 2 AND l_orderkey % 5 = 0 THEN 'cow' ELSE '' END"
_EARLIER = "CASE WHEN l_orderkey % 15 = 0 THEN 'fulltext' ELSE '' END"


def _species_in_text_sql(column: str) -> str:
    found = {n: _has(column, "|".join(p)) for n, p in tables.SPECIES_IN_TEXT.items()}
    found["human"] = f"({found['human']} OR {_has(column, tables.HUMAN_DERIVED)})"
    hits = "list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in found.items()) + "], lambda x: x IS NOT NULL)"
    pair, graft = f"array_to_string({hits}, ',') = 'human,mouse'", f"{_has(column, tables.HUMAN_CELLS)} AND {_has(column, tables.GRAFTS)}"
    return f"CASE WHEN len({hits}) = 1 THEN ({hits})[1] WHEN {pair} AND {_has(column, tables.HUMAN_AND_MOUSE)} THEN 'human, mouse' WHEN {pair} AND {graft} THEN 'human' ELSE '' END"


def _voted_sql(of: str, to: str) -> str:
    """A view ``to`` of ``of`` after a vote."""
    return f"""{to}_v AS (SELECT pmid, species AS v, count(*) AS n FROM {of} WHERE species <> '' GROUP BY ALL), {to}_m AS (SELECT pmid, CASE WHEN count(*) = 1 THEN min(v) END AS won FROM {to}_v
        WHERE n = (SELECT max(n) FROM {to}_v o WHERE o.pmid = {to}_v.pmid) GROUP BY pmid),
    {to} AS (SELECT {of}.* REPLACE (CASE WHEN species = '' AND won IS NOT NULL THEN 'same_pmid_vote' ELSE method END AS method, CASE WHEN species = '' AND won IS NOT NULL THEN won ELSE species END AS species) FROM {of} LEFT JOIN {to}_m USING (pmid))"""


def _inferred_sql(of: str, to: str, value: str, method: str) -> str:
    return f"{to} AS (SELECT * REPLACE (CASE WHEN species = '' AND {value} <> '' THEN '{method}' ELSE method END AS method, CASE WHEN species = '' AND {value} <> '' THEN {value} ELSE species END AS species) FROM {of})"


@query(f"""WITH a AS (SELECT l_orderkey, l_linenumber, l_orderkey AS pmid, given, CASE WHEN {_EARLIER} <> '' THEN '' WHEN {_GIVEN} = 'Mice' THEN 'mouse' WHEN {_GIVEN} = 'cow' THEN 'bovine' ELSE '' END AS species,
        CASE WHEN {_EARLIER} = '' AND {_GIVEN} <> '' THEN 'existing' ELSE '' END AS method, CASE WHEN l_linenumber % 2 = 0 THEN '' ELSE {_pick(_SAID, "l_orderkey")} END AS title, {_pick(_READ, "l_orderkey")} AS body
        FROM ({_over(CELLS, "given", "name")})), n AS (SELECT *, {_species_in_names_sql()[1]} AS in_names, {_species_in_text_sql("title")} AS in_title, CASE WHEN l_orderkey % 2 = 0 THEN {_species_in_text_sql("body")} ELSE '' END AS in_body
        FROM (SELECT *, {_species_in_names_sql()[0]} FROM a)),
    {_inferred_sql("n", "b", "in_names", "cell_fields")}, {_voted_sql("b", "c")}, {_inferred_sql("c", "d", "in_title", "title_abstract_evidence")}, {_voted_sql("d", "e")},
    {_inferred_sql("e", "f", "in_body", "fulltext")}, {_voted_sql("f", "g")} SELECT l_orderkey, l_linenumber, species, method AS species_method FROM g""")
def m12_species_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All passes, full texts too; what an earlier run filled in is taken back."""
    rows = _names(spark, sf_dir, CELLS).withColumns({
        "pmid": F.col("l_orderkey"), "source_cell": F.col("given"), "target_cell": F.lit(""), "evidence_sentence": F.lit(""), "species": F.expr(_GIVEN), "species_method": F.expr(_EARLIER),
        "title": F.when(F.col("l_linenumber") % 2 == 0, "").otherwise(_picked(_SAID, F.col("l_orderkey"))),
    })
    texts = table(spark, sf_dir, "lineitem").filter("l_orderkey % 2 = 0").select(F.col("l_orderkey").alias("pmid"), _picked(_READ, F.col("l_orderkey")).alias("text")).distinct()
    return curation.impute_species(rows, texts).select("l_orderkey", "l_linenumber", "species", "species_method")


_BLOB = r"trim(regexp_replace(k, '[^a-z0-9]+', ' ', 'g')) AS n"


@query(_over(CELLS, r"regexp_matches(blob, '\bt\s+cell|\bt\s+lymphocyte|\bcd4|\bcd8|\btreg|\bth1|\bth17|\btcell') AS t_cell, "
    r"regexp_matches(blob, '\bcardiomyocyte|\bcardiac|\bheart\s+muscle') AND regexp_matches(blob, '\bfibroblast') AS two_units, regexp_matches(blob, '\bips|\binduced\s+pluripotent|\bipsc') AS ips, "
    r"regexp_matches(blob, '\bmotor\s+neuron')", "phrase", " ", _KEY_TEXT, _BLOB, "n || ' ' || replace(n, ' ', '') AS blob"))  # fmt: skip
def q1_synonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Searches by a word's synonyms, by two of them at once, and by words that stay together."""
    asked = {"t_cell": "T-cells", "two_units": "cardiomyocytes Fibroblasts", "ips": "iPS", "phrase": "motor neurons"}
    rows = _names(spark, sf_dir, CELLS).withColumn("blob", text.search_blob(F.col("given")))
    return rows.select("l_orderkey", "l_linenumber", "given", *[filters.search(q, F.col("blob")).alias(n) for n, q in asked.items()])


_ASKED = {"t_cell": "T-cells", "two_units": "cardiomyocytes Fibroblasts", "ips": "iPS", "phrase": "motor neurons"}


@query(" UNION ALL ".join(f"SELECT DISTINCT '{name}' AS asked, l_orderkey, l_linenumber, given FROM ({ORACLE_SQL['q1_synonyms']}) WHERE {name}" for name in _ASKED))
def q1_indexed_synonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same searches over an inverted index: synonyms, two units, beginnings of words, and phrases by their places."""
    rows = _names(spark, sf_dir, CELLS).withColumn("key", F.struct("l_orderkey", "l_linenumber", "given"))  # a line of an order comes several times
    index, out = inverted.build(rows, "key", "given"), None
    for name, query_ in _ASKED.items():
        one = inverted.search(index, query_).select(F.lit(name).alias("asked"), "key.*")
        out = one if out is None else out.unionByName(one)
    return out


@query(_over(CELLS, f"regexp_matches(lower(given), {_Q(tables.T_CELL)}) AS strict, regexp_matches(lower(given || ' ' || {_pick(_SAID, 'l_orderkey')}), {_Q(tables.IMMUNE)}) AS broad, l_orderkey % 2 = 0", "even"))
def f12_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strict topic looks at the names of cells, the broad one at titles as well."""
    blank = {c: F.lit("") for c in ("target_cell", "source_cell_std", "target_cell_std", "source_cell_broad", "target_cell_broad", "evidence_sentence")}
    rows = _names(spark, sf_dir, CELLS).withColumns(blank | {"source_cell": F.col("given"), "title": _picked(_SAID, F.col("l_orderkey"))})
    return rows.select("l_orderkey", "l_linenumber", "given", rules.on_topic(tables.T_CELL, False).alias("strict"), rules.on_topic(tables.IMMUNE, True).alias("broad"), (F.col("l_orderkey") % 2 == 0).alias("even"))
