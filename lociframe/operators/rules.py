"""Rule tables matched against annotation rows, similarity hits and seed lists.

Every rule has one key under which a value can meet it: its lower-cased pattern (exact rules and tokens), or,
for patterns that may stand anywhere, a part of three characters that a match must contain, the one
that the fewest patterns share. Values are spread over their own keys, joined with the rules on equality in
one pass whatever the number of rules, and the few that meet are compared in full. Only patterns without
such a part (shorter ones, and expressions with choices or groups) meet every value of their field. Rules
stay a table throughout; it is written once under its keys, and the driver sees which places and kinds of keys occur.
"""
from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import first_present, split_terms
from ..session import stored

GRAM = 3
#: Parts into which the values of one key are dealt.
SHARES = 64
#: Most keys of a place and kind that are looked for in each value one by one.
FEW = 64
ANNOTATION_TYPES = ("keyword", "pfam", "interpro", "ko", "go", "annotation")
TOKEN_TYPES = ("pfam", "interpro", "ko", "go")
HIT_TYPES = ("blast", "diamond")
SEED_TYPES = ("seed", "candidate")
RULE_COLUMNS = ("rule_id", "family_id", "family_name", "evidence_type", "field", "pattern", "match_mode", "score")
EVIDENCE_COLUMNS = (
    "gene_id", "family_id", "family_name", "evidence_type", "source_field", "rule_id", "matched_value", "evidence_score",
    "annotation_status",
)


def normalize_rules(raw: DataFrame, row_number: str | None = None) -> DataFrame:
    """Rule columns under alias names with their defaults; rules without a family are left out."""
    family = first_present(raw, ["family_id", "target_family", "family"])
    number = F.concat(F.lit("rule_"), raw[row_number].cast("string")) if row_number else F.lit("rule")
    return raw.select(
        F.coalesce(first_present(raw, ["rule_id"]), number).alias("rule_id"), family.alias("family_id"),
        F.coalesce(first_present(raw, ["family_name"]), family).alias("family_name"),
        F.lower(first_present(raw, ["evidence_type", "type"], "keyword")).alias("evidence_type"),
        first_present(raw, ["field", "source_field"], "description").alias("field"),
        first_present(raw, ["pattern", "value", "term"], "").alias("pattern"),
        F.lower(first_present(raw, ["match_mode"], "contains")).alias("match_mode"),
        first_present(raw, ["score"], "1").alias("score"),
    ).filter("family_id is not null")


def _effective_mode() -> Column:
    """Term-like evidence that asks for ``contains`` compares whole terms."""
    termlike = F.col("evidence_type").isin(*TOKEN_TYPES) & (F.col("match_mode") == "contains")
    known = F.when(F.col("match_mode").isin("regex", "exact", "token"), F.col("match_mode")).otherwise("contains")
    return F.when(termlike, "token").otherwise(known)


def grams(text: Column) -> Column:
    """Distinct parts of three characters, in one pass of the regular expression engine."""
    return F.array_distinct(F.filter(F.regexp_extract_all(text, F.lit("(?s)(?=(.{3}))."), F.lit(1)), lambda g: F.length(g) == GRAM))


def needed_text(pattern: Column, mode: Column) -> Column:
    """Lower-cased stretches, parted by line breaks, that every match of a pattern contains; NULL where that is not plain to see."""
    literal = F.regexp_replace(pattern, r"\\.|\[[^\]]*\]", "\n")  # escapes and character classes
    plain = ~literal.rlike(r"[|()\[\]\\]") & ~pattern.rlike(r"\\Q|[^\x00-\x7F]")
    literal = F.regexp_replace(literal, r"(?s).(?:\?|\*|\{[^}]*\})", "\n")  # characters that may be absent or repeated
    literal = F.regexp_replace(literal, r"[.^$+]", "\n")
    return F.lower(F.when(mode == "contains", pattern).when(plain, literal))


def indexed(rules: DataFrame) -> DataFrame:
    """Rules with ``_key``, the text under which a value can meet them; its first character tells the kind."""
    patterns = rules.filter(F.col("mode").isin("contains", "regex")).select("pattern", "mode").distinct()
    parts = F.filter(F.flatten(F.transform(F.split(needed_text(F.col("pattern"), F.col("mode")), "\n"), grams)), lambda g: F.length(g) == GRAM)
    listed = patterns.select("pattern", "mode", F.explode(F.array_distinct(parts)).alias("_gram"))
    shared = listed.groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    rarest = listed.join(shared, "_gram").groupBy("pattern", "mode").agg(F.min(F.struct("_n", "_gram")).alias("_rarest"))
    kind = F.when(F.col("mode") == "exact", F.concat(F.lit("="), F.lower("pattern"))).when(F.col("mode") == "token", F.concat(F.lit(","), F.lower("pattern")))
    return rules.join(rarest, ["pattern", "mode"], "left").withColumn("_key", F.coalesce(kind, F.concat(F.lit("%"), F.coalesce("_rarest._gram", F.lit(""))))).drop("_rarest")


class Waiting:
    """The rules under their keys as a written table, and what a value has to be spread over to meet them.

    ``sides`` holds the first ``FEW`` + 1 keys by side, place and kind (whole value, term, part, all). The table is written so that
    its size is known: where rules are few, Spark's own size check sends them to the values, which then stay
    where they are; where they are many, both sides meet by key.
    """

    def __init__(self, rules: DataFrame):
        kind, pattern, asked = F.col("evidence_type"), F.col("pattern") != "", F.col("match_mode")
        known = F.when(asked.isin("regex", "exact", "token"), asked).otherwise("contains")
        side = F.when(kind.isin(*ANNOTATION_TYPES) & pattern, "annotation").when(kind.isin(*HIT_TYPES) & pattern, "hits").when(kind.isin(*SEED_TYPES), "seeds")
        mode = F.when(F.col("_side") == "annotation", _effective_mode()).when((F.col("_side") == "seeds") & ~pattern, "contains").otherwise(known)
        place = F.when(F.col("_side") == "annotation", F.col("field")).when(F.col("_side") == "seeds", "seed_ids").when(
            F.col("field").isin("subject", "subject_id", "description"), "subject").otherwise("line")
        used = rules.withColumn("_side", side).filter("_side is not null").withColumns({"mode": mode, "_place": place})
        self.rules = stored(indexed(used), "rules")
        kind = F.when(F.col("_key") == "%", "all").otherwise(F.substring("_key", 1, 1))
        keys = self.rules.select("_side", "_place", kind.alias("_kind"), "_key").distinct()
        ranked = keys.withColumn("_n", F.row_number().over(Window.partitionBy("_side", "_place", "_kind").orderBy("_key")))
        self.sides: dict[str, dict[str, dict[str, list[str]]]] = {}
        for r in ranked.filter(F.col("_n") <= FEW + 1).collect():
            self.sides.setdefault(r._side, {}).setdefault(r._place, {}).setdefault(r._kind, []).append(r._key)


def _keys(value: Column, waiting: Mapping[str, list[str]]) -> Column:
    """Keys of a value: those kinds that rules of its place wait under. Where few wait, they are looked for in the value."""
    whole = F.lower(F.coalesce(value, F.lit("")))

    def spread(kind: str, keys: list[str]) -> Column:
        if kind == "all":
            return F.array(F.lit("%"))
        if kind == ",":
            return F.transform(split_terms(F.lower(value), drop=("na",)), lambda t: F.concat(F.lit(","), t))
        if len(keys) <= FEW:
            has = (lambda k: whole == k[1:]) if kind == "=" else (lambda k: F.contains(whole, F.lit(k[1:])))
            return F.when(reduce(or_, [has(k) for k in keys]), F.array_compact(F.array(*[F.when(has(k), F.lit(k)) for k in keys]))).otherwise(F.array().cast("array<string>"))
        return F.array(F.concat(F.lit("="), whole)) if kind == "=" else F.transform(grams(whole), lambda g: F.concat(F.lit("%"), g))

    return F.concat(*[spread(kind, keys) for kind, keys in sorted(waiting.items())])


def _matches(rows: DataFrame, named: Mapping[str, Column], waiting: Waiting, side: str) -> DataFrame:
    """``rows`` with ``value`` of each place of ``named`` and the rules of that place and side that match it.

    ``rows`` must not carry names of rule columns. Only values of places where rules wait are made, and spread over those
    kinds of keys only. Each rule waits in ``SHARES`` places among which the values of a key are dealt, since many
    values (for patterns that meet all of them, every value) may have one key.
    """
    kinds = {p: k for p, k in waiting.sides.get(side, {}).items() if p in named}
    none = F.struct(F.lit("").alias("_place"), F.lit("").alias("value"), F.array().cast("array<string>").alias("_keys"))
    cells = [F.struct(F.lit(p).alias("_place"), named[p].alias("value"), _keys(named[p], k).alias("_keys")) for p, k in sorted(kinds.items())]
    values = rows.select(*rows.columns, F.inline(F.array(*(cells or [none]))))
    spread = values.withColumn("_key", F.explode("_keys")).drop("_keys").withColumn("_share", F.pmod(F.xxhash64("gene_id", "value"), F.lit(SHARES)))
    own = waiting.rules.filter(F.col("_side") == side).drop("_side")
    shared = own.withColumn("_share", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SHARES - 1).cast("bigint"))))
    met = spread.join(shared, ["_place", "_key", "_share"]).drop("_share")
    text = F.coalesce(F.col("value"), F.lit(""))
    found = F.when(F.col("mode") == "contains", F.contains(F.lower(text), F.lower("pattern"))).when(
        F.col("mode") == "regex", F.rlike(text, F.concat(F.lit("(?i)"), F.col("pattern")))).otherwise(True)
    return met.filter(found).drop("_place", "_key")


def _waiting(rules: DataFrame | Waiting) -> Waiting:
    return rules if isinstance(rules, Waiting) else Waiting(rules)


def _evidence(rows: DataFrame, source: Column, matched: Column, score: Column, status: Column) -> DataFrame:
    return rows.select(
        "gene_id", "family_id", "family_name", "evidence_type", source.alias("source_field"), "rule_id", matched.alias("matched_value"),
        score.alias("evidence_score"), status.alias("annotation_status"))


def annotation_evidence(annotation: DataFrame, rules: DataFrame | Waiting, id_column: str = "transcript_id") -> DataFrame:
    """Annotation rows matched by rules. The field ``description`` means the whole row, ``ko`` all KO columns."""
    gene = first_present(annotation, [id_column, "transcript_id", "gene_id", "query", "#query"])
    text = {c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in annotation.columns if not c.startswith("_")}
    named = {
        **text, "description": F.concat_ws("\t", *text.values()),
        "ko": F.concat_ws(";", *[text[c] for c in ("KEGG_ko", "Kofam_ko", "KO_ids") if c in text]),
    }
    rows = annotation.withColumn("_gene", gene).filter("_gene is not null and _gene <> 'NA'")
    waiting = _waiting(rules)
    values = {p: named[p] for p in waiting.sides.get("annotation", {}) if p in named}
    cells = rows.select(F.col("_gene").alias("gene_id"), *[v.alias(f"_value_{i}") for i, v in enumerate(values.values())])
    found = _matches(cells, {p: F.col(f"_value_{i}") for i, p in enumerate(values)}, waiting, "annotation")
    return _evidence(found, F.col("field"), F.col("pattern"), F.col("score"), F.lit("matched"))


def hit_evidence(hits: DataFrame, rules: DataFrame | Waiting, max_evalue: float | None = 1e-5, min_bitscore: float | None = None) -> DataFrame:
    """Hits whose subject (or, for other fields, whole line) matches a rule."""
    kept = hits
    if max_evalue is not None:
        kept = kept.filter(F.col("evalue") <= max_evalue)
    if min_bitscore is not None:
        kept = kept.filter(F.col("bitscore") >= min_bitscore)
    waiting = _waiting(rules)
    line = F.col("line") if "line" in hits.columns else F.concat_ws("\t", *[F.col(c).cast("string") for c in hits.columns])
    values = {"subject": F.col("_subject"), "line": F.col("_line")}
    wanted = [line.alias("_line")] if "line" in waiting.sides.get("hits", {}) else []
    rows = kept.select(F.col("query_id").cast("string").alias("gene_id"), F.col("subject_id").cast("string").alias("_subject"), "evalue", "bitscore", *wanted)
    found = _matches(rows, values if wanted else {"subject": values["subject"]}, waiting, "hits")
    return _evidence(found, F.col("field"), F.col("_subject"), F.format_string("%.6f", "bitscore"), F.concat(F.lit("evalue="), F.col("evalue").cast("string")))


def seed_evidence(seeds: DataFrame, rules: DataFrame | Waiting) -> DataFrame:
    """Seed genes under each seed rule; a seed rule without a pattern takes every seed."""
    ids = seeds.select(F.col("gene_id").cast("string")).distinct()
    return _evidence(_matches(ids, {"seed_ids": F.col("gene_id")}, _waiting(rules), "seeds"), F.lit("seed_ids"), F.col("gene_id"), F.col("score"), F.lit("seed_list"))


def family_evidence(
    annotation: DataFrame, rules: DataFrame, hits: DataFrame | None = None, seeds: DataFrame | None = None,
    id_column: str = "transcript_id", max_evalue: float | None = 1e-5, min_bitscore: float | None = None,
) -> DataFrame:
    """All evidence rows of the rule table, repeats kept."""
    waiting = Waiting(rules)
    out = annotation_evidence(annotation, waiting, id_column)
    if hits is not None:
        out = out.unionByName(hit_evidence(hits, waiting, max_evalue, min_bitscore))
    if seeds is not None:
        out = out.unionByName(seed_evidence(seeds, waiting))
    return out


def evidence_summary(evidence: DataFrame) -> DataFrame:
    """Genes, rows and evidence types per family; the types themselves are rows of ``evidence``."""
    return evidence.groupBy("family_id", "family_name").agg(
        F.countDistinct("gene_id").alias("selected_genes"), F.count(F.lit(1)).alias("evidence_rows"), F.countDistinct("evidence_type").alias("evidence_type_count"))
