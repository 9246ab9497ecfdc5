"""Tree and tip tables over whole tree collections (tree_id, newick)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import column_of, first_present, present, spread_missing

TIP_COLUMNS = ("tip_id", "species", "transcript_id", "gene_id", "label", "Pfam_ids", "KEGG_ko", "description")


def newick_tips(trees: DataFrame) -> DataFrame:
    """Names in each tree in reading order (tree_id, position, tip); numbers are branch lengths or supports."""
    tokens = trees.select("tree_id", F.posexplode(F.split("newick", r"[(),:;\s]+")).alias("position", "tip"))
    return tokens.filter((F.col("tip") != "") & ~F.col("tip").rlike(r"^[0-9. Ee+-]+$"))


def rename_tips(trees: DataFrame, labels: DataFrame) -> DataFrame:
    """Trees with tips relabelled (labels: tip_id, label); unknown tips keep their name.

    Trees are taken apart into tokens, tips join their labels, and each tree is put together
    again in order. A label loses the characters that have a meaning in tree text. The text made is taken
    apart again and its tips are held against those before: a tree that has lost or gained one, or in which a
    name has become a number that reads as a branch length, is an error when the plan runs.
    ``repeated_tips`` lists names that stand more than once in a tree now.
    """
    token = r"[:(),]|[^:(),]+"
    tokens = trees.select("tree_id", F.regexp_extract_all(F.trim("newick"), F.lit(token), F.lit(0)).alias("_t"))
    rows = tokens.select("tree_id", F.posexplode("_t").alias("position", "token"), "_t").select(
        "tree_id", "position", "token", F.get("_t", F.col("position") - 1).isin("(", ",").alias("_after"),
        F.get("_t", F.col("position") + 1).isin(":", ")", ",").alias("_before"))
    is_tip = F.col("_after") & F.col("_before") & ~F.col("token").isin(":", "(", ")", ",")
    names = labels.select(F.col("tip_id").alias("_tip"), F.regexp_replace(F.coalesce(present(F.col("label"), ("",)), F.col("tip_id")), r"[\s,:();]+", "_").alias("_new"))
    names = names.groupBy("_tip").agg(F.max("_new").alias("_new"))
    keyed = rows.withColumn("_is_tip", is_tip).withColumn("_tip", spread_missing(F.when(is_tip, F.col("token")), "tree_id", "position"))
    renamed = keyed.join(names, "_tip", "left").select("tree_id", "position", "token", F.coalesce("_new", "token").alias("_made"), "_is_tip")
    number = lambda c: c.rlike(r"^[0-9. Ee+-]+$")
    rebuilt = renamed.groupBy("tree_id").agg(
        F.array_sort(F.collect_list(F.struct("position", "_made"))).alias("_p"), F.count_if("_is_tip").alias("tips"),
        F.count_if(F.col("_is_tip") & ~number(F.col("token")) & number(F.col("_made"))).alias("_numbers"))
    again = rebuilt.select("*", F.array_join(F.transform("_p", lambda p: p["_made"]), "").alias("newick")).withColumn("_t", F.regexp_extract_all("newick", F.lit(token), F.lit(0)))

    def tip_at(x: Column, i: Column) -> Column:
        return F.get("_t", i - 1).isin("(", ",") & F.get("_t", i + 1).isin(":", ")", ",") & ~x.isin(":", "(", ")", ",")

    found = again.withColumn("_tips", F.filter("_t", tip_at))
    kept = (F.size("_tips") == F.col("tips")) & (F.col("_numbers") == 0)
    lost = F.raise_error(F.concat(F.lit("relabelling changed the tips of tree "), F.col("tree_id").cast("string")))
    ordered = F.array_sort("_tips")
    repeated = F.array_distinct(F.filter(ordered, lambda x, i: (i > 0) & (x == F.get(ordered, i - 1))))
    return found.filter(F.when(kept, True).otherwise(lost.cast("boolean"))).select("tree_id", "newick", "tips", repeated.alias("repeated_tips"))


def tip_annotation(annotation: DataFrame, id_map: DataFrame | None = None) -> DataFrame:
    """Tip table from the annotation, under mapped ids when an id map is given."""
    def note(name: str) -> Column:
        col = column_of(annotation, name)
        return (col.cast("string") if col is not None else F.lit(None).cast("string")).alias(name)

    notes = annotation.select(first_present(annotation, ["transcript_id", "gene_id"]).alias("transcript_id"), F.struct(
        note("species"), note("gene_id"), note("Pfam_ids"), note("KEGG_ko"), note("SwissProt_description")).alias("_a")).groupBy("transcript_id").agg(F.max("_a").alias("_a"))
    if id_map is None:
        rows = notes.withColumn("tip_id", F.col("transcript_id")).withColumn("species", F.col("_a.species"))
    else:
        tips = id_map.select(
            first_present(id_map, ["prefixed_id", "tip_id"]).alias("tip_id"),
            F.coalesce(first_present(id_map, ["original_id", "transcript_id"]), first_present(id_map, ["prefixed_id", "tip_id"])).alias("transcript_id"),
            first_present(id_map, ["prefix"]).alias("species")).filter("tip_id is not null").dropDuplicates(["tip_id"])
        rows = tips.join(notes, "transcript_id", "left")
    return rows.select(
        "tip_id", "species", "transcript_id", "_a.gene_id", F.col("tip_id").alias("label"), "_a.Pfam_ids", "_a.KEGG_ko",
        F.col("_a.SwissProt_description").alias("description"))


def function_tip_table(targets: DataFrame, annotation: DataFrame | None = None, outgroups: DataFrame | None = None, markers: DataFrame | None = None) -> DataFrame:
    """Tips of a function tree: targets with annotation, outgroups and markers, each marked with its group."""
    nothing = F.lit(None).cast("string")
    own = targets.select(F.col("gene_id").cast("string").alias("tip_id")).distinct()
    if annotation is not None:
        notes = annotation.select(first_present(annotation, ["transcript_id", "gene_id"]).alias("tip_id"), F.struct(
            first_present(annotation, ["species"]).alias("species"), first_present(annotation, ["gene_id"]).alias("gene_id"),
            first_present(annotation, ["Pfam_ids"]).alias("Pfam_ids"), first_present(annotation, ["KEGG_ko", "Kofam_ko"]).alias("KO_ids")).alias("_a")).groupBy("tip_id").agg(F.max("_a").alias("_a"))
        own = own.join(notes, "tip_id", "left")
    else:
        own = own.withColumn("_a", F.lit(None).cast("struct<species:string,gene_id:string,Pfam_ids:string,KO_ids:string>"))
    out = own.select("tip_id", F.lit("target").alias("source_group"), "_a.species", F.col("tip_id").alias("transcript_id"), "_a.gene_id", "_a.Pfam_ids", "_a.KO_ids", nothing.alias("note"))

    def plain(ids: DataFrame, column: str, group: str, species: str | None, note: str | None) -> DataFrame:
        return ids.select(F.col(column).cast("string").alias("tip_id")).distinct().select(
            "tip_id", F.lit(group).alias("source_group"), F.lit(species).cast("string").alias("species"), F.col("tip_id").alias("transcript_id"),
            nothing.alias("gene_id"), nothing.alias("Pfam_ids"), nothing.alias("KO_ids"), F.lit(note).cast("string").alias("note"))

    if outgroups is not None:
        out = out.unionByName(plain(outgroups, "gene_id", "outgroup", "outgroup", None))
    if markers is not None:
        out = out.unionByName(plain(markers, "seqid", "marker", None, "marker"))
    return out


def gene_tree_status(
    trees: DataFrame, alignments: DataFrame, models: DataFrame | None = None, failed: DataFrame | None = None
) -> DataFrame:
    """Every gene tree with its alignment size and model, and the orthogroups whose tree failed.

    ``trees`` has tree_file; ``alignments`` orthogroup, seq; ``models`` orthogroup, best_model;
    ``failed`` orthogroup, failed_reason.
    """
    name = F.regexp_replace(F.element_at(F.split("tree_file", "/"), -1), r"\.treefile$", "")
    name = F.regexp_replace(F.regexp_replace(name, r"\.renamed\.tree$", ""), r"\.rooted\.tree$", "")
    done = trees.filter(F.trim("tree_file") != "").select(name.alias("orthogroup"), F.trim("tree_file").alias("tree_file"))
    sizes = alignments.groupBy("orthogroup").agg(F.count(F.lit(1)).alias("sequence_count"), F.max(F.length("seq")).alias("alignment_length"))
    rows = done.join(sizes, "orthogroup", "left")
    if models is not None:
        rows = rows.join(models.groupBy("orthogroup").agg(F.min("best_model").alias("best_model")), "orthogroup", "left")
    else:
        rows = rows.withColumn("best_model", F.lit(None).cast("string"))
    out = rows.select("orthogroup", F.lit("success").alias("status"), "tree_file", F.coalesce("sequence_count", F.lit(0)).cast("bigint").alias("sequence_count"),
                      F.coalesce("alignment_length", F.lit(0)).cast("bigint").alias("alignment_length"), "best_model", F.lit(None).cast("string").alias("failed_reason"))
    if failed is None:
        return out
    lost = failed.groupBy("orthogroup").agg(F.max("failed_reason").alias("failed_reason")).join(done.select("orthogroup"), "orthogroup", "left_anti")
    return out.unionByName(lost.select(
        "orthogroup", F.lit("failed").alias("status"), F.lit(None).cast("string").alias("tree_file"), F.lit(0).cast("bigint").alias("sequence_count"),
        F.lit(0).cast("bigint").alias("alignment_length"), F.lit(None).cast("string").alias("best_model"), "failed_reason"))


def resolve_truncated_ids(tips: DataFrame, full_ids: DataFrame, min_shared: int = 5) -> DataFrame:
    """Full id of each cut-off tip name (tips: tip; full_ids: seqid) with how it was found.

    A name that is a full id stays. A name that starts exactly one full id becomes that id. A
    name that starts none takes the id sharing the longest beginning, if that is long enough
    and only one id shares it. Full ids are counted per beginning, so a beginning shared by
    very many ids is one row and no pair is listed.
    """
    names = tips.select("tip").distinct()
    ids = full_ids.select("seqid").distinct()
    starts = ids.select("seqid", F.explode(F.sequence(F.lit(1), F.length("seqid"))).alias("_n")).select(
        F.substring(F.col("seqid"), F.lit(1), F.col("_n")).alias("prefix"), "seqid").groupBy("prefix").agg(
        F.count(F.lit(1)).alias("_ids"), F.min("seqid").alias("_id"))
    cuts = names.select("tip", F.explode(F.sequence(F.lit(1), F.length("tip"))).alias("_n")).select(
        "tip", F.substring(F.col("tip"), F.lit(1), F.col("_n")).alias("prefix"), "_n")
    longest = cuts.join(starts, "prefix").groupBy("tip").agg(F.max(F.struct("_n", "_ids", "_id")).alias("_l")).select("tip", "_l.*")
    exact = names.join(ids, names["tip"] == ids["seqid"], "left_semi").select("tip", F.lit(True).alias("_exact"))
    rows = names.join(longest, "tip", "left").join(exact, "tip", "left")
    whole = F.col("_n") == F.length("tip")
    status = (
        F.when(F.col("_exact"), "exact").when(whole & (F.col("_ids") == 1), "prefix").when(whole, "ambiguous")
        .when((F.col("_n") >= min_shared) & (F.col("_ids") == 1), "shared_beginning").otherwise("unresolved"))
    return rows.withColumn("status", status).select(
        "tip", F.when(F.col("status").isin("prefix", "shared_beginning"), F.col("_id")).otherwise(F.col("tip")).alias("resolved"), "status")
