"""Long to wide tables for plotting, and the other way round."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import MISSING, present, to_double
from .families import column_values


def membership_matrix(sets: Mapping[str, DataFrame], key: str = "gene_id") -> DataFrame:
    """0/1 membership of every gene in the named sets, with the number of sets."""
    union = None
    for name, ids in sets.items():
        rows = ids.select(F.col(key), F.lit(name).alias("_set"))
        union = rows if union is None else union.unionByName(rows)
    if union is None:
        raise ValueError("no set given")
    wide = union.groupBy(key).agg(*[F.max((F.col("_set") == n).cast("int")).alias(n) for n in sets])
    total = F.lit(0)
    for n in sets:
        total = total + F.col(n)
    return wide.withColumn("membership_count", total)


def membership_sizes(sets: Mapping[str, DataFrame], key: str = "gene_id") -> DataFrame:
    """Distinct genes per set."""
    union = None
    for name, ids in sets.items():
        rows = ids.select(F.col(key), F.lit(name).alias("set_name"))
        union = rows if union is None else union.unionByName(rows)
    return union.groupBy("set_name").agg(F.countDistinct(key).alias("gene_count"))


def pivot_values(df: DataFrame, row: str, column: str, value: Column | str, columns: Sequence[str] | None = None,
                 fill: object = 0) -> DataFrame:
    """Rows by columns with one value per cell (the largest of several), ``fill`` where absent."""
    columns = list(columns or column_values(df, column))
    value = F.col(value) if isinstance(value, str) else value
    cells = df.filter(F.col(row).isNotNull() & F.col(column).isNotNull()).select(F.col(row), F.col(column).alias("_c"), value.alias("_v"))
    return cells.groupBy(row).agg(*[F.coalesce(F.max(F.when(F.col("_c") == c, F.col("_v"))), F.lit(fill)).alias(c) for c in columns])


def expression_matrix(summary: DataFrame, samples: Sequence[str] | None = None) -> DataFrame:
    return pivot_values(summary, "family_id", "sample", "mean_expression", samples, 0.0)


def status_matrix(df: DataFrame, row: str, status: str, statuses: Sequence[str] | None = None) -> DataFrame:
    """1 where a row has the status."""
    return pivot_values(df, row, status, F.lit(1), statuses, 0)


def structure_matrix(metrics: DataFrame, species: Sequence[str] | None = None) -> DataFrame:
    """Metrics by species; a metric a species lacks stays NULL."""
    species = list(species or column_values(metrics, "species"))
    return metrics.groupBy("metric").agg(*[F.max(F.when(F.col("species") == s, F.col("value"))).alias(s) for s in species])


def plot_rows(distributions: DataFrame) -> DataFrame:
    """Distribution rows in plot form: the length where there is one, else the count."""
    value = F.coalesce(present(F.col("length").cast("string"), MISSING), F.col("count").cast("string"))
    return distributions.select(
        "species", F.col("category").alias("plot_group"), F.col("species").alias("x"), F.col("category").alias("y"),
        value.alias("value"), F.col("category").alias("source_category"))


def donor_fractions(matrix: DataFrame, donors: Sequence[str], key: str = "species") -> DataFrame:
    """Long donor counts and fractions of a wide matrix with a ``total`` column; zero cells are left out."""
    long = matrix.select(key, F.col("total").cast("bigint").alias("total_hgt"), *[F.col(d).cast("bigint").alias(d) for d in donors]).unpivot(
        [key, "total_hgt"], list(donors), "donor_group", "hgt_count")
    return long.filter("hgt_count <> 0").withColumn(
        "fraction", F.when(F.col("total_hgt") > 0, F.col("hgt_count") / F.col("total_hgt")).otherwise(F.lit(0.0)))


def gene_set_expression(expression: DataFrame, families: DataFrame) -> DataFrame:
    """Long expression rows of the genes of each family; cells that are no number are left out.

    ``expression`` has gene_id, sample, expression_value; ``families`` has gene_id, family_id.
    """
    rows = expression.select("gene_id", "sample", to_double(F.col("expression_value")).alias("expression_value")).filter("expression_value is not null")
    return rows.join(families.select("gene_id", "family_id").distinct(), "gene_id")


def long_expression(matrix: DataFrame, id_column: str = "gene_id") -> DataFrame:
    """gene/sample rows of a wide expression matrix."""
    samples = [c for c in matrix.columns if c != id_column and not c.startswith("_")]
    return matrix.select(F.col(id_column).alias("gene_id"), *[F.col(f"`{s}`").cast("string").alias(s) for s in samples]).unpivot(
        "gene_id", samples, "sample", "expression_value")


def family_map(evidence: DataFrame | None, targets: DataFrame | None) -> DataFrame:
    """Gene to family; listed genes without evidence belong to the family ``target``."""
    out = None
    if evidence is not None:
        out = evidence.select("gene_id", F.coalesce("family_id", F.lit("target")).alias("family_id")).distinct()
    if targets is not None:
        listed = targets.select("gene_id").distinct()
        if out is not None:
            listed = listed.join(out.select("gene_id"), "gene_id", "left_anti")
        listed = listed.withColumn("family_id", F.lit("target"))
        out = listed if out is None else out.unionByName(listed)
    if out is None:
        raise ValueError("give evidence or target ids")
    return out


def event_handoff(summary: DataFrame) -> DataFrame:
    """Node events for tree labels."""
    both = F.col("gain") + F.col("expansion")
    return summary.select("node", "parent", "gain", "expansion", F.when(F.col("hgt_gain_expansion") != 0, F.col("hgt_gain_expansion")).otherwise(both).alias("hgt_gain_expansion"))


def source_handoff(breakdown: DataFrame) -> DataFrame:
    """Donor sources of gains and expansions."""
    return breakdown.filter(F.col("event").isin("gain", "expansion")).select(
        "node", "event", F.col("majority_source").alias("donor_group"), "orthogroup_count")


def expression_summary(details: DataFrame) -> DataFrame:
    """Genes seen, mean, median and sum per family and sample."""
    from .summaries import grouped_median

    keys = ["family_id", "sample"]
    totals = details.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("genes_observed"), F.avg("expression_value").alias("mean_expression"), F.sum("expression_value").alias("sum_expression"))
    return totals.join(grouped_median(details, keys, "expression_value", "median_expression"), keys)
