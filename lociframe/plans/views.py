"""Domain views over the driver's parquet tables.

The text of each view runs unchanged in Spark and DuckDB, so a query and its check start from
the same rows. ``{x}`` names another view or table.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "features": """
        select concat('chr', cast(l_suppkey % 5 as string)) as seqid,
               (l_orderkey * 7919 + l_linenumber * 104729) % 1000000 as start0,
               (l_orderkey * 7919 + l_linenumber * 104729) % 1000000 + cast(l_quantity as bigint) * 10 as end0,
               l_returnflag as ftype,
               concat(cast(l_orderkey as string), '.', cast(l_linenumber as string)) as feature_id
        from lineitem""",
    "regions": """
        select concat('chr', cast(o_custkey % 5 as string)) as seqid,
               (o_orderkey * 15485863) % 1000000 as start0,
               (o_orderkey * 15485863) % 1000000 + 500 as end0,
               o_orderkey as region_id,
               case when o_orderstatus = 'F' then 'target' else 'background' end as region_set,
               case when o_custkey % 2 = 0 then '-' else '+' end as strand
        from orders""",
    "hits": """
        select l_orderkey as query_id, l_partkey as subject_id, l_discount * 1000 as pident,
               l_quantity * 2 as query_coverage, power(10.0, -l_quantity) as evalue,
               l_extendedprice / 100 as bitscore
        from lineitem""",
    "taxonomy": """
        select p_partkey as subject_id, p_type as scientific_name, p_brand as lineage,
               case when p_size <= 15 then 'ingroup_a' when p_size <= 35 then 'donor_a'
                    when p_size <= 45 then 'donor_b' else 'excluded_a' end as taxon_group
        from part""",
    "gene_terms": """
        select distinct l_orderkey as gene_id, p_brand as term_id
        from lineitem join part on l_partkey = p_partkey""",
    "foreground": "select o_orderkey as gene_id from orders where o_orderstatus = 'F'",
    "expression": "select user_id as gene_id, event_type as sample, value as expression_value from events",
    "family_counts": """
        select p_brand as family_id, n_name as species, count(*) as copies
        from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey
             join nation on s_nationkey = n_nationkey
        group by p_brand, n_name""",
    "node_counts": """
        select cast(p_size as string) || '/' || p_brand || '/' || p_type as family_id, n_name as species, count(*) as copies
        from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey
             join nation on s_nationkey = n_nationkey
        group by p_size, p_brand, p_type, n_name
        union all
        select cast(p_size as string) || '/' || p_brand || '/' || p_type as family_id, r_name as species,
               count(case when l_linenumber = 1 then 1 end) as copies
        from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey
             join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
        group by p_size, p_brand, p_type, r_name""",
    "node_parent": "select n_name as node, r_name as parent from nation join region on n_regionkey = r_regionkey",
    "sites": """
        select concat('chr', cast(l_suppkey % 5 as string)) as seqid,
               (l_orderkey * 7919 + l_linenumber * 104729) % 1000000 as pos0,
               case l_returnflag when 'A' then 'CG' when 'N' then 'CHG' else 'CHH' end as context,
               cast(l_quantity as bigint) as total,
               cast(floor(cast(l_quantity as bigint) * l_linenumber / 8) as bigint) as methylated,
               l_orderkey * 10 + l_linenumber as line_no
        from lineitem""",
    "dna": """
        select doc_id as seqid,
               translate(regexp_replace(lower(text), {not_letters}), 'abcdefghijklmnopqrstuvwxyz',
                         'ACGTACGTACGTACGTACGTACGTAC') as seq
        from documents""",
    "links": """
        select o_custkey as ref_gene, o_orderkey as query_gene, o_orderpriority as block_id,
               o_orderstatus as query_species
        from orders""",
}

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()

# The two engines spell "replace every match" differently.
SPARK_WORDS = {"not_letters": "'[^a-z]', ''"}
DUCKDB_WORDS = {"not_letters": "'[^a-z]', '', 'g'"}


def view_text(name: str, words: dict[str, str]) -> str:
    """The view's SQL with nested views and engine words filled in."""
    text = VIEWS[name]
    for other in VIEWS:
        if "{" + other + "}" in text:
            text = text.replace("{" + other + "}", view_text(other, words))
    for word, spelling in words.items():
        text = text.replace("{" + word + "}", spelling)
    return text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A domain view as a DataFrame over the tables of ``sf_dir``."""
    for needed in TABLES:
        if needed in view_text(name, SPARK_WORDS):
            table(spark, sf_dir, needed).createOrReplaceTempView(needed)
    return spark.sql(view_text(name, SPARK_WORDS))
