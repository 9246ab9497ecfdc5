"""From raw documents to token ids: quality rules, near-duplicate removal, decontamination, mixing, token output.

Each stage takes (spark, docs, sf_dir) and returns a frame; all but the last return the columns of
``docs``. Every stage's result is written as Parquet and read again before the next, so a lost
executor costs tasks of one stage only.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lociframe.llm.decontamination import decontaminate
from lociframe.llm.entropy_mixing import mix
from lociframe.llm.jaccard_join import link
from lociframe.llm.queries import table, token_output
from lociframe.llm.store import written
from lociframe.llm.weak_rules import fit, judge, measure

#: The stages' verdicts come from fitted models and a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the aggregated votes keep."""
    measured = written(measure(docs), "pipeline-measured")
    return judge(measured, fit(measured)).filter("_verdict.kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links connect, the one of the lowest id; documents without words all stay.

    Null ids come after all others. Rows equal in id and text are one document.
    """
    linked = written(link(docs), "pipeline-linked")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc_id"), F.col("tie").alias("tie")))
    winners = linked.filter("component is not null").groupBy("component").agg(first.alias("w")).select("w.doc_id", "w.tie")
    wordless = linked.filter("component is null").select("doc_id", "tie").distinct()
    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "tie")
    kept = winners.unionByName(wordless).select(name.alias("_name"), F.lit(True).alias("_kept"))
    row = F.concat_ws(":", F.coalesce(docs["doc_id"].cast("string"), F.lit("-")), F.xxhash64(docs["text"].cast("string")))
    documents = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_doc"), row.alias("_name")).join(kept, "_name")
    twin = F.row_number().over(Window.partitionBy("_name").orderBy("_kept"))
    return documents.withColumn("_twin", twin).filter("_twin = 1").select("_doc.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark")).filter("decontamination.n_hit = 0").select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mix(docs).withColumn("_copy", F.explode(F.array_repeat(F.lit(True), F.col("_mix.copies").cast("int")))).select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token store's digest of every document taken: doc_id, start, n_tokens, ids_crc32."""
    return token_output(docs)


STAGES = [
    ("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("mixing", mixing), ("token_ids", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
