"""Gene structure from annotation features: introns, structure tables, primary transcripts and coding sequences.

Features carry species, seqid, type, start, end (1-based, closed), strand, id, parents, attrs and
``_row``, as ``sources.gff.read_gff`` returns them.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequence import cds_checks, count_bases, reverse_complement, translate_codons
from ..functions.text import spread_missing
from .intervals import POSITION_BIN
from .sequences import CHUNK
from ..session import stored
from .summaries import grouped_median, last_by, length_histogram

PRIMARY = r"(^|\.)t1($|\.)"
NUMBERED = r"\.t\d+($|\.)"
TRANSCRIPT_TYPES = ("mRNA", "transcript")


def _first_parent() -> Column:
    return F.get("parents", F.lit(0))


def segment_gaps(segments: DataFrame, keys: Sequence[str], bin_size: int = POSITION_BIN) -> DataFrame:
    """Gaps between consecutive segments (start, end; 1-based, closed) of the same keys.

    Each gap carries ``start0``/``end0`` (half-open), its number among all consecutive pairs and
    the strand of the segment before it. Equal segments are counted once with their number, and
    order is worked out bin by bin, the next bin's first segment being carried over, so one
    transcript with very many segments spreads over several tasks. Both levels read the same counts and filters, so
    Spark shuffles them once, and only bins of keys with several bins are joined back. Segments without key or start are left out.
    """
    keys = list(keys)
    place = [*keys, "_bin"]
    for known in (*keys, "start"):
        segments = segments.filter(F.col(known).isNotNull())
    counted = segments.withColumn("_bin", F.floor(F.col("start") / bin_size)).groupBy(*place, "start", "end", "strand").agg(F.count(F.lit(1)).alias("_n"))
    by_bin = Window.partitionBy(*keys).orderBy("_bin")
    bins = counted.groupBy(*place).agg(F.min("start").alias("_first"), F.sum("_n").alias("_count")).select(
        *place, F.lead("_first").over(by_bin).alias("_next_bin"),
        F.coalesce(F.sum("_count").over(by_bin.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before")).filter("_next_bin is not null or _before > 0")
    # The order that the segments of a bin are united in is the one their window needs.
    single = counted.repartition(*place).groupBy(*place, "start", "end").agg(F.sum("_n").alias("_n"), F.min("strand").alias("strand"))
    inside = Window.partitionBy(*place).orderBy("start", "end")
    placed = single.select(
        "*", F.lead("start").over(inside).alias("_next"), F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias("_upto"))
    return placed.join(bins, place, "left").select(
        *keys, F.col("end").alias("start0"), (F.coalesce("_next", "_next_bin") - 1).alias("end0"), "strand",
        (F.coalesce("_before", F.lit(0)) + F.col("_upto")).alias("gap_number")).filter("end0 > start0")


def transcript_genes(features: DataFrame) -> DataFrame:
    """Transcript to gene, by first parent or else by the gene_id/gene attribute."""
    attribute = F.coalesce(F.try_element_at("attrs", F.lit("gene_id")), F.try_element_at("attrs", F.lit("gene")))
    rows = features.filter(F.col("type").isin(*TRANSCRIPT_TYPES) & F.col("id").isNotNull()).select(
        "species", F.col("id").alias("transcript_id"), F.coalesce(_first_parent(), attribute).alias("gene_id"), "_row")
    return last_by(rows, ["species", "transcript_id"], "_row", ["gene_id"]).filter("gene_id is not null")


def introns(
    features: DataFrame, feature: str = "exon", min_short: int = 40, max_short: int = 65, genome: DataFrame | None = None,
    at_rich: float = 0.70, group_by: str = "transcript",
) -> DataFrame:
    """Introns between the exons (or CDS parts) of each transcript.

    ``group_by="gene_pooled"`` pools the segments of all transcripts of a gene. With ``genome``
    (species, seqid, seq) the A+T share of each intron is added; a sequence missing from it is an error.
    """
    attribute = F.coalesce(F.try_element_at("attrs", F.lit("gene_id")), F.try_element_at("attrs", F.lit("gene")))
    parts = features.filter(F.col("type") == feature).select(
        "species", "seqid", "start", "end", "strand", attribute.alias("_attr"), F.explode("parents").alias("transcript_id"))
    genes = transcript_genes(features)
    if group_by == "gene_pooled":
        named = parts.join(genes, ["species", "transcript_id"], "left").withColumn("gene_id", F.coalesce("_attr", "gene_id")).withColumn(
            "transcript_id", F.coalesce("gene_id", "transcript_id"))
        of_transcript = named.groupBy("species", "transcript_id").agg(F.min("gene_id").alias("gene_id"))
    else:
        # The least gene of a transcript's parts: their attributes, or its own gene for parts without one.
        named = parts
        of_transcript = parts.groupBy("species", "transcript_id").agg(F.min("_attr").alias("_attr"), F.bool_or(F.col("_attr").isNull()).alias("_plain")).join(
            genes, ["species", "transcript_id"], "left").select("species", "transcript_id", F.least("_attr", F.when(F.col("_plain"), F.col("gene_id"))).alias("gene_id"))
    found = segment_gaps(named, ["species", "transcript_id", "seqid"]).withColumnRenamed("gap_number", "intron_number")
    rows = found.join(of_transcript, ["species", "transcript_id"]).withColumn("length", F.col("end0") - F.col("start0"))
    rows = rows.withColumn("is_short_intron", F.col("length").between(min_short, max_short)).withColumn("source_feature", F.lit(feature))
    if genome is None:
        rows = rows.withColumn("at_content", F.lit(None).cast("double")).withColumn("is_at_rich", F.lit(None).cast("boolean"))
    else:
        share = interval_at_share(rows.select("species", "seqid", "start0", "end0").distinct(), genome)
        rows = rows.join(share, ["species", "seqid", "start0", "end0"], "left").withColumn("is_at_rich", F.col("at_content") >= at_rich)
    return rows.select(
        "species", "seqid", "start0", "end0", (F.col("start0") + 1).alias("start1"), F.col("end0").alias("end1"), "length", "strand", "gene_id",
        "transcript_id", "intron_number", "source_feature", "is_short_intron", "at_content", "is_at_rich")


def interval_pieces(intervals: DataFrame, chunks: DataFrame, lengths: DataFrame, size: int = CHUNK) -> DataFrame:
    """Sequence pieces of intervals (seqid, start0, end0, ...) cut from sequence chunks, with ``piece_start``.

    An interval on a sequence that is not there is an error; the part beyond a sequence's end is left out.
    """
    on_sequence = intervals.join(lengths.select("seqid", F.lit(1).alias("_known")), "seqid", "left").withColumn(
        "_known", F.when(F.col("_known").isNull(), F.raise_error(F.concat(F.lit("sequence not in genome: "), F.col("seqid")))).otherwise(F.col("_known")))
    spread = on_sequence.filter("end0 > start0 and _known = 1").drop("_known").withColumn("chunk_no", F.explode(F.sequence(
        F.floor(F.col("start0") / size).cast("int"), F.floor((F.col("end0") - 1) / size).cast("int"))))
    low = F.col("chunk_no").cast("bigint") * size
    first = F.greatest("start0", low)
    taken = (F.least("end0", low + size) - first).cast("int")
    joined = spread.join(chunks.select("seqid", "chunk_no", F.col("seq").alias("_chunk")), ["seqid", "chunk_no"])
    return joined.select(*intervals.columns, first.alias("piece_start"), F.substring(F.col("_chunk"), (first - low + 1).cast("int"), taken).alias("piece"))


def interval_at_share(intervals: DataFrame, genome: DataFrame) -> DataFrame:
    """A+T share of the A, C, G and T bases of each distinct interval (species, seqid, start0, end0); NULL without such bases.

    ``genome`` has species, seqid, seq, and start0 if it comes in pieces.
    """
    from .sequences import chunk_sequences, without_text

    joint = F.concat_ws("\t", "species", "seqid")
    keyed = without_text(genome.withColumn("seqid", joint), "seqid")
    own = intervals.select("species", F.col("seqid").alias("_seqid"), joint.alias("seqid"), "start0", "end0")
    cut = interval_pieces(own, chunk_sequences(keyed), keyed.select("seqid").distinct())
    counts = cut.groupBy("species", "_seqid", "start0", "end0").agg(
        F.sum(count_bases(F.col("piece"), "AT")).alias("_at"), F.sum(count_bases(F.col("piece"), "ACGT")).alias("_all"))
    return counts.select("species", F.col("_seqid").alias("seqid"), "start0", "end0", F.when(F.col("_all") > 0, F.col("_at") / F.col("_all")).alias("at_content"))


def unique_introns(rows: DataFrame) -> DataFrame:
    """One row per intron locus with the number of its transcripts and genes; ``intron_members`` has their rows.

    The first row of each transcript at a locus is marked where the transcript's rows already are; genes are then made
    distinct with the marks added up, so that an intron is one row on the way.
    """
    keys = ["species", "seqid", "start0", "end0", "strand"]
    rest = ["is_short_intron", "at_content", "is_at_rich", "intron_number", "source_feature"]
    least = [F.min(c).alias(c) for c in rest]
    of_transcript = Window.partitionBy(*keys, "transcript_id").orderBy("gene_id")
    counted = F.when(F.col("transcript_id").isNotNull() & (F.row_number().over(of_transcript) == 1), 1).otherwise(0)
    of_gene = rows.withColumn("_transcripts", counted).groupBy(*keys, "gene_id").agg(*least, F.sum("_transcripts").alias("_transcripts"))
    loci = of_gene.groupBy(*keys).agg(*least, F.sum("_transcripts").alias("transcript_count"), F.count("gene_id").alias("gene_count"))
    return loci.select(
        *keys, (F.col("start0") + 1).alias("start1"), F.col("end0").alias("end1"), (F.col("end0") - F.col("start0")).alias("length"), "source_feature",
        "is_short_intron", "at_content", "is_at_rich", "intron_number", "transcript_count", "gene_count")


def intron_members(rows: DataFrame) -> DataFrame:
    """Distinct transcripts and genes of each intron locus, one row each; rows of a transcript are made distinct where they already are, by their order."""
    members = rows.select("species", "seqid", "start0", "end0", "strand", "transcript_id", F.coalesce("gene_id", F.lit("NA")).alias("gene_id"))
    same = Window.partitionBy(*members.columns).orderBy("start0")
    return members.withColumn("_copy", F.row_number().over(same)).filter("_copy = 1").drop("_copy")


def intron_summary(rows: DataFrame) -> DataFrame:
    """Nine intron metrics of each species as metric/value rows; a species without introns has none."""
    counts = rows.groupBy("species").agg(
        F.countDistinct("transcript_id").alias("transcripts_with_introns"), F.countDistinct("gene_id").alias("genes_with_introns"),
        F.count(F.lit(1)).alias("total_introns"), F.countDistinct("seqid", "start0", "end0", "strand").alias("unique_introns"),
        F.count_if("is_short_intron").alias("short_introns"), F.count_if("is_at_rich").alias("at_rich_introns"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("total_intron_bp"), F.coalesce(F.avg("length"), F.lit(0.0)).alias("mean_intron_length"))
    names = counts.columns[1:]
    long = counts.select("species", *[F.col(c).cast("double").alias(c) for c in names]).unpivot(["species"], names, "metric", "value")
    middle = grouped_median(rows.withColumn("metric", F.lit("median_intron_length")), ["species", "metric"], "length", "value")
    return long.unionByName(middle.select("species", "metric", "value"))


def intron_sequence_summary(unique: DataFrame) -> DataFrame:
    """Unique introns per sequence."""
    return unique.groupBy("species", "seqid").agg(
        F.count(F.lit(1)).alias("unique_intron_count"), F.count_if("is_short_intron").alias("short_intron_count"),
        F.count_if("is_at_rich").alias("at_rich_intron_count"), (F.count_if("is_at_rich") / F.count(F.lit(1))).alias("at_rich_intron_ratio"),
        F.sum("length").alias("total_intron_bp"), F.avg("length").alias("mean_intron_length"), F.avg("at_content").alias("mean_at_content"))


def gff_structure(
    features: DataFrame, genome_lengths: DataFrame | None = None, compat: bool = False, only: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """The six structure tables of every species: metrics, distributions, sequences, feature types, checks, histograms.

    Exon and CDS counts are taken over all transcripts, zeros included; ``compat`` counts over
    every parent that has children instead. ``genome_lengths`` has species, seqid, length. ``only`` names the
    tables that are wanted: medians run jobs of their own, which the other tables do without.
    """
    rows = features.filter("start is not null and end is not null").withColumn("length", F.greatest(F.col("end") - F.col("start") + 1, F.lit(0)))
    is_transcript = F.col("type").isin(*TRANSCRIPT_TYPES) | F.col("type").endswith("RNA")
    genes = last_by(rows.filter("type = 'gene' and id is not null").withColumn("gene_id", F.col("id")), ["species", "gene_id"], "_row", ["seqid", "length", "end"])
    transcripts = last_by(
        rows.filter(is_transcript & F.col("id").isNotNull() & (F.col("type") != "gene")).select(
            "species", F.col("id").alias("transcript_id"), _first_parent().alias("gene_id"), "seqid", "length", "_row"),
        ["species", "transcript_id"], "_row", ["gene_id", "seqid", "length"])
    children = rows.filter(~F.col("type").isin("gene", *TRANSCRIPT_TYPES)).select(
        "species", "type", "seqid", "start", "end", "strand", F.explode("parents").alias("transcript_id"))
    per_parent = children.groupBy("species", "transcript_id").agg(
        F.count_if(F.col("type") == "exon").alias("exons"), F.count_if(F.col("type") == "CDS").alias("cds"))
    with_counts = transcripts.join(per_parent, ["species", "transcript_id"], "left").na.fill(0, ["exons", "cds"])
    counted = per_parent if compat else with_counts
    # Gaps of exons and of CDS parts are found apart; those of CDS parts count where a transcript has no exons.
    gaps = segment_gaps(children.filter("type in ('exon', 'CDS')"), ["species", "transcript_id", "seqid", "type"]).select(
        "species", "transcript_id", "seqid", "type", (F.col("end0") - F.col("start0")).alias("length")).join(
        with_counts.select("species", "transcript_id", "gene_id", "exons"), ["species", "transcript_id"]).filter(
        (F.col("type") == "exon") | (F.col("exons") == 0)).drop("type", "exons")
    isoforms = transcripts.filter("gene_id is not null").groupBy("species", "gene_id").agg(F.count(F.lit(1)).alias("n"))

    def metric_rows() -> DataFrame:
        # Every measured number as one long table, so that means and medians come from one pass each.
        def numbers(df: DataFrame, kind: str, value: str) -> DataFrame:
            return df.select("species", F.lit(kind).alias("kind"), F.col(value).cast("bigint").alias("v"))

        measured = numbers(genes, "gene", "length").unionByName(numbers(transcripts, "transcript", "length")).unionByName(
            numbers(rows.filter("type = 'exon'"), "exon", "length")).unionByName(numbers(rows.filter("type = 'CDS'"), "cds", "length")).unionByName(
            numbers(gaps, "intron", "length")).unionByName(numbers(counted, "exons_per", "exons")).unionByName(numbers(isoforms, "isoforms", "n"))
        stats = measured.groupBy("species", "kind").agg(F.count(F.lit(1)).alias("n"), F.avg("v").alias("mean"), F.count_if(F.col("v") == 1).alias("ones"),
                                                        F.count_if(F.col("v") > 1).alias("more"))
        medians = grouped_median(measured.filter("kind in ('gene', 'intron')"), ["species", "kind"], "v", "median")
        joined = stats.join(medians, ["species", "kind"], "left")

        def of(kind: str, column: str) -> Column:
            return F.max(F.when(F.col("kind") == kind, F.col(column)))

        def count_of(kind: str, column: str = "n") -> Column:
            return F.coalesce(of(kind, column), F.lit(0)).cast("double")

        records = rows.groupBy("species").agg(F.count(F.lit(1)).cast("double").alias("feature_records"))
        wide = joined.groupBy("species").agg(
            count_of("gene").alias("genes"), count_of("transcript").alias("transcripts"), count_of("exon").alias("exons"), count_of("cds").alias("cds_features"),
            count_of("intron").alias("introns"), count_of("exons_per", "ones").alias("single_exon_transcripts"), count_of("exons_per", "more").alias("multi_exon_transcripts"),
            count_of("isoforms", "more").alias("genes_with_isoforms"), of("gene", "mean").alias("mean_gene_length"), of("gene", "median").alias("median_gene_length"),
            of("transcript", "mean").alias("mean_transcript_length"), of("exon", "mean").alias("mean_exon_length"), of("cds", "mean").alias("mean_cds_feature_length"),
            of("intron", "mean").alias("mean_intron_length"), of("intron", "median").alias("median_intron_length"),
            of("exons_per", "mean").alias("mean_exons_per_transcript"), of("isoforms", "mean").alias("mean_isoforms_per_gene"))
        both = records.join(wide, "species", "left")
        return both.unpivot("species", [c for c in both.columns if c != "species"], "metric", "value")

    def histogram(df: DataFrame, category: str, value: str, size: int, zero: bool = False) -> DataFrame:
        return length_histogram(df.select("species", F.lit(category).alias("category"), F.col(value).alias("_v")), ["species", "category"], "_v", size, zero)

    histograms = histogram(transcripts, "mRNA_length", "length", 50).unionByName(
        histogram(rows.filter("type = 'CDS'"), "CDS_length", "length", 50)).unionByName(
        histogram(rows.filter("type = 'exon'"), "exon_length", "length", 10)).unionByName(
        histogram(gaps, "intron_length", "length", 10)).unionByName(histogram(counted, "exon_number", "exons", 1, True))

    nothing = F.lit(None).cast("string")

    def spread(df: DataFrame, category: str, feature: Column, parent: Column, seqid: Column, length: Column | None, count: Column | None, note: str | None = None) -> DataFrame:
        return df.select(
            "species", F.lit(category).alias("category"), feature.alias("feature_id"), parent.alias("parent_id"), seqid.alias("seqid"),
            (length if length is not None else F.lit(None)).cast("bigint").alias("length"),
            (count if count is not None else F.lit(None)).cast("bigint").alias("count"), F.lit(note).cast("string").alias("note"))

    tx, gene, seq, length = F.col("transcript_id"), F.col("gene_id"), F.col("seqid"), F.col("length")
    parts = rows.filter("type in ('exon', 'CDS')")
    isoform_rows = isoforms.join(genes.select("species", "gene_id", "seqid"), ["species", "gene_id"], "left")
    spreads = [
        spread(genes, "gene_length", gene, nothing, seq, length, None), spread(transcripts, "mRNA_length", tx, gene, seq, length, None),
        spread(transcripts, "transcript_length", tx, gene, seq, length, None, "alias_of_mRNA_length"),
        spread(with_counts, "exons_per_transcript", tx, gene, seq, None, F.col("exons")),
        spread(with_counts, "cds_features_per_transcript", tx, gene, seq, None, F.col("cds")),
        *[spread(parts.filter(F.col("type") == t), f"{t}_length", F.col("id"), F.when(F.size("parents") > 0, F.array_join("parents", ";")), seq, length, None) for t in ("exon", "CDS")],
        spread(gaps, "intron_length", tx, gene, seq, length, None), spread(isoform_rows, "isoforms_per_gene", gene, nothing, seq, None, F.col("n"))]
    distributions = spreads[0]
    for more in spreads[1:]:
        distributions = distributions.unionByName(more)

    by_seq = genes.groupBy("species", "seqid").agg(
        F.count(F.lit(1)).alias("gene_count"), F.sum("length").alias("gene_bp"), F.avg("length").alias("mean_gene_length"), F.max("end").alias("_last"))
    sequences = by_seq.join(transcripts.groupBy("species", "seqid").agg(F.count(F.lit(1)).alias("transcript_count")), ["species", "seqid"], "full_outer")
    if genome_lengths is not None:
        sequences = sequences.join(genome_lengths.select("species", "seqid", F.col("length").alias("_span")), ["species", "seqid"], "full_outer")
    else:
        sequences = sequences.withColumn("_span", F.lit(None).cast("bigint"))
    span = F.coalesce(F.when(F.col("_span") > 0, F.col("_span")), F.col("_last"), F.lit(0))
    sequences = sequences.na.fill(0, ["gene_count", "transcript_count", "gene_bp"]).select(
        "species", "seqid", "gene_count", "transcript_count", "gene_bp", "mean_gene_length",
        F.when(span > 0, F.col("gene_count") / (span / 1000000)).alias("gene_density_per_mb"))

    def feature_types() -> DataFrame:
        types = rows.groupBy("species", F.col("type").alias("feature_type")).agg(
            F.count(F.lit(1)).alias("count"), F.sum("length").alias("total_bp"), F.avg("length").alias("mean_length"))
        return types.join(grouped_median(rows.withColumnRenamed("type", "feature_type"), ["species", "feature_type"], "length", "median_length"), ["species", "feature_type"])

    tables = {"metrics": metric_rows, "distributions": lambda: distributions, "sequences": lambda: sequences, "feature_types": feature_types,
              "checks": lambda: structure_checks(rows, genome_lengths), "histograms": lambda: histograms}
    return {name: make() for name, make in tables.items() if only is None or name in only}


def failed_names(rows: DataFrame) -> DataFrame:
    """(species, check, id) of every repeated id and every parent that is missing."""
    repeated = rows.filter("id is not null").groupBy("species", "id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    ids = rows.filter("id is not null").select("species", "id").distinct()
    dangling = rows.select("species", F.explode("parents").alias("id")).distinct().join(ids, ["species", "id"], "left_anti")
    return repeated.select("species", F.lit("duplicate_ids").alias("check"), "id").unionByName(
        dangling.select("species", F.lit("missing_parent_references").alias("check"), "id"))


def structure_checks(rows: DataFrame, genome_lengths: DataFrame | None = None) -> DataFrame:
    """Quality checks per species with the number of cases: repeated ids, orphans, dangling parents, positions outside the genome; ``failed_names`` has the names."""
    species = rows.select("species").distinct()
    named = failed_names(rows).groupBy("species", "check").agg(F.count(F.lit(1)).alias("n"))
    orphans = rows.filter(~F.col("type").isin("gene", *TRANSCRIPT_TYPES) & (F.size("parents") == 0)).groupBy("species").agg(F.count(F.lit(1)).alias("n"))
    if genome_lengths is not None:
        outside = rows.join(genome_lengths.select("species", "seqid", F.col("length").alias("_len")), ["species", "seqid"], "left").filter(
            "_len is null or end > _len or start < 1").groupBy("species").agg(F.count(F.lit(1)).alias("n"))

    def check(found: DataFrame, name: str, bad: str) -> DataFrame:
        n = F.coalesce("n", F.lit(0))
        return species.join(found, "species", "left").select(
            "species", F.lit(name).alias("check"), F.when(n > 0, bad).otherwise("pass").alias("status"), n.cast("string").alias("details"))

    out = check(orphans, "child_features_without_parent", "warn")
    for name in ("duplicate_ids", "missing_parent_references"):
        out = out.unionByName(check(named.filter(F.col("check") == name).drop("check"), name, "fail"))
    if genome_lengths is not None:
        return out.unionByName(check(outside, "seqids_in_genome", "fail"))
    return out.unionByName(species.select("species", F.lit("seqids_in_genome").alias("check"), F.lit("pass").alias("status"), F.lit("not_tested").alias("details")))


def primary_transcripts(features: DataFrame, transcript_regex: str | None = None) -> DataFrame:
    """One transcript per gene: the one marked t1, else the first by name; transcripts without a
    gene stay when marked t1 or not numbered at all."""
    rows = features.filter(F.col("type").isin(*TRANSCRIPT_TYPES) & F.col("id").isNotNull())
    if transcript_regex:
        rows = rows.filter(F.col("id").rlike(transcript_regex))
    own = last_by(rows.select("species", F.col("id").alias("transcript_id"), "seqid", "start", "end", "strand",
                              F.nullif(F.try_element_at("attrs", F.lit("Parent")), F.lit("")).alias("gene"), "_row"),
                  ["species", "transcript_id"], "_row", ["seqid", "start", "end", "strand", "gene"])
    t1 = F.col("transcript_id").rlike(PRIMARY)
    # One pass: transcripts are ranked within their gene, those without one lie under keys of their own.
    within = Window.partitionBy("species", "_gene").orderBy(~t1, "transcript_id")
    ranked = own.withColumn("_gene", spread_missing(F.col("gene"), "transcript_id")).withColumn("_rank", F.row_number().over(within))
    alone = t1 | ~F.col("transcript_id").rlike(NUMBERED)
    return ranked.filter(F.when(F.col("gene").isNull(), alone).otherwise(F.col("_rank") == 1)).drop("_gene", "_rank")


def coding_sequences(features: DataFrame, transcripts: DataFrame, genome: DataFrame, size: int = CHUNK) -> DataFrame:
    """Coding sequence, peptide and checks of each given transcript that has CDS parts.

    Parts are cut from genome chunks, so no task holds a whole chromosome; only the parts of one
    transcript come together. ``genome`` has species, seqid, seq, and start0 if it comes in pieces.
    """
    from .sequences import chunk_sequences, without_text

    parts = features.filter("type = 'CDS'").select(
        "species", "seqid", (F.col("start") - 1).alias("start0"), F.col("end").alias("end0"), "_row", F.explode("parents").alias("transcript_id"))
    own = parts.join(transcripts.select("species", "transcript_id"), ["species", "transcript_id"], "left_semi")
    # Species and sequence travel as one key through the chunk lookup.
    joint = F.concat_ws("\t", "species", "seqid")
    keyed = without_text(genome.withColumn("seqid", joint), "seqid")
    cut = interval_pieces(own.withColumn("seqid", joint), chunk_sequences(keyed, size), keyed.select("seqid").distinct(), size)
    ordered = F.array_sort(F.collect_list(F.struct("start0", "_row", "piece_start", "piece")))
    joined = cut.groupBy("species", "transcript_id").agg(F.upper(F.array_join(F.transform(ordered, lambda p: p["piece"]), "")).alias("_seq"))
    rows = joined.join(transcripts.select("species", "transcript_id", "seqid", "start", "end", "strand"), ["species", "transcript_id"]).filter("_seq <> ''")
    stranded = rows.withColumn("cds", F.when(F.col("strand") == "-", reverse_complement(F.col("_seq"))).otherwise(F.col("_seq")))
    peptides = stranded.withColumn("pep", translate_codons(F.col("cds")))
    return peptides.select("species", "transcript_id", "seqid", "start", "end", "cds", "pep", *[c.alias(n) for n, c in cds_checks(F.col("cds"), F.col("pep")).items()])


def gff_subset(features: DataFrame, transcripts: DataFrame, keep_seqids: DataFrame | None = None) -> DataFrame:
    """Annotation lines of the given transcripts with ``_order``; a gene line comes before its first transcript."""
    if keep_seqids is not None:
        features = features.join(keep_seqids.select("seqid").distinct(), "seqid", "left_semi")
    wanted = transcripts.select("species", F.col("transcript_id").alias("_t")).distinct()
    own = features.filter(F.col("type").isin(*TRANSCRIPT_TYPES)).join(
        wanted, (features["species"] == wanted["species"]) & (features["id"] == wanted["_t"]), "left_semi")
    rest = features.filter(F.col("type") != "gene")
    of_wanted = rest.filter(F.size("parents") > 0).select("species", "_row", F.explode("parents").alias("_t")).join(wanted, ["species", "_t"], "left_semi").select("species", "_row")
    lines = own.select("species", "_row").unionByName(of_wanted).distinct()
    kept = features.join(lines, ["species", "_row"], "left_semi").select("species", "line", F.struct(F.col("_row").alias("at"), F.lit(1).alias("k")).alias("_order"))
    first = own.select("species", F.explode("parents").alias("id"), "_row").groupBy("species", "id").agg(F.min("_row").alias("_first"))
    gene_line = last_by(features.filter("type = 'gene' and id is not null"), ["species", "id"], "_row", ["line"])
    genes = gene_line.join(first, ["species", "id"]).select("species", "line", F.struct(F.col("_first").alias("at"), F.lit(0).alias("k")).alias("_order"))
    return kept.unionByName(genes)


def gene_models(
    features: DataFrame, genome: DataFrame, keep_seqids: DataFrame | None = None, transcript_regex: str | None = None, filter_bad: bool = True, keep: bool = False,
) -> dict[str, DataFrame]:
    """Primary transcripts with coding sequences: raw and final checks, sequences, annotation subset and a summary per species.

    The chosen transcripts, one row each, are written once, as several steps read them. All four tables read the spliced sequences; with ``keep`` these and the columns of the annotation that are read are written once to the shared folder.
    """
    if keep:
        parent = F.map_filter("attrs", lambda k, v: k == "Parent").alias("attrs")
        features = stored(features.select("species", "seqid", "type", "start", "end", "strand", "id", "parents", parent, "line", "_row"), "features")
    chosen = primary_transcripts(features, transcript_regex)
    if keep_seqids is not None:
        chosen = chosen.join(keep_seqids.select("seqid").distinct(), "seqid", "left_semi")
    chosen = stored(chosen, "transcripts")
    raw = coding_sequences(features, chosen, genome)
    if keep:
        raw = stored(raw, "coding")
    final = raw.filter("phase_ok = 1 and internal_stop = 0") if filter_bad else raw
    lines = gff_subset(features, final, keep_seqids)
    good = (F.col("phase_ok") == 1) & (F.col("internal_stop") == 0) if filter_bad else F.lit(True)
    summary = chosen.groupBy("species").agg(F.count(F.lit(1)).alias("transcripts_selected")).join(
        raw.groupBy("species").agg(F.count(F.lit(1)).alias("raw_cds_written"), F.count_if(good).alias("cds_written")), "species", "left").join(
        lines.groupBy("species").agg(F.count(F.lit(1)).alias("gff_features")), "species", "left").na.fill(0)
    summary = summary.withColumn("filtered_bad_cds", F.col("raw_cds_written") - F.col("cds_written"))
    return {"raw": raw, "final": final, "gff": lines, "summary": summary}


def feature_coordinates(features: DataFrame) -> DataFrame:
    """Location by id: a feature's own ID or Name first (priority 0), the span of a child for its parents after that (1)."""
    rows = features.filter(F.col("type").isin("gene", *TRANSCRIPT_TYPES))
    own = F.transform(F.array_compact(F.array("id", F.try_element_at("attrs", F.lit("Name")))), lambda i: F.struct(i.alias("id"), F.lit(0).alias("priority")))
    parents = F.transform("parents", lambda p: F.struct(p.alias("id"), F.lit(1).alias("priority")))
    return rows.select(F.inline(F.concat(own, parents)), "seqid", "start", "end", "strand").filter("id <> ''")


def annotated_transcripts(features: DataFrame) -> DataFrame:
    """Transcripts with gene and location; a transcript without a parent is its own gene."""
    rows = features.filter(F.col("type").isin(*TRANSCRIPT_TYPES) & F.col("id").isNotNull()).select(
        "species", F.col("id").alias("transcript_id"), F.coalesce(_first_parent(), F.col("id")).alias("gene_id"), "seqid", "start", "end", "strand", "_row")
    return last_by(rows, ["species", "transcript_id"], "_row", ["gene_id", "seqid", "start", "end", "strand"])
