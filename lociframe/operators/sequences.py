"""Sequence tables (seqid, seq): statistics, windows, k-mers, masking and clean-up."""
from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequence import count_bases, pieces as pieces_of
from .intervals import merge_intervals, running_totals
from .scans import range_parts, running
from .summaries import nx_statistics

CHUNK = 1 << 16


def sequence_keys(sequences: DataFrame) -> list[str]:
    """Columns that name a sequence, in a table of whole sequences or of pieces (with ``start0``)."""
    return [c for c in sequences.columns if c not in ("seq", "start0", "header", "length")]


def split_pieces(pieces: DataFrame, size: int, overlap: int = 0) -> DataFrame:
    """Pieces cut at multiples of ``size``: keys, ``chunk_no``, ``_from`` (place in the sequence), ``seq``; the first ``overlap`` characters of a chunk also come under the chunk before."""
    head = (F.lit(size) - F.col("start0") % size).cast("int")
    parts = F.filter(F.concat(F.array(F.substring(F.col("seq"), F.lit(1), head)), pieces_of(F.substring(F.col("seq"), head + 1, F.length("seq")), size)), lambda p: p != "")
    cut = pieces.select(*sequence_keys(pieces), F.col("start0").alias("_start"), F.posexplode(F.when(F.size(parts) > 0, parts).otherwise(F.array(F.lit("")))).alias("_i", "seq"))
    number = F.floor(F.col("_start") / size) + F.col("_i")
    placed = cut.select(*sequence_keys(pieces), number.cast("int").alias("chunk_no"), F.greatest("_start", number * size).alias("_from"), "seq")
    if not overlap:
        return placed
    reach = F.greatest(F.lit(0), overlap - (F.col("_from") - F.col("chunk_no").cast("bigint") * size)).cast("int")
    copy = F.struct((F.col("chunk_no") - 1).alias("chunk_no"), F.substring(F.col("seq"), F.lit(1), reach).alias("seq"))
    both = F.filter(F.array(F.struct("chunk_no", "seq"), copy), lambda c: (c["chunk_no"] == F.col("chunk_no")) | (c["chunk_no"] >= 0) & (c["seq"] != ""))
    return placed.select(*sequence_keys(pieces), "_from", F.inline(both)).select(*placed.columns)


def chunk_sequences(sequences: DataFrame, size: int = CHUNK, overlap: int = 0) -> DataFrame:
    """Sequences cut into chunks (seqid, chunk_no, start0, seq); each chunk also carries the next ``overlap`` characters.

    Whole sequences are cut where they stand. Pieces (with ``start0``, as ``read_fasta_pieces`` gives them) are
    brought together by chunk in one pass, so a row never holds more than a chunk.
    """
    if overlap > size:
        raise ValueError("overlap cannot exceed the chunk size")
    keys = sequence_keys(sequences)
    if "start0" in sequences.columns:
        parts = split_pieces(sequences, size, overlap).groupBy(*keys, "chunk_no").agg(F.array_sort(F.collect_list(F.struct("_from", "seq"))).alias("_p"))
        rows = parts.select(*keys, "chunk_no", F.array_join(F.transform("_p", lambda p: p["seq"]), "").alias("seq"))
        return rows.withColumn("start0", F.col("chunk_no").cast("bigint") * size)
    cut = pieces_of(F.col("seq"), size)
    if overlap:
        # The outer transform cuts the sequence once; the inner one reads neighbours from the result.
        cut = F.flatten(F.transform(F.array(cut), lambda p: F.transform(
            p, lambda x, i: F.concat(x, F.substring(F.coalesce(F.get(p, i + 1), F.lit("")), 1, overlap)))))
    rows = sequences.select(*keys, F.posexplode(cut).alias("chunk_no", "seq"))
    return rows.withColumn("start0", F.col("chunk_no").cast("bigint") * size)


def without_text(sequences: DataFrame, *columns: str) -> DataFrame:
    """The columns named, the sequence and, of pieces, their place."""
    return sequences.select(*columns, *[c for c in ("start0", "seq") if c in sequences.columns])


def sequence_composition(sequences: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Length, GC and N counts per sequence, whole or in pieces."""
    seq = F.col("seq")
    rows = sequences.select(*keys, "seqid", F.length(seq).cast("bigint").alias("length"), count_bases(seq, "GC").alias("gc"), count_bases(seq, "N").alias("n"))
    if "start0" not in sequences.columns:
        return rows
    return rows.groupBy(*keys, "seqid").agg(*[F.sum(c).alias(c) for c in ("length", "gc", "n")])


def assembly_stats(sequences: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Assembly summary per key (one row without keys): sizes, N50/N90 and composition."""
    keys = list(keys)
    per = sequence_composition(sequences, keys)
    totals = per.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("seq_count"), F.sum("length").alias("total_length"), F.min("length").alias("min_length"),
        F.max("length").alias("max_length"), F.sum("gc").alias("GC_count"), F.sum("n").alias("N_count"))
    nx = nx_statistics(per, keys, "length")
    if keys:
        both = totals.join(nx, keys, "left")
    else:
        merged = totals.unionByName(nx, allowMissingColumns=True)
        both = merged.agg(*[F.max(c).alias(c) for c in merged.columns])
    share = lambda c: F.when(F.col("total_length") > 0, F.col(c) / F.col("total_length") * 100).otherwise(F.lit(0.0))
    return both.select(
        *keys, "seq_count", "total_length", "min_length", "max_length", "N50", "L50", "N90", "L90", "GC_count",
        share("GC_count").alias("GC_percent"), "N_count", share("N_count").alias("N_percent"))


def gc_windows(sequences: DataFrame, size: int = 5_000, compat: bool = False) -> DataFrame:
    """GC share of the A, C, G and T bases per window; zero where a window has none.

    Windows are clipped to the sequence. ``compat`` keeps unclipped ends and the empty window
    after a sequence whose length is a multiple of the window. Of pieces, each window's counts are added
    up over the pieces that reach into it.
    """
    gc, at = count_bases(F.col("seq"), "GC"), count_bases(F.col("seq"), "AT")
    n = F.length("seq").cast("bigint")
    if "start0" in sequences.columns:
        split = split_pieces(without_text(sequences, "seqid"), size).filter("seq <> ''")
        rows = split.groupBy("seqid", (F.col("chunk_no").cast("bigint") * size).alias("start")).agg(F.sum(n).alias("_n"), F.sum(gc).alias("_gc"), F.sum(at).alias("_at"))
        lengths = sequences.groupBy("seqid").agg(F.sum(n).alias("_length"))
    else:
        rows = chunk_sequences(sequences.select("seqid", "seq"), size).select("seqid", F.col("start0").alias("start"), n.alias("_n"), gc.alias("_gc"), at.alias("_at"))
        lengths = sequences.select("seqid", n.alias("_length"))
    share = F.when(F.col("_gc") + F.col("_at") > 0, F.col("_gc") / (F.col("_gc") + F.col("_at"))).otherwise(F.lit(0.0))
    if not compat:
        return rows.select("seqid", "start", (F.col("start") + F.col("_n")).alias("end"), share.alias("gc"))
    full = rows.select("seqid", "start", (F.col("start") + size - 1).alias("end"), share.alias("gc"))
    empty = lengths.filter(F.col("_length") % size == 0).select("seqid", F.col("_length").alias("start"), F.col("_length").alias("end"), F.lit(0.0).alias("gc"))
    return full.unionByName(empty)


#: Letters of two bits each, in the order of their codes; as many as fit a non-negative long make one word.
BASES, WORD = "ACGT", 31
#: Characters that are turned into k-mers at a time.
SLICE = 1 << 20
_CODES = np.full(256, 4, np.int64)
for _code, _base in enumerate(BASES):
    _CODES[[ord(_base), ord(_base.lower())]] = _code


def _stretch(codes: np.ndarray, n: int, complement: bool) -> np.ndarray:
    """The number of the ``n`` bases from each place on, or of their reverse complement; halves are put together."""
    if n == 1:
        return 3 - codes if complement else codes
    half = n // 2
    first, second = _stretch(codes, half, complement), _stretch(codes, n - half, complement)[half:]
    first = first[: len(second)]
    return (second << 2 * half) | first if complement else (first << 2 * (n - half)) | second


def _canonical(text: np.ndarray, k: int) -> np.ndarray:
    """Words (rows) of the canonical k-mers of a text of bytes; k-mers with anything but A, C, G and T are left out."""
    places = len(text) - k + 1
    sizes = [min(WORD, k - at) for at in range(0, k, WORD)]
    if places <= 0:
        return np.zeros((0, len(sizes)), np.int64)
    codes = _CODES[text]
    wrong = np.concatenate([[0], np.cumsum(codes > 3)])
    clean = wrong[k:] == wrong[:-k]
    codes = codes & 3
    forward, backward = [], []
    for i, n in enumerate(sizes):
        at = i * WORD
        forward.append(_stretch(codes, n, False)[at : at + places][clean])
        backward.append(_stretch(codes, n, True)[k - at - n : k - at - n + places][clean])
    less, equal = np.zeros(int(clean.sum()), bool), np.ones(int(clean.sum()), bool)
    for f, b in zip(forward, backward, strict=True):
        less |= equal & (f < b)
        equal &= f == b
    return np.column_stack([np.where(less, f, b) for f, b in zip(forward, backward, strict=True)])


def kmer_counts(sequences: DataFrame, k: int = 21, chunk: int = SLICE) -> DataFrame:
    """Occurrences of each canonical k-mer (the smaller of a k-mer and its reverse complement).

    Only k-mers of A, C, G and T count, in either case; pieces are brought into chunks first, each with the k - 1 characters
    that follow. Two bits a base make k-mers numbers, which sort like their letters and are counted in
    slices of ``chunk`` places and once more per task before the shuffle, so a k-mer that fills a genome travels as few rows. Letters
    come back only for the counts that are read.
    """
    if k < 1:
        raise ValueError("k must be at least one")
    if chunk < k:
        raise ValueError("chunk must hold at least one k-mer")
    if "start0" in sequences.columns:
        names = [c for c in ("path", "record", "seqid") if c in sequences.columns]
        sequences = chunk_sequences(without_text(sequences, *names), overlap=k - 1)
    sizes = [min(WORD, k - at) for at in range(0, k, WORD)]
    words = [f"_w{i}" for i in range(len(sizes))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = np.frombuffer("\n".join(x or "" for x in batch.column(0).to_pylist()).encode("ascii", "replace"), np.uint8)
            for at in range(0, len(text), chunk):
                found = _canonical(text[at : at + chunk + k - 1], k)
                values, n = np.unique(found[:, 0], return_counts=True) if len(words) == 1 else np.unique(found, axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays([*[pa.array(c) for c in values.reshape(-1, len(words)).T], pa.array(n, pa.int64())], names=[*words, "n"])

    counts = sequences.select("seq").mapInArrow(run, ", ".join(f"{c} bigint" for c in (*words, "n"))).groupBy(*words).agg(F.sum("n").alias("count"))
    letters = [F.translate(F.lpad(F.conv(F.col(w).cast("string"), 10, 4), n, "0"), "0123", BASES) for w, n in zip(words, sizes, strict=True)]
    return counts.select(F.concat(*letters).alias("kmer"), "count")


def kmer_histogram(counts: DataFrame, cap: int | None = None) -> DataFrame:
    """How many distinct k-mers occur how often; with ``cap`` counts from there on share the last bin."""
    return counts.groupBy((F.col("count") if cap is None else F.least(F.col("count"), F.lit(cap))).alias("multiplicity")).agg(F.count(F.lit(1)).alias("kmers"))


def kmers_between(counts: DataFrame, low: int, high: int) -> DataFrame:
    """k-mers whose count lies within both limits."""
    return counts.filter(F.col("count").between(low, high))


def upper_sequences(sequences: DataFrame) -> DataFrame:
    return sequences.withColumn("seq", F.upper("seq"))


def soft_mask(sequences: DataFrame, repeats: DataFrame, size: int = CHUNK) -> DataFrame:
    """Chunks (seqid, chunk_no, start0, seq) with A, C, G and T in lower case inside the repeats.

    Repeats are united and cut at chunk borders, so a chunk receives only disjoint stretches
    inside it; ``rebuild_sequences`` puts chunks together again.
    """
    chunks = chunk_sequences(without_text(sequences, "seqid"), size)
    merged = merge_intervals(repeats.select("seqid", F.greatest("start0", F.lit(0)).alias("start0"), "end0"))
    cut = merged.select("seqid", "start0", "end0", F.explode(F.sequence(
        F.floor(F.col("start0") / size).cast("int"), F.floor((F.col("end0") - 1) / size).cast("int"))).alias("chunk_no"))
    low = F.col("chunk_no").cast("bigint") * size
    inside = cut.select("seqid", "chunk_no", (F.greatest("start0", low) - low).cast("int").alias("_s"), (F.least("end0", low + size) - low).cast("int").alias("_e"))
    stretches = inside.groupBy("seqid", "chunk_no").agg(F.array_sort(F.collect_list(F.struct("_s", "_e"))).alias("_m"))
    seq = F.col("seq")
    # Alternate plain and masked pieces: before each stretch, the stretch, and the rest after the last one.
    body = F.transform("_m", lambda m, i: F.concat(
        F.substring(seq, F.when(i == 0, 1).otherwise(F.get("_m", i - 1)["_e"] + 1),
                    m["_s"] - F.when(i == 0, 0).otherwise(F.get("_m", i - 1)["_e"])),
        F.translate(F.substring(seq, m["_s"] + 1, m["_e"] - m["_s"]), "ACGT", "acgt")))
    rest = F.substring(seq, F.element_at("_m", -1)["_e"] + 1, F.length(seq))
    masked = F.when(F.col("_m").isNull(), seq).otherwise(F.concat(F.array_join(body, ""), rest))
    return chunks.join(stretches, ["seqid", "chunk_no"], "left").select("seqid", "chunk_no", "start0", masked.alias("seq"))


def rebuild_sequences(chunks: DataFrame) -> DataFrame:
    """Whole sequences from their chunks, for sequences that have to leave as one record."""
    return chunks.groupBy("seqid").agg(F.array_sort(F.collect_list(F.struct("chunk_no", "seq"))).alias("_c")).select(
        "seqid", F.array_join(F.transform("_c", lambda c: c["seq"]), "").alias("seq"))


def prefix_ids(sequences: DataFrame, prefix: str, sep: str = "|") -> DataFrame:
    """Sequences under prefixed ids, with the original id and the prefix."""
    return sequences.select(F.concat(F.lit(prefix + sep), F.col("seqid").cast("string")).alias("prefixed_id"), F.col("seqid").alias("original_id"),
                            F.lit(prefix).alias("prefix"), "seq")


def clean_peptides(peptides: DataFrame, remove_terminal_stop: bool = True, drop_empty: bool = True) -> DataFrame:
    """Peptides for tree building with their status; ``status`` = kept marks the ones to write."""
    seq, stop = F.col("seq"), F.col("seq").endswith("*")
    cleaned = F.when(stop, F.substring(seq, F.lit(1), F.length(seq) - 1)).otherwise(seq) if remove_terminal_stop else seq
    rows = peptides.select(F.col("seqid").alias("id"), F.length(seq).alias("old_len"), stop.cast("int").alias("terminal_stop_removed"), cleaned.alias("seq"))
    inner = F.substring(F.col("seq"), F.lit(1), F.greatest(F.length("seq") - 1, F.lit(0)))
    dropped = F.lit(drop_empty) & (F.length("seq") == 0)
    return rows.select("id", "old_len", F.length("seq").alias("new_len"), "terminal_stop_removed",
                       (F.length(inner) - F.length(F.translate(inner, "*", ""))).alias("internal_stop"),
                       F.when(dropped, "dropped_empty").otherwise("kept").alias("status"), "seq")


def quality_reads(reads: DataFrame, min_base_quality: int = 15, max_low_percent: float = 40.0, min_mean_quality: float = 20.0,
                  min_length: int = 50, offset: int = 33) -> DataFrame:
    """Reads (name, seq, qual) long enough, with few low-quality bases and a good mean quality."""
    codes = F.transform(F.split("qual", ""), lambda c: F.ascii(c) - offset)
    rated = reads.withColumn("_q", F.filter(codes, lambda q: q >= 0))
    low = F.size(F.filter("_q", lambda q: q < min_base_quality))
    mean = F.aggregate("_q", F.lit(0), lambda a, q: a + q) / F.greatest(F.size("_q"), F.lit(1))
    n = F.greatest(F.length("seq"), F.lit(1))
    return rated.filter((F.length("seq") >= min_length) & (low * 100 / n <= max_low_percent) & (mean >= min_mean_quality)).drop("_q")


def gap_runs(alignment: DataFrame, keys: Sequence[str] = ("alignment",), gap: str = "-") -> DataFrame:
    """Stretches of gaps of each row as intervals (keys, start0, end0), in characters."""
    keys = list(keys)
    kinds = ", ".join(f"`{k}` {alignment.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, ends, rows = [], [], []
            for row, seq in enumerate(batch.column(len(keys)).to_pylist()):
                here = np.frombuffer((seq or "").encode("utf-32-le"), np.uint32) == ord(gap)
                edges = np.flatnonzero(np.diff(np.concatenate([[False], here, [False]]).astype(np.int8)))
                starts.append(edges[::2])
                ends.append(edges[1::2])
                rows.append(np.full(len(edges) // 2, row))
            of = pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64), pa.int64())
            runs = [pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64()) for x in (starts, ends)]
            yield pa.RecordBatch.from_arrays([*[batch.column(i).take(of) for i in range(len(keys))], *runs], names=[*keys, "start0", "end0"])

    return alignment.select(*keys, "seq").mapInArrow(run, f"{kinds}, start0 bigint, end0 bigint")


def trim_alignment_columns(alignment: DataFrame, max_gap_percent: float, keys: Sequence[str] = ("alignment",)) -> DataFrame:
    """Alignment rows (keys, species, seq) without the columns whose gap share reaches the limit.

    Gaps travel as stretches. How many rows have a gap in a column is a running sum of where stretches begin
    and end, so work and rows go with the stretches, not with the characters; stretches of columns above
    the limit are united and each row leaves them out.
    """
    keys = list(keys)
    runs = gap_runs(alignment, keys)
    edges = runs.select(*keys, F.inline(F.array(*[F.struct(F.col(c).alias("pos"), F.lit(v).cast("bigint").alias("change")) for c, v in (("start0", 1), ("end0", -1))])))
    depth = running_totals(edges.groupBy(*keys, "pos").agg(F.sum("change").alias("change")), keys, "pos", ["change"])
    sizes = alignment.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    # Stretches of equal depth, from each position to the next of its alignment.
    in_bin = Window.partitionBy(*keys, "_bin").orderBy("pos")
    firsts = depth.groupBy(*keys, "_bin").agg(F.min("pos").alias("_first"))
    following = firsts.select(*keys, "_bin", F.lead("_first").over(Window.partitionBy(*keys).orderBy("_bin")).alias("_next_bin"))
    stretches = depth.select(*keys, "_bin", "pos", (F.col("before_change") + F.col("change")).alias("_gaps"), F.lead("pos").over(in_bin).alias("_next")).join(
        following, [*keys, "_bin"], "left").join(sizes, keys)
    dropped = stretches.filter((F.col("_gaps") > 0) & (F.col("_gaps") / F.col("_rows") * 100 >= max_gap_percent)).select(
        *keys, F.col("pos").alias("start0"), F.coalesce("_next", "_next_bin").alias("end0"))
    masks = merge_intervals(dropped, keys).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("start0", "end0"))).alias("_mask"))
    rows = alignment.select(*keys, "species", "seq").join(masks, keys, "left")
    kinds = ", ".join(f"`{c}` {alignment.schema[c].dataType.simpleString()}" for c in (*keys, "species"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for seq, mask in zip(batch.column(len(keys) + 1).to_pylist(), batch.column(len(keys) + 2).to_pylist(), strict=True):
                kept, at = [], 0
                for stretch in mask or []:
                    kept.append(seq[at : stretch["start0"]])
                    at = stretch["end0"]
                out.append("".join([*kept, seq[at:]]))
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(keys) + 1)], pa.array(out, pa.large_string())], names=[*keys, "species", "seq"])

    if max_gap_percent <= 0:  # every column reaches the limit
        return alignment.select(*keys, "species", F.lit("").alias("seq"))
    return rows.withColumn("seq", F.coalesce("seq", F.lit(""))).mapInArrow(cut, f"{kinds}, seq string")


def supermatrix(alignments: DataFrame, species: DataFrame) -> dict[str, DataFrame]:
    """Concatenated alignment: gene order by name, gap runs where a species lacks a gene.

    Returns the long parts (species, gene, start, length, seq), the partitions and the species stats.
    ``parts`` has one row per species and gene that it has; gaps follow from the partitions, and
    ``supermatrix_rows`` fills them in.
    """
    lengths = alignments.groupBy("gene").agg(F.max(F.length("seq")).cast("bigint").alias("length"))
    placed = running(range_parts(lengths, ["gene"]), ["gene"], {"_before": F.col("length")}, exclusive=True)
    partitions = placed.select("gene", "length", (F.col("_before") + 1).alias("start"), (F.col("_before") + F.col("length")).alias("end"))
    listed = species.select("species").distinct()
    have = alignments.join(listed, "species", "left_semi").select("species", "gene", "seq")
    present = have.groupBy("species").agg(F.count(F.lit(1)).alias("present_genes"))
    total = lengths.agg(F.count(F.lit(1)).alias("genes"), F.coalesce(F.sum("length"), F.lit(0)).alias("bp"))
    stats = listed.join(present, "species", "left").na.fill(0, ["present_genes"]).select(
        "species", "present_genes", (total.select("genes").scalar() - F.col("present_genes")).alias("missing_genes"),
        total.select("bp").scalar().alias("sequence_length"))
    parts = have.join(partitions, "gene").select("species", "gene", "start", "length", "seq")
    return {"parts": parts, "partitions": partitions.select("gene", "start", "end"), "stats": stats}


def supermatrix_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """One concatenated row per species of ``supermatrix``, for alignments that have to leave as whole records."""
    own = tables["parts"].groupBy("species").agg(F.array_sort(F.collect_list(F.struct("start", "length", "seq"))).alias("_p"))
    rows = tables["stats"].select("species", F.col("sequence_length").alias("_n")).join(own, "species", "left")
    gaps = lambda n: F.repeat(F.lit("-"), n.cast("int"))
    end = lambda p: p["start"] + p["length"] - 1
    pieces = F.transform("_p", lambda p, i: F.concat(gaps(p["start"] - 1 - F.when(i == 0, 0).otherwise(end(F.get("_p", i - 1)))), p["seq"]))
    rest = gaps(F.col("_n") - F.coalesce(end(F.try_element_at("_p", F.lit(-1))), F.lit(0)))
    return rows.select(F.col("species").alias("seqid"), F.concat(F.coalesce(F.array_join(pieces, ""), F.lit("")), rest).alias("seq"))


def te_divergence(repeats: DataFrame, substitution_rate: float | None = None) -> DataFrame:
    """Repeats with an insertion time in million years, NULL without a rate."""
    if not substitution_rate or substitution_rate <= 0:
        return repeats.withColumn("insertion_time_mya", F.lit(None).cast("double"))
    return repeats.withColumn("insertion_time_mya", F.col("divergence") / 100.0 / (2 * substitution_rate) / 1e6)


def te_divergence_summary(repeats: DataFrame) -> DataFrame:
    """Copies, bases, mean and median divergence and mean insertion time per class and family."""
    from .summaries import grouped_median

    keys = ["repeat_class", "repeat_family"]
    totals = repeats.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("copies"), F.sum("length").alias("covered_bp"), F.avg("divergence").alias("mean_divergence"),
        F.avg("insertion_time_mya").alias("mean_insertion_time_mya"))
    return totals.join(grouped_median(repeats, keys, "divergence", "median_divergence"), keys)
