"""Nucleotide and peptide string functions built from JVM-side expressions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The standard genetic code, amino acids in T, C, A, G order of the three codon positions.
CODON_BASES = "TCAG"
CODON_AMINO_ACIDS = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"


def genetic_code() -> dict[str, str]:
    """Codon to amino acid."""
    codons = [a + b + c for a in CODON_BASES for b in CODON_BASES for c in CODON_BASES]
    return dict(zip(codons, CODON_AMINO_ACIDS))


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTNacgtn", "TGCANtgcan"))


def count_bases(seq: Column, bases: str) -> Column:
    """How many characters of ``seq`` are one of ``bases``, either case."""
    both = "".join(dict.fromkeys(bases.upper() + bases.lower()))
    return (F.length(seq) - F.length(F.translate(seq, both, ""))).cast("bigint")


def translate_codons(cds: Column) -> Column:
    """Peptide of a coding sequence; unknown codons give X, an incomplete last codon is ignored."""
    table = F.create_map(*[F.lit(x) for pair in genetic_code().items() for x in pair])
    codons = F.regexp_extract_all(F.upper(cds), F.lit("(...)"), F.lit(1))
    return F.array_join(F.transform(codons, lambda c: F.coalesce(F.try_element_at(table, c), F.lit("X"))), "")


def cds_checks(cds: Column, peptide: Column) -> dict[str, Column]:
    """The six quality columns of one coding sequence."""
    upper = F.upper(cds)
    without_last = F.substring(peptide, F.lit(1), F.greatest(F.length(peptide) - 1, F.lit(0)))
    return {
        "cds_len": F.length(cds).cast("bigint"),
        "phase_ok": (F.length(cds) % 3 == 0).cast("int"),
        "start_ok": (F.substring(upper, 1, 3) == "ATG").cast("int"),
        "terminal_stop": peptide.endswith("*").cast("int"),
        "internal_stop": (F.length(without_last) - F.length(F.translate(without_last, "*", ""))).cast("bigint"),
        "ambiguous_nt": F.length(F.translate(upper, "ACGT", "")).cast("bigint"),
    }


def pieces(seq: Column, size: int) -> Column:
    """``seq`` cut into consecutive strings of ``size`` characters (the last may be shorter), in one pass."""
    return F.regexp_extract_all(seq, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))


def wrapped(seq: Column, width: int) -> Column:
    """``seq`` with a line break after every ``width`` characters."""
    return F.array_join(pieces(seq, width), "\n")
