"""Chains of operators and the queries built on them."""
from . import queries_families, queries_files, queries_genes, queries_genomes, queries_hits, queries_regions, queries_sequences, queries_sources, queries_terms, queries_chains  # noqa: F401
from .catalogue import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
