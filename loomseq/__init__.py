"""Sequencing data on Spark: alignments, variants, sequences and intervals as DataFrames."""
