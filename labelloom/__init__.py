"""Labelled-text corpora on Spark: build, sample, split, score and evaluate."""
