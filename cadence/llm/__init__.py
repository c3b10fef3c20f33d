"""Operators of a training-data pipeline: fingerprints, WARC, language identification,
toxicity and quality classifiers, token counts, source mixing, decontamination,
SimHash near-duplicates and chat tool-call linking.

Every operator takes and returns Spark DataFrames; ``queries`` registers one query per
operator. Nothing outside this subpackage imports it.
"""
