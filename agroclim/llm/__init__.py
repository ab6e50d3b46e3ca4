"""Operators of a large-scale training-data pipeline, one module per operator.

Nothing else in the library imports this subpackage. ``queries`` registers one
query per operator; the corpus pipeline is ``corpus_pipeline.py`` at the top.
"""
