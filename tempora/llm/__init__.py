"""Operators for large-scale training-data preparation.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it; the rest
of the library works without it. ``queries.py`` registers one query per
operator, ``oracle.py`` the SQL of those that SQL can express.
"""
