"""Training-data operators: formatting, deduplication, scans, mixing and scoring.

One module per operator.  Nothing outside this package imports it; the
registered queries are in ``queries``, the corpus pipeline in
``corpus_pipeline.py`` at the repository root.
"""
