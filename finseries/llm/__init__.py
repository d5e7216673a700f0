"""Training-data operators: dedup, decontamination, language, PII, licenses, tokens.

Nothing outside this package imports it; ``corpus_pipeline.py`` and the
registry module ``finseries.llm.registry`` are its entry points.
"""
