"""Training-data operators: one module per operator, queries in ``queries``.

Nothing outside this package (and ``corpus_pipeline.py``, which counts as
part of it) imports it; ``__spark_entry__`` adds its queries when it is there.
"""
