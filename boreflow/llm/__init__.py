"""Training-data operators: stand-alone operators over documents, pages and vectors.

One module per operator; ``queries`` registers a thin query for each of them
and ``common`` holds the few helpers they share. Nothing outside this
subpackage (and ``corpus_pipeline.py``) imports it.
"""
