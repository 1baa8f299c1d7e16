"""Training-data operators over document collections.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
Each module holds one operator with a general DataFrame interface;
``queries.py`` holds the thin registered queries.
"""
