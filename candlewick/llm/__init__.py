"""Operators for preparing large text corpora (training data).

Each module holds one operator with a general interface; ``queries`` derives
the registered ``opN_*`` queries from them. Nothing outside this subpackage
(and ``corpus_pipeline.py``) imports it.
"""
