"""Training-data operators for corpora of documents, pages and embeddings.

Nothing else in the library imports this package; ``queries`` registers the
checked queries and ``corpus_pipeline.py`` at the repository top composes five
of the operators.
"""
