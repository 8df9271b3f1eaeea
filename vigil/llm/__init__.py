"""Operators for preparing language-model training data, as Spark jobs.

One module per operator; ``queries.py`` registers them. Nothing outside this
package (and ``corpus_pipeline.py``) imports it.
"""
