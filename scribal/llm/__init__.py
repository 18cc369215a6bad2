"""Training-data operators for large text corpora.

Thirteen operators, one module each; ``queries`` registers them for the driver.
Nothing outside this subpackage (and ``corpus_pipeline``) imports it.
"""
