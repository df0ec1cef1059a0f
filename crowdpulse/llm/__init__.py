"""Operators for preparing large text corpora. Nothing else in the library imports this package.

| module | operator |
| --- | --- |
| ``langid`` | language identification, naive Bayes over hashed character n-grams |
| ``simhash`` | near-duplicate texts by SimHash, pivot distance tables |
| ``html_text`` | main text of web pages, repeated runs by a host suffix array |
| ``embed_dedup`` | near-duplicate vectors, PCA-ordered tiles |
| ``mixing`` | mixing sources to target sizes, Pareto order sampling |
| ``packing`` | packing token sequences, vector best-fit |
| ``neighbours`` | nearest neighbours, stable projections in a kd-tree |
| ``warc`` | WARC archives with an embedded Zstandard dictionary |
| ``line_dedup`` | repeated lines, levelled sorted runs of line hashes |
| ``quality`` | quality classifier from positive and unlabelled texts |
| ``nnls_packing`` | packing token sequences, non-negative least squares over combinations of lengths |
| ``token_links`` | cross-tokenizer alignment, products of sparse incidence matrices |
| ``phrases`` | phrase collocations on a weighted de Bruijn graph |
| ``components`` | connected components of a link table, for ``simhash`` and ``embed_dedup`` |
| ``vectors`` | vectors from array columns, for ``embed_dedup`` and ``neighbours`` |

Functions that run in Python workers are shipped by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
