"""Training-data operators: thirteen Spark jobs over tables of documents, pages or vectors.

Nothing else in the library imports this subpackage.
"""
