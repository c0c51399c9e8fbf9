"""Operations of a training-data pipeline over documents, vectors, pages and conversations.

Nothing else in the library imports this package. Operators whose work does not fit built-in
expressions run as Arrow batches inside Spark tasks; see the docstring of each module for the
method, the columns and the defined results in odd cases.
"""
