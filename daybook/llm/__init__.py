"""Operations of a training-data pipeline, each a function of DataFrames.

Nothing else in the library imports this subpackage. The queries over the test
tables are in `daybook.llm.queries`.
"""
