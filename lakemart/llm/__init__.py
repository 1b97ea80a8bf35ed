"""Training-data operators at corpus scale (numbered 1 to 10) and their queries.

Nothing else in the library imports this subpackage.  Operators take
DataFrames and column names; the thin ``opN_<name>`` queries of
``lakemart.llm.queries`` apply them to whole tables.
"""
