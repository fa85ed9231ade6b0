"""Training-data pipeline operators.

Each module holds one operator as functions from DataFrame to DataFrame with
column names as arguments; :mod:`outcomelab.llm.queries` wraps them as the
registered ``opN_*`` queries.  Nothing outside this subpackage imports it.
"""
