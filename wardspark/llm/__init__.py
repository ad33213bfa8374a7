"""Operations of a training-data pipeline. Nothing else in the library imports this subpackage.

Shared rules: operators take the columns that they name and ignore all others, so extra columns, also
with names of result columns, change nothing. Null texts count as empty unless a docstring says
otherwise. Results depend on the rows only, not on their order or partitioning.
"""
