"""ledgerloom: user-level analytics jobs written as PySpark DataFrame operators.

Every operator takes DataFrames and returns DataFrames.  Heavy work stays in
Catalyst plans; the few actions (rank slices, graph rounds) are documented at
the operator that runs them.
"""
