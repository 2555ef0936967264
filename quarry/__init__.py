"""quarry: table analytics re-expressed as Spark DataFrame operators.

Every public operator takes DataFrames (plus column names / parameters)
and returns a DataFrame.  Work is declared with the DataFrame / SQL API so
Catalyst can prune, push down and pick join strategies; nothing is
collected to the driver except one-row scalar subqueries.
"""

__version__ = "0.1.0"
