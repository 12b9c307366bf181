"""tillroll: retail customer analytics as Spark DataFrame jobs.

Everything starts from one table of till lines (see ``tillroll.schema``) and
every function takes and returns DataFrames.
"""

__version__ = "0.1.0"
