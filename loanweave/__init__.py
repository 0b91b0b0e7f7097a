"""loanweave: credit-risk panel analytics written as Spark DataFrame jobs.

Every operator is a function from DataFrame to DataFrame.  The entity key and
the time column default to the loan panel's names but are parameters, so the
same operators work on any entity-by-month panel.
"""
