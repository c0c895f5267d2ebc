"""clipledger: a labelled-audio corpus ledger on Spark DataFrames.

Everything takes and returns DataFrames.  Actions happen only in writers and
where an operator needs a fact about the data before it can plan (a voice
count, a stored ordering, the budget left after a voice).
"""
