"""Jobs put together from the operators.

Each `*_plan` returns what would be done and writes nothing, which is the dry
run; writing is a separate call.
"""
