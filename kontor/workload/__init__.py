"""The operators bound to the test tables, each with its SQL counterpart."""
