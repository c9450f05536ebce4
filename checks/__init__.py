"""The warehouse operators bound to the generic test tables, each with its SQL twin."""
