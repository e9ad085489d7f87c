"""Bindings of the operators to the star-schema test tables, each with its SQL oracle."""
