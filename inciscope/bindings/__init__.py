"""Bindings of the operators to the test tables, with equivalent DuckDB SQL for each."""
