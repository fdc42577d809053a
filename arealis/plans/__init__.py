"""Whole plans: the queries over the test tables, the indicator build, the exported documents."""
