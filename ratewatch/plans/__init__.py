"""Compositions of operators: the pipeline models, reports, and the driver-table test bed."""
