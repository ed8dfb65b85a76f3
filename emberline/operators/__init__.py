"""Dataflow operators on DataFrames, and the dense kernels that some of them call."""
