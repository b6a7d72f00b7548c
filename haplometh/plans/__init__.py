"""The five jobs, from input files to written tables."""
