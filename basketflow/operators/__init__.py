"""The work of the six data products, one module for each."""
