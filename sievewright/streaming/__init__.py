"""The same scoring and waves over files that keep arriving."""
