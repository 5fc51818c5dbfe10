"""The library applied to the TPC-H-like tables the repository is checked with."""
