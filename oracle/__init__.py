"""Expected results as SQL over the source tables, written apart from the library."""
