"""Small column-level helpers shared by the operators."""
