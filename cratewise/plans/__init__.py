"""The library's tables and reports, made from the operators."""
