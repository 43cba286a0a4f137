"""Part of foliate."""
