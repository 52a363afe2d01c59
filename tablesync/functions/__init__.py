"""Column functions: masking, names, coercions and anonymisation."""
