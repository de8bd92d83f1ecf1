"""Column and type helpers shared by the operators."""
