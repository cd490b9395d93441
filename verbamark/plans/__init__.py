"""Whole stages composed of operators, and where they cut their lineage."""
