"""Aligning structured records with positioned text, as Spark DataFrame operators."""
