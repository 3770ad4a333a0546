"""Tessera: directory and listing analytics, written as Spark DataFrame operators."""
