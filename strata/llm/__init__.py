"""Operators of a training-data pipeline (secrets, chat, dedup, decontamination, quality, mixing, PII).

Nothing else in the library imports this subpackage; ``queries.py`` registers
its queries and ``__spark_entry__.py`` adds them when it can be imported.
"""
