"""Spark-first analytics over job postings: sources, rules, marts, reports and data-quality operators."""
