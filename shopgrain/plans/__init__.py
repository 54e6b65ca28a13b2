"""The tables: silver, gold, data-quality suites and exploratory views."""
