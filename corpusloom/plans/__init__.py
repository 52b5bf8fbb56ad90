"""Steps put together: whole corpora and whole evaluations."""
