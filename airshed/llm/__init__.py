"""Training-data operators: near and exact deduplication, filters, tokenization and redaction of text corpora.

Every operator takes a DataFrame with an id and a text column (other columns are ignored or carried by name) and returns
a DataFrame. ``queries`` registers one query per operator and the corpus pipeline.
"""
