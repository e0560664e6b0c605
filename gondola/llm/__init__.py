"""Operators of a training-data pipeline over text corpora; nothing else imports this package."""
