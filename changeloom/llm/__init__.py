"""Operators on text for training corpora; nothing else imports this package."""
