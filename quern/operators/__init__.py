"""Relational operators over documents, conversations, preference pairs and token arrays."""
