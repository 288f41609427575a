"""Operators for training data: near-duplicates, decontamination, extraction, scoring, tokens, chats.

Nothing else in the library imports this subpackage.
"""
