"""Operators for training-data pipelines: filtering, language, duplicates, mixing, sharding, secrets, pages, chats."""
