"""Operators for building training corpora: mixing, language labels, licences, duplicates, personal data, pages, chats."""
