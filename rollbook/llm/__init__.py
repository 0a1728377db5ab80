"""Operators for preparing training text: archives, chats, pages, fingerprints, joins, packing, quality."""
