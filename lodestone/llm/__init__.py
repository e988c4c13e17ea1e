"""Operators that prepare a text corpus for training; nothing else imports them."""
