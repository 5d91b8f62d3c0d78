"""Column functions: hashing, text, chat, arrays and vectors."""
