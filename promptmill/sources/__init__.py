"""Readers: JSON lines, chat files, prompt arrays, and finding them."""
