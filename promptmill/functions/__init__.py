"""Column expressions shared by the operators."""

from promptmill.functions.encoding import Encoder, encoded_count, encoder_from, tokenizer_encoder
from promptmill.functions.fields import (
    category_key,
    category_label,
    configure,
    field,
    once,
    text_value,
)
from promptmill.functions.text import WHITESPACE, estimate_tokens, strip, tokens

__all__ = [
    "WHITESPACE",
    "Encoder",
    "category_key",
    "category_label",
    "configure",
    "encoded_count",
    "encoder_from",
    "estimate_tokens",
    "field",
    "once",
    "strip",
    "text_value",
    "tokenizer_encoder",
    "tokens",
]
