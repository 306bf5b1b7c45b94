"""The rule list that ``quality_training`` induced; written by it."""

# fmt: off
RULES: list[tuple[str, list[tuple[str, str, float]]]] = [
    ('junk', [('coded', '>', 0.5088)]),
    ('junk', [('common_words', '<=', 0.136), ('prose', '>', 0.9777), ('common_words', '<=', 0.0509)]),
    ('junk', [('menu', '>', 0.8425), ('mean_word_length', '<=', 4.2315)]),
    ('junk', [('repeated_pairs', '>', 0.211)]),
    ('table', [('digit_ratio', '>', 0.1973), ('marked', '<=', 0.5)]),
    ('table', [('named', '>', 0.4335)]),
    ('table', [('delimited', '>', 0.4049)]),
    ('list', [('prose', '<=', 0.5018), ('menu', '<=', 0.3425)]),
]
