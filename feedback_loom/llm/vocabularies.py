"""Where the public tokenizer files lie that queries use by default; operators take any path."""


def path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pattern() -> str:
    """The splitting pattern of the byte-level vocabularies."""
    import public_tokenizers

    return public_tokenizers.PATTERN
