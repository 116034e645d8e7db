from . import answers, columns, tokens

__all__ = ["answers", "columns", "tokens"]
