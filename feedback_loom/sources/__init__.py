from .texts import (
    default_stop_words,
    load_results,
    preview,
    preview_conclusion,
    read_stop_words,
    split_texts_csv,
    read_texts_csv,
    save_results,
    split_usable,
    texts_from,
)

__all__ = [
    "default_stop_words", "load_results", "preview", "preview_conclusion", "read_stop_words", "split_texts_csv",
    "read_texts_csv", "save_results", "split_usable", "texts_from",
]
