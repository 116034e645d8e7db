from .base import Answered, Backend, LabelSet, Topic
from .calling import CallableBackend
from .lexicon import induce_lexicon, lexicon_scores
from .offline import OfflineBackend

__all__ = ["Answered", "Backend", "CallableBackend", "LabelSet", "OfflineBackend", "Topic", "induce_lexicon", "lexicon_scores"]
