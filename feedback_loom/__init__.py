"""Analysis of user texts on Spark: from a table of texts to ranked, quantified problems."""

from .backends import CallableBackend, OfflineBackend, Topic, induce_lexicon
from .plans import FeedbackAnalysis, Results, analyze
from .session import build_session
from .sources import texts_from

__version__ = "0.1.0"
__all__ = [
    "CallableBackend", "FeedbackAnalysis", "OfflineBackend", "Results", "Topic", "analyze", "build_session",
    "induce_lexicon", "texts_from",
]
