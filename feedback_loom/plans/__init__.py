from .analyze import Results, analyze
from .stages import (
    CauseSummarizer,
    ClusterDescriber,
    ConclusionWriter,
    FeedbackAnalysis,
    LabelAssigner,
    SentimentScorer,
)

__all__ = [
    "CauseSummarizer", "ClusterDescriber", "ConclusionWriter", "FeedbackAnalysis", "LabelAssigner", "Results",
    "SentimentScorer", "analyze",
]
