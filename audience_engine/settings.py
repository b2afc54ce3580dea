"""Thresholds and caps of a run, passed explicitly to the operators that need them."""

from __future__ import annotations

import datetime as dt
from dataclasses import asdict, dataclass, field

from audience_engine import vocabulary as voc


@dataclass(frozen=True)
class Settings:
    """One run's filters, caps and word lists; ``as_of`` is the only clock."""

    as_of: dt.datetime = dt.datetime(2024, 3, 31)
    min_chars: int = 6
    ascii_ratio: float = 0.95
    max_toxicity: float = 0.30
    min_density: float = 0.20
    positive_above: float = 0.2
    window_days: int = 60
    report_days: int = 7
    #: Collect only comments that are English.
    english_only: bool = False
    videos_per_channel: int = 2
    max_videos: int = 120
    videos_per_category: int = 80
    videos_per_keyword: int = 20
    comments_per_popular_video: int = 20
    comments_per_marketing_video: int = 50
    posts_per_community: int = 2
    comments_per_post: int = 150
    score_percentile: float = 0.75
    topic_count: int = 30
    topic_min_size: int = 5
    topic_label_words: int = 6
    topic_dims: int = 100
    topic_starts: int = 3
    topic_vocabulary: int = 100_000
    max_document_share: float = 0.98
    explore_share: float = 0.1
    toxic_words: tuple[str, ...] = field(default=voc.TOXIC_WORDS)
    signal_phrases: tuple[str, ...] = field(default=voc.SIGNAL_PHRASES)
    positive_words: tuple[str, ...] = field(default=voc.POSITIVE_WORDS)
    negative_words: tuple[str, ...] = field(default=voc.NEGATIVE_WORDS)
    stop_words: tuple[str, ...] = field(default=voc.ENGLISH_STOP_WORDS + voc.DOMAIN_STOP_WORDS)

    def manifest(self) -> dict:
        """The settings as plain values, for the run manifest."""
        values = asdict(self)
        values["as_of"] = self.as_of.isoformat() + "Z"
        return values
