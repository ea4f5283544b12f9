"""Run parameters. Nothing in the engine reads the clock or the machine."""

from __future__ import annotations

from dataclasses import dataclass, field

# Source types in their order, which is also the order of ties.
REGISTRY = ("rss", "twitter", "google", "github", "github_trending", "api", "v2ex", "zhihu", "weibo", "toutiao", "reddit")


# Scores of engagement and the marks of which one must be reached.
ENGAGEMENT = {
    "twitter": (
        (5, (("like_count", 1000), ("retweet_count", 500), ("reply_count", 300))),
        (3, (("like_count", 500), ("retweet_count", 200), ("reply_count", 150))),
        (2, (("like_count", 100), ("retweet_count", 50), ("reply_count", 60))),
        (1, (("like_count", 50), ("retweet_count", 20), ("reply_count", 20))),
    ),
    "reddit": (
        (5, (("score", 1000), ("num_comments", 300))),
        (3, (("score", 500), ("num_comments", 150))),
        (2, (("score", 200), ("num_comments", 80))),
        (1, (("score", 100), ("num_comments", 30))),
    ),
    "v2ex": ((5, (("replies", 200),)), (3, (("replies", 100),)), (2, (("replies", 50),)), (1, (("replies", 20),))),
}


# Bounds, thresholds and scores of the pipeline.
@dataclass(frozen=True)
class Params:
    now: str = "2026-04-21T00:00:00+00:00"
    top_n: int = 5
    word_bucket: int = 128
    cjk_bucket: int = 128
    history_bucket: int = 96
    history_candidates: int = 48
    hot_threshold: float = 0.86
    duplicate_threshold: float = 0.92
    rank_score: float = 3.0
    hot_step: float = 2.0
    hot_cap: float = 6.0
    #: (least similarity to an archived title, score)
    history_tiers: tuple[tuple[float, float], ...] = ((0.96, -16.0), (0.92, -12.0), (0.88, -8.0))
    slow_thresholds: tuple[float, ...] = (3.0, 5.0)
    health_days: int = 7
    degraded_rate: float = 0.5
    retention_days: int = 30
    fuzzy_backend: str = "indel"
    noise_limit: float = 4.0
    #: source_type -> ((score, ((metric, least), ...)), ...), highest first; one metric that reaches its mark suffices
    engagement: dict = field(default_factory=lambda: ENGAGEMENT)


DEFAULTS = Params()
