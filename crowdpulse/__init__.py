"""Analytics of social-network activity streams, written as Spark jobs."""

from crowdpulse.plans.api import (
    active_posts,
    active_posts_people,
    burst_spam,
    friend_recommendations,
    low_vocabulary_spam,
    post_trees,
    spammers,
)
from crowdpulse.schema import Weights
from crowdpulse.sources.wire import parse_events

__all__ = [
    "Weights",
    "active_posts",
    "active_posts_people",
    "burst_spam",
    "friend_recommendations",
    "low_vocabulary_spam",
    "parse_events",
    "post_trees",
    "spammers",
]
