from crowdpulse.streaming.active_posts import ActivePostsStream
from crowdpulse.streaming.recommend import RecommendationStream
from crowdpulse.streaming.sinks import write_stream
from crowdpulse.streaming.spam import SpamStream
from crowdpulse.streaming.trees import ThreadStream

__all__ = [
    "ActivePostsStream",
    "RecommendationStream",
    "SpamStream",
    "ThreadStream",
    "write_stream",
]
