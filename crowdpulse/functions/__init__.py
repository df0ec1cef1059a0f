from crowdpulse.functions.text import parse_tags, tokens, unique_word_ratio
from crowdpulse.functions.timegrid import parse_utc, slot_index, slot_time

__all__ = ["parse_tags", "parse_utc", "slot_index", "slot_time", "tokens", "unique_word_ratio"]
