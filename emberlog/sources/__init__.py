from emberlog.sources.bronze import read_auth, read_dns, read_flows, read_lines, read_log, read_proc
from emberlog.sources.bronze import normalise_dns, read_flagged_log, split_malformed
from emberlog.sources.feed import flatten_feed, read_threat_feed
from emberlog.sources.tables import read_gold, read_silver

__all__ = [
    "flatten_feed",
    "normalise_dns",
    "read_auth",
    "read_dns",
    "read_flagged_log",
    "read_flows",
    "read_gold",
    "read_lines",
    "read_log",
    "read_proc",
    "read_silver",
    "read_threat_feed",
    "split_malformed",
]
