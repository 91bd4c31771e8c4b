"""Declared schemas of every table. Names, order and types are the data contract."""

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


INT, LONG, STRING = T.IntegerType(), T.LongType(), T.StringType()

AUTH = _struct(time=INT, source_user=STRING, source_computer=STRING)

DNS = _struct(time=INT, SourceComputer=STRING, ComputerResolved=STRING)

FLOWS = _struct(
    time=INT,
    duration=INT,
    src_computer=STRING,
    src_port=STRING,
    dst_computer=STRING,
    dst_port=STRING,
    protocol=INT,
    packets_count=INT,
    bytes_count=INT,
)

PROC = _struct(time=INT, user_domain=STRING, computer=STRING, process_name=STRING, start_end=STRING)

LOGS = {"auth": AUTH, "dns": DNS, "flows": FLOWS, "proc": PROC}

FEED_ENTRY = _struct(
    url=STRING, host=STRING, threat=STRING, date_added=STRING, tags=T.ArrayType(STRING)
)

FEED_DOCUMENT = _struct(query_status=STRING, urls=T.ArrayType(FEED_ENTRY))

IOCS = _struct(url=STRING, host=STRING, threat=STRING, date_added=STRING, tags=STRING)

GOLD = _struct(
    time_bucket=LONG,
    user=STRING,
    src_computer=STRING,
    total_flows=LONG,
    total_bytes=LONG,
    total_packets=LONG,
    active_processes=LONG,
    malicious_hits=LONG,
)

# The gold columns stored inside the data files and summarised by the report
# (time_bucket lives in the directory names).
GOLD_MEASURES = [
    "total_flows",
    "total_bytes",
    "total_packets",
    "active_processes",
    "malicious_hits",
]
