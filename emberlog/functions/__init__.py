from emberlog.functions.columns import hit_flag, numeric_columns, time_bucket, url_host

__all__ = ["hit_flag", "numeric_columns", "time_bucket", "url_host"]
