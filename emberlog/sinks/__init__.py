from emberlog.sinks.writers import write_gold, write_iocs, write_sample, write_silver

__all__ = ["write_gold", "write_iocs", "write_sample", "write_silver"]
