from candlewick.streaming.bronze import stream_table

__all__ = ["stream_table"]
