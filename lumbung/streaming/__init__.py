from lumbung.streaming.file_drops import append_file_drops

__all__ = ["append_file_drops"]
