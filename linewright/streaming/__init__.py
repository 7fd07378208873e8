from .flows import (
    labelled_stream,
    quarantine_stream,
    run_to_end,
    watermarked,
    windowed_stream,
)

__all__ = ["labelled_stream", "quarantine_stream", "run_to_end", "watermarked", "windowed_stream"]
