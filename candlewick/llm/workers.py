"""Help for code in Python workers."""

import pyarrow as pa


def release_memory() -> None:
    """Give freed Arrow buffers back: a Python worker lives on for the next
    stages' tasks."""
    pa.default_memory_pool().release_unused()
