"""Written tables that tasks read by themselves, batch by batch.

Search operators lay blocks of one side (the corpus) against all of the other (a
query set).  A task holds one block and streams the written query table past it,
so neither side is collected, broadcast or multiplied through a shuffle.
"""

from __future__ import annotations

from labelfold.llm.common import filesystem


def record_batches(path: str, columns: list[str], rows: int = 4096):
    """Arrow record batches of a Parquet folder in the shared location, in a fixed order."""
    import pyarrow.dataset as ds

    fs, local = filesystem(path)
    for part in sorted(ds.dataset(local, filesystem=fs, format="parquet").get_fragments(), key=lambda f: f.path):
        yield from part.to_batches(columns=columns, batch_size=rows)
