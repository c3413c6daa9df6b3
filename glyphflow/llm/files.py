"""Binary files in the shared folder, opened by executors through the file system that the folder's URI names."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq

#: Rows of a Parquet file are held up to so many bytes, then written as a row group.
GROUP = 16 << 20


def opened(uri: str):
    """File system and path of a URI; a bare path is local."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def writer(uri: str):
    system, path = opened(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path, compression=None)


def reader(uri: str):
    system, path = opened(uri)
    return system.open_input_file(path)


class Rows:
    """A Parquet file that a task writes by itself: no row goes back to the JVM, whose local file system starts a process
    (chmod) for each file it makes."""

    def __init__(self, uri: str, schema: pa.Schema):
        self.name, self.schema, self.file = uri, schema, writer(uri)
        self.out = pq.ParquetWriter(self.file, schema, compression="zstd", compression_level=3, use_dictionary=False)
        self.held, self.size = [], 0

    def add(self, batch: pa.RecordBatch) -> None:
        self.held.append(batch)
        self.size += batch.nbytes
        if self.size >= GROUP:
            self.flush()

    def flush(self) -> None:
        if self.held:
            self.out.write_table(pa.Table.from_batches(self.held, self.schema))
        self.held, self.size = [], 0

    def close(self) -> None:
        self.flush()
        self.out.close()
        self.file.close()
