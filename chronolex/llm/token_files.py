"""Token-id files: flat unsigned integers and 64-bit document offsets, memory-mapped by readers."""

import contextlib
import itertools
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, Window, functions as F

from chronolex.llm.pieces import default_path, encoder, slices
from chronolex.sources.scratch import materialize

END_ID = 0
NO_ID = np.iinfo(np.int64).min  # stands for a NULL id in the files
READ_DOCUMENTS = 10_000


def _system(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if ":/" in folder else (fs.LocalFileSystem(), folder)


def _writer(folder: str, path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _system(folder)
        system.create_dir(base, recursive=True)
        # The name is this attempt's own; only the attempt that Spark commits gets into the manifest.
        name, bpe = uuid.uuid4().hex, encoder(path)
        first, docs, tokens = None, 0, 0
        with contextlib.ExitStack() as files:
            out = {k: files.enter_context(system.open_output_stream(f"{base}/{name}.{k}")) for k in ("ids", "offsets", "docs")}
            out["offsets"].write(np.zeros(1, "<u8").tobytes())
            for batch in batches:
                if first is None and len(batch):
                    first = batch.column("first").slice(0, 1)
                for start, stop in slices(batch.column("text")):
                    ids, per_piece, _, pieces = bpe.encode(batch.column("text").slice(start, stop - start))
                    ends = np.cumsum(np.add.reduceat(per_piece, np.cumsum(pieces) - pieces))
                    out["ids"].write(np.insert(ids, ends, end_id).astype(bpe.dtype).tobytes())
                    ends += np.arange(1, len(ends) + 1)
                    out["offsets"].write((tokens + ends).astype("<u8").tobytes())
                    tokens += int(ends[-1])
                doc_ids = pc.fill_null(batch.column("id"), int(NO_ID)).to_numpy()
                out["docs"].write(doc_ids.astype("<i8").tobytes())
                docs += len(batch)
                pa.default_memory_pool().release_unused()
        if docs:
            values = [pa.array([name]), first, pa.array([docs]), pa.array([tokens]), pa.array([bpe.dtype.itemsize])]
            yield pa.RecordBatch.from_arrays(values, names=["file", "first", "docs", "tokens", "width"])

    return run


def write(
    docs: DataFrame,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    end_id: int = END_ID,
    partitions: int | None = None,
) -> DataFrame:
    """Encode every text, write files below `folder`, and return the manifest.

    Rows go to tasks by ranges of the id (then a hash of the text, so that even many rows with one id
    are cut) and are sorted in each. A task writes `<name>.ids`, the ids of its documents one after
    the other, each closed by `end_id`, as little-endian unsigned integers of `width` bytes (two where
    the vocabulary allows); `<name>.offsets`, a zero and the unsigned 64-bit end of each document; and
    `<name>.docs`, the signed 64-bit document ids. The manifest has a row per file in order of
    `base`, the ids in all files before it, a prefix sum over files. NULL texts are empty; NULL ids
    come first; rows may repeat an id; an empty table has an empty manifest. A lost task is written
    anew under another name, and only files in the manifest count. All executors must see the folder.
    `partitions` defaults to spark.sql.shuffle.partitions. Other columns are not looked at. Runs
    actions.
    """
    path = path or default_path()
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    order = [F.col("id").asc_nulls_first(), F.col("tie").asc_nulls_first()]
    count = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(count, *order)
    ordered = ranged.sortWithinPartitions(*order).select("id", "text", F.struct("id", "tie").alias("first"))
    schema = "file string, first struct<id: bigint, tie: bigint>, docs long, tokens long, width long"
    files = materialize(ordered.mapInArrow(_writer(folder, path, end_id), schema), "token-files")
    before = Window.orderBy(F.col("first.id").asc_nulls_first(), F.col("first.tie")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    base = F.coalesce(F.sum("tokens").over(before), F.lit(0).cast("long"))
    return materialize(files.withColumn("base", base), "token-manifest")


def _mapped(system: fs.FileSystem, name: str, dtype: str) -> np.ndarray:
    """The file's numbers, memory-mapped where the folder is mounted."""
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(name, dtype=dtype, mode="r") if system.get_file_info(name).size else np.empty(0, dtype)
    with system.open_input_file(name) as file:
        return np.frombuffer(file.readall(), dtype=dtype)


def _reader(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, place = _system(folder)
        for row in itertools.chain.from_iterable(batch.to_pylist() for batch in batches):
            ids, offsets, docs = (
                _mapped(system, f"{place}/{row['file']}.{kind}", dtype)
                for kind, dtype in (("ids", f"<u{row['width']}"), ("offsets", "<u8"), ("docs", "<i8"))
            )
            for at in range(0, len(docs), READ_DOCUMENTS):
                ends = offsets[at : at + READ_DOCUMENTS + 1].astype(np.int64)
                doc_ids = np.asarray(docs[at : at + READ_DOCUMENTS])
                crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in itertools.pairwise(ends)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, mask=doc_ids == NO_ID),
                        pa.array(ends[:-1] + row["base"]),
                        pa.array(np.diff(ends)),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return run


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per document from the files of a manifest: doc_id, start, n_tokens, ids_crc32.

    `start` counts the ids of all documents before; `n_tokens` includes the end id; the checksum is
    over the ids as little-endian unsigned 32-bit integers.
    """
    files = max(1, manifest.count())
    # A number of partitions of its own, which adaptive execution leaves as it is: about a file each.
    spread = manifest.select("file", "width", "base").repartitionByRange(files, "base")
    return spread.mapInArrow(_reader(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")
