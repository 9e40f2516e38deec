"""Vector file ingest and export as a Spark data source.

``spark.read.format("knnvectors").option("kind", K).load(path)`` -> ``(id BIGINT, v ARRAY<DOUBLE>)``
for ``K`` in ``fvecs`` (repeated little-endian ``int32 dim`` + ``dim x float32``), ``idx`` (IDX
images: big-endian ``uint32 magic, n, rows, cols`` then ``n*rows*cols`` unsigned bytes) and ``text``
(first line ``n d``, then ``d`` numbers per line).

Files are cut into byte-range partitions at plan time from their sizes and headers only; each
task opens its own range, so ingest is parallel and nothing passes through the driver.  The id
is the record's position over all files in path order (the reference's implicit row number).
A bad magic, a record of another dimension or a truncated file raises instead of stopping early.
Text rows carry their range and their place in it; one extra distributed pass counts the lines of each range into a
table, whose prefix sums (made in Spark, in blocks of ranges) are joined to the rows and give their ids.

``df.write.format("knnvectors").option("kind", K).save(dir)`` writes one part file per partition,
named by partition index, so ``repartitionByRange`` + ``sortWithinPartitions`` on ``id`` gives files
whose positions equal the ids.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition,
                                    WriterCommitMessage)

from knnspark.functions.distance import arrow_matrix
from knnspark.session import scratch_path

SCHEMA = "id bigint, v array<double>"
FORMAT = "knnvectors"

# Fixed value of the IDX format: magic number of an unsigned-byte 3-D (image) file.
IDX_IMAGE_MAGIC = 0x00000803

DEFAULT_SPLIT_BYTES = 64 * 1024 * 1024


def _fs(path: str):
    from pyarrow import fs
    filesystem, p = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    return filesystem, p


def _list_files(path: str) -> list[tuple[str, int]]:
    from pyarrow import fs
    filesystem, p = _fs(path)
    info = filesystem.get_file_info(p)
    if info.type == fs.FileType.Directory:
        sel = fs.FileSelector(p, recursive=False)
        files = [(f.path, f.size) for f in filesystem.get_file_info(sel)
                 if f.type == fs.FileType.File and not f.base_name.startswith(("_", "."))]
    elif info.type == fs.FileType.File:
        files = [(p, info.size)]
    else:
        raise FileNotFoundError(path)
    scheme = path.split("://")[0] + "://" if "://" in path else ""
    return sorted((scheme + f if scheme and not f.startswith(scheme) else f, s) for f, s in files)


def _read_range(path: str, start: int, length: int) -> bytes:
    filesystem, p = _fs(path)
    with filesystem.open_input_file(p) as f:
        f.seek(start)
        return f.read(length)


@dataclass
class _Range(InputPartition):
    path: str
    start: int           # byte offset of the first record
    count: int           # records (fvecs/idx) or byte length (text)
    first_id: int
    dim: int
    index: int = 0


def _binary_plan(kind: str, files: list[tuple[str, int]], split_bytes: int) -> list[_Range]:
    out: list[_Range] = []
    next_id = 0
    for path, size in files:
        if kind == "fvecs":
            if size < 4:
                raise ValueError(f"{path}: truncated fvecs file")
            dim = struct.unpack("<i", _read_range(path, 0, 4))[0]
            if dim <= 0:
                raise ValueError(f"{path}: bad dimension {dim}")
            rec = 4 + 4 * dim
            if size % rec:
                raise ValueError(f"{path}: truncated fvecs file ({size} bytes, record {rec})")
            n, header = size // rec, 0
        else:
            if size < 16:
                raise ValueError(f"{path}: truncated IDX header")
            magic, n, rows, cols = struct.unpack(">IIII", _read_range(path, 0, 16))
            if magic != IDX_IMAGE_MAGIC:
                raise ValueError(f"{path}: bad IDX magic {magic:#x}")
            dim, header, rec = rows * cols, 16, rows * cols
            if size < header + n * rec:
                raise ValueError(f"{path}: truncated IDX file ({size} bytes for {n} images)")
        per = max(1, split_bytes // rec)
        for s in range(0, n, per):
            c = min(per, n - s)
            out.append(_Range(path, header + s * rec, c, next_id + s, dim))
        next_id += n
    return out


def _text_plan(files: list[tuple[str, int]], split_bytes: int) -> list[_Range]:
    out = []
    for path, size in files:
        for s in range(0, max(size, 1), split_bytes):
            out.append(_Range(path, s, min(split_bytes, size - s), -1, -1))
    for i, r in enumerate(out):
        r.index = i
    return out


def _text_lines(r: _Range) -> list[bytes]:
    """Lines that start inside ``[start, start+count)`` of the file (Hadoop line-split rule)."""
    filesystem, p = _fs(r.path)
    with filesystem.open_input_file(p) as f:
        size = f.size()
        begin = r.start
        if begin > 0:
            f.seek(begin - 1)
            prev = f.read(1)
            if prev != b"\n":
                # skip the rest of a line owned by the previous range
                while True:
                    block = f.read(1 << 16)
                    if not block:
                        return []
                    k = block.find(b"\n")
                    if k >= 0:
                        begin = f.tell() - len(block) + k + 1
                        break
        end = r.start + r.count
        if begin >= end or begin >= size:
            return []
        f.seek(begin)
        data = f.read(end - begin)
        if not data.endswith(b"\n"):
            rest = b""
            while True:
                block = f.read(1 << 16)
                if not block:
                    break
                k = block.find(b"\n")
                if k >= 0:
                    rest += block[:k + 1]
                    break
                rest += block
            data += rest
        return data.splitlines()


def _text_header(path: str, line: bytes) -> tuple[int, int]:
    """Rows and numbers a row that a text file's first line declares."""
    try:
        n, d = map(int, line.split())
    except ValueError:
        raise ValueError(f"{path}: the first line must be \"n d\"") from None
    return n, d


def _batch(ids: np.ndarray, mat: np.ndarray) -> pa.RecordBatch:
    n, d = mat.shape
    offsets = pa.array(np.arange(0, (n + 1) * d, d, dtype=np.int32))
    values = pa.ListArray.from_arrays(offsets, pa.array(mat.ravel().astype(np.float64)))
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), values], names=["id", "v"])


class VectorFileReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.kind = options.get("kind", "fvecs").lower()
        self.split_bytes = int(options.get("splitBytes", DEFAULT_SPLIT_BYTES))
        self.count_only = options.get("countLines", "false") == "true"
        if self.kind not in ("fvecs", "idx", "text"):
            raise ValueError(f"unknown vector file kind {self.kind!r}")

    def partitions(self):
        files = _list_files(self.path)
        if self.kind == "text":
            return _text_plan(files, self.split_bytes)
        return _binary_plan(self.kind, files, self.split_bytes)

    def read(self, partition: _Range):
        r = partition
        if r is None:  # a folder without files
            return
        if self.kind == "text":
            lines = _text_lines(r)
            body = [ln for ln in (lines[1:] if r.start == 0 else lines) if ln.strip()]  # every file begins with "n d"
            if self.count_only:
                declared = _text_header(r.path, lines[0] if lines else b"") if r.start == 0 else (-1, -1)
                yield (int(r.index), len(body), r.path, *declared)
                return
            if body:
                dims = {len(line.split()) for line in body}
                if len(dims) > 1:
                    raise ValueError(f"{r.path}: rows of {sorted(dims)} numbers near byte {r.start}")
                mat = np.array(b" ".join(body).split(), dtype=np.float64).reshape(len(body), -1)
                rows = _batch(np.arange(len(body), dtype=np.int64), mat)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(body), r.index), pa.int32()), *rows.columns], names=["range", "pos", "v"])
            return
        if r.count == 0:
            return
        if self.kind == "fvecs":
            rec = 4 + 4 * r.dim
            raw = np.frombuffer(_read_range(r.path, r.start, r.count * rec), dtype="<i4").reshape(r.count, rec // 4)
            if not np.all(raw[:, 0] == r.dim):
                raise ValueError(f"{r.path}: record of another dimension near byte {r.start}")
            mat = raw[:, 1:].view("<f4").astype(np.float64)
        else:
            raw = np.frombuffer(_read_range(r.path, r.start, r.count * r.dim), dtype=np.uint8)
            mat = raw.reshape(r.count, r.dim).astype(np.float64)
        yield _batch(np.arange(r.first_id, r.first_id + r.count, dtype=np.int64), mat)


@dataclass
class _Written(WriterCommitMessage):
    tmp: str
    final: str


class VectorFileWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool = False):
        self.path = options["path"].rstrip("/")
        self.kind = options.get("kind", "fvecs").lower()
        self.rows = int(options.get("rows", 0))
        self.cols = int(options.get("cols", 0))
        self.overwrite = overwrite

    def write(self, iterator):
        from pyspark import TaskContext

        if self.kind not in ("fvecs", "idx", "text"):
            raise ValueError(f"cannot write kind {self.kind!r}")
        ctx = TaskContext.get()
        pid, attempt = ctx.partitionId(), ctx.attemptNumber()
        filesystem, p = _fs(self.path)
        filesystem.create_dir(p, recursive=True)
        # Each attempt writes its own hidden file; the driver's commit renames the winners, so a
        # retried or speculative task never leaves a torn or duplicate part file.
        name = f"{p}/.part-{pid:05d}.{self.kind}.attempt-{attempt}-{ctx.taskAttemptId()}"
        final = f"{p}/part-{pid:05d}.{self.kind}"
        # Batches are written as they arrive.  A header that needs the number of rows is written when
        # they are known: the body goes to a second hidden file, which is then copied behind it.
        n, d = 0, 0
        body = name if self.kind == "fvecs" else f"{name}.body"
        with filesystem.open_output_stream(body) as f:
            for rb in iterator:
                if not rb.num_rows:
                    continue
                mat, _ = arrow_matrix(rb.column(rb.schema.get_field_index("v")), d or None)
                n, d = n + len(mat), mat.shape[1]
                f.write(self._encoded(mat))
        if n == 0:
            filesystem.delete_file(body)
            return _Written("", "")
        if self.kind != "fvecs":
            rows, cols = (self.rows, self.cols) if self.rows * self.cols == d else (1, d)
            head = struct.pack(">IIII", IDX_IMAGE_MAGIC, n, rows, cols) if self.kind == "idx" else f"{n} {d}\n".encode()
            with filesystem.open_output_stream(name) as out, filesystem.open_input_stream(body) as f:
                out.write(head)
                while block := f.read(1 << 20):
                    out.write(block)
            filesystem.delete_file(body)
        return _Written(name, final)

    def _encoded(self, mat: np.ndarray) -> bytes:
        if self.kind == "fvecs":
            rec = np.empty((len(mat), mat.shape[1] + 1), dtype="<i4")
            rec[:, 0] = mat.shape[1]
            rec[:, 1:] = mat.astype("<f4").view("<i4")
            return rec.tobytes()
        if self.kind == "idx":
            pixels = np.rint(mat)
            if ((pixels < 0) | (pixels > 255)).any():
                raise ValueError("an IDX image file holds values from 0 to 255 only")
            return pixels.astype(np.uint8).tobytes()
        return "".join(" ".join(map(repr, row)) + "\n" for row in mat.tolist()).encode()

    def commit(self, messages):
        from pyarrow import fs

        filesystem, p = _fs(self.path)
        written = [m for m in messages if m is not None and m.tmp]
        if self.overwrite and filesystem.get_file_info(p).type == fs.FileType.Directory:
            # Parts of an earlier write, and what its failed attempts left, are no part of this one.
            ours = {m.tmp for m in written}
            for info in filesystem.get_file_info(fs.FileSelector(p, recursive=False)):
                if info.type == fs.FileType.File and info.path not in ours and info.base_name.lstrip(".").startswith("part-"):
                    filesystem.delete_file(info.path)
        for m in written:
            filesystem.move(m.tmp, m.final)

    def abort(self, messages):
        filesystem, _ = _fs(self.path)
        for m in messages:
            if m is not None and m.tmp:
                try:
                    filesystem.delete_file(m.tmp)
                except Exception:  # noqa: BLE001
                    pass


class VectorFileDataSource(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        if self.options.get("countLines", "false") == "true":
            return "range int, lines bigint, path string, n bigint, d int"
        return "range int, pos bigint, v array<double>" if self.options.get("kind", "").lower() == "text" else SCHEMA

    def reader(self, schema):
        return VectorFileReader(self.options)

    def writer(self, schema, overwrite):
        return VectorFileWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(VectorFileDataSource)


# Dataset type names accepted by the reference's loader, mapped to file formats.
KIND_ALIASES = {"mnist": "idx", "sift": "fvecs"}


def read_vectors(spark: SparkSession, path: str, kind: str, split_bytes: int = DEFAULT_SPLIT_BYTES) -> DataFrame:
    """Load a vector file (or a folder of them) as ``(id, v)``.

    ``kind``: ``fvecs`` (alias ``sift``), ``idx`` (alias ``mnist``), ``text`` or ``parquet``.
    """
    register(spark)
    kind = KIND_ALIASES.get(kind.lower(), kind.lower())
    if kind == "parquet":
        from knnspark.sources.vectors import canonical
        return canonical(spark.read.parquet(path), "id", "v", ())
    reader = spark.read.format(FORMAT).option("kind", kind).option("splitBytes", str(split_bytes))
    if kind != "text":
        return reader.load(path)
    return _text_rows(spark, reader, path)


# Ranges whose line counts are summed in one window.
_RANGE_BLOCK = 4096


def _text_rows(spark: SparkSession, reader, path: str) -> DataFrame:
    """The rows of text files with ids by prefix sums over the ranges' line counts.

    The sums are made in blocks of ranges, then over the blocks, so no task orders all ranges; the driver gets
    a file whose header is wrong, if any."""
    at = scratch_path(spark, "text-ranges")
    kind = "range int, lines bigint, path string, n bigint, d int"
    reader.option("countLines", "true").load(path).write.parquet(at)
    counts = spark.read.schema(kind).parquet(at).withColumn("block", (F.col("range") / _RANGE_BLOCK).cast("int"))
    files = counts.groupBy("path").agg(F.sum("lines").alias("held"), F.max("n").alias("n"), F.max("d").alias("dim"))
    wrong = files.where("held <> n").first()
    if wrong is not None:
        raise ValueError(f"{wrong['path']}: its header declares {wrong['n']} rows; it holds {wrong['held']}")
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    in_block = F.coalesce(F.sum("lines").over(before(Window.partitionBy("block").orderBy("range"))), F.lit(0))
    blocks = counts.groupBy("block").agg(F.sum("lines").alias("lines"))
    of_blocks = blocks.select("block", F.coalesce(F.sum("lines").over(before(Window.orderBy("block"))), F.lit(0)).alias("start"))
    first = (counts.select("range", "path", "block", in_block.alias("inside")).join(of_blocks, "block").join(files.select("path", "dim"), "path")
             .select("range", (F.col("start") + F.col("inside")).alias("first"), "dim", "path"))
    first_at = scratch_path(spark, "text-first-ids")
    first.write.parquet(first_at)  # written, so that Spark broadcasts it if it is small and joins it otherwise
    first = spark.read.schema("range int, first bigint, dim int, path string").parquet(first_at)
    rows = reader.option("countLines", "false").load(path).join(first, "range")
    odd = F.raise_error(F.format_string("%s: a row of %d numbers; its header says %d", "path", F.size("v"), "dim"))
    return rows.select((F.col("first") + F.col("pos")).alias("id"), F.when(F.size("v") != F.col("dim"), odd).otherwise(F.col("v")).alias("v"))


def write_vectors(df: DataFrame, path: str, kind: str, partitions: int | None = None,
                  rows: int = 0, cols: int = 0) -> None:
    """Export ``(id, v)`` so that file positions equal ``id`` (ids dense from 0, range-partitioned)."""
    register(df.sparkSession)
    n = partitions or df.sparkSession.sparkContext.defaultParallelism
    ordered = df.select("id", "v").repartitionByRange(n, "id").sortWithinPartitions("id")
    (ordered.write.format(FORMAT).option("kind", kind).option("rows", str(rows)).option("cols", str(cols))
     .mode("overwrite").save(path))
