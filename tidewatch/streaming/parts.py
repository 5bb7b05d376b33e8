"""Tables that grow by one part for each micro-batch, kept to few files.

A part lies below ``batch=<number>``. Every ``FAN`` committed parts are put together into one, every ``FAN`` of those
into a larger one and so on: n batches leave at most ``FAN - 1`` parts of each of log(n) sizes, and a row is written
anew log(n) times. The newest manifest, a small file that is written aside and then renamed, says which larger parts
there are and up to which batch they go; parts of later batches follow by their numbers. Readers take one manifest and
so see one snapshot. What it replaces is deleted when the next one is written, so that who has just read the old one can
still finish. If compaction breaks off at any point the table stays as it was, and the next one starts from there.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StructField, StructType

FAN = 16
#: Bytes of a file of a larger part, about.
FILE_BYTES = 128 << 20


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def read_json(spark: SparkSession, path: str):
    files, at = file_system(spark, path)
    stream = files.open(at)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_json(spark: SparkSession, path: str, value) -> None:
    """Written aside and moved, so that no half of it is ever read."""
    files, at = file_system(spark, path)
    aside = at.suffix(".new")
    stream = files.create(aside, True)
    stream.write(json.dumps(value).encode())
    stream.close()
    files.delete(at, False)
    files.rename(aside, at)


def _names(spark: SparkSession, folder: str) -> list[str]:
    files, at = file_system(spark, folder)
    return [status.getPath().getName() for status in files.listStatus(at)] if files.exists(at) else []


def _manifest(spark: SparkSession, table: str) -> tuple[int, dict]:
    """The newest manifest and its number, -1 before the first."""
    numbers = [int(n.removesuffix(".json")) for n in _names(spark, f"{table}/_manifest") if n.endswith(".json")]
    if not numbers:
        return -1, {"parts": [], "gone": []}
    return max(numbers), read_json(spark, f"{table}/_manifest/{max(numbers)}.json")


def _single_parts(spark: SparkSession, table: str, after: int) -> list[int]:
    """Numbers of the batches after `after` whose parts have been written to their end."""
    numbers = [int(n.removeprefix("batch=")) for n in _names(spark, table) if n.startswith("batch=")]
    return [k for k in sorted(numbers) if k > after and (names := _names(spark, f"{table}/batch={k}")) and "_temporary" not in names]


def _with_batch(schema: StructType) -> StructType:
    return StructType([*[f for f in schema.fields if f.name != "batch"], StructField("batch", LongType())])


def _read(spark: SparkSession, table: str, schema: StructType, folders: list[str]) -> DataFrame:
    full = _with_batch(schema)
    frames = []
    for group in ([f for f in folders if f.startswith("batch=")], [f for f in folders if not f.startswith("batch=")]):
        if group:
            at = spark.read.schema(full).option("basePath", table) if group[0].startswith("batch=") else spark.read.schema(full)
            frames.append(at.parquet(*[f"{table}/{f}" for f in group]).select(*full.names))
    if not frames:
        return spark.createDataFrame([], full)
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])


def read(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    """All rows of one snapshot with the number of their ``batch``; a table that nothing was written to is empty."""
    parts = _manifest(spark, table)[1]["parts"]
    last = max((p["last"] for p in parts), default=-1)
    return _read(spark, table, schema, [*[p["folder"] for p in parts], *[f"batch={k}" for k in _single_parts(spark, table, last)]])


def _fan(parts: list[dict], fan: int) -> slice | None:
    """The first `fan` neighbours of one size."""
    for i in range(len(parts) - fan + 1):
        if len({p["size"] for p in parts[i:i + fan]}) == 1:
            return slice(i, i + fan)
    return None


def compact(spark: SparkSession, table: str, schema: StructType, before: int, fan: int | None = None) -> None:
    """Puts together what is due of the parts of batches below `before`, which must be committed and never run again."""
    number, manifest = _manifest(spark, table)
    old = list(manifest["parts"])
    last = max((p["last"] for p in old), default=-1)
    parts = old + [{"folder": f"batch={k}", "last": k, "size": 0} for k in _single_parts(spark, table, last) if k < before]
    files, _ = file_system(spark, table)
    gone = []
    while due := _fan(parts, fan or FAN):
        some = parts[due]
        folder = f"merged/{uuid.uuid4().hex}"
        sizes = [files.getContentSummary(file_system(spark, f"{table}/{p['folder']}")[1]).getLength() for p in some]
        rows = _read(spark, table, schema, [p["folder"] for p in some])
        rows.coalesce(1 + sum(sizes) // FILE_BYTES).write.parquet(f"{table}/{folder}")
        parts[due] = [{"folder": folder, "last": some[-1]["last"], "size": some[0]["size"] + 1}]
        gone += [p["folder"] for p in some]
    if not gone:
        return
    # Parts of one batch stay out of the manifest: they are found by their numbers.
    larger = [p for p in parts if p["size"]]
    write_json(spark, f"{table}/_manifest/{number + 1}.json", {"parts": larger, "gone": gone})
    # What the manifest before replaced, and what broke off before it got into one.
    kept = {p["folder"] for p in [*larger, *old]} | set(gone)
    left = [f for f in manifest["gone"] if f not in kept] + [f for n in _names(spark, f"{table}/merged") if (f := f"merged/{n}") not in kept]
    for f in dict.fromkeys(left):
        files.delete(file_system(spark, f"{table}/{f}")[1], True)
    if number > 0:
        files.delete(file_system(spark, f"{table}/_manifest/{number - 1}.json")[1], False)
