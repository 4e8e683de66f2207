"""JSON sources and sinks of the harvest: discovery envelopes and one metadata object per file."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.operators.manifest import last_wins, record_key
from lavra.schemas import ENVELOPE, RECORD

# Bounds of a batch of files on its way from Arrow to Spark: so many, or so many bytes.
BATCH_FILES, BATCH_BYTES = 2000, 1 << 24
# Longest name that a file has by its record's id.
NAME = 200


def envelope(source: Column, query: Column, search_type: Column, collected_at: Column, urls: Column) -> Column:
    """The discovery envelope as JSON text."""
    return F.to_json(F.struct(source.alias("source"), query.alias("query"), search_type.alias("search_type"), collected_at.alias("collected_at"), F.size(urls).alias("total_collected"), urls.alias("record_urls")), {"ignoreNullFields": "false"})


def urls_of_envelope(text: Column) -> Column:
    """The addresses of an envelope or of a bare list; an object without ``record_urls`` gives none.

    An object whose ``record_urls`` is null or no list, other JSON, and text that is no JSON are errors.
    """
    v = F.try_parse_json(text)
    inner = F.variant_get(v, "$.record_urls", "variant")
    kind = lambda x: F.schema_of_variant(x)
    return (
        F.when(kind(v).startswith("ARRAY"), v.try_cast("array<string>"))
        .when(kind(v).startswith("OBJECT") & inner.isNull(), F.array().cast("array<string>"))
        .when(kind(v).startswith("OBJECT") & kind(inner).startswith("ARRAY"), inner.try_cast("array<string>"))
        .otherwise(F.raise_error(F.lit("no list of addresses")).cast("array<string>"))
    )


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """(file, pos, url) of discovery files, whole files, envelopes and bare lists alike."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    return files.select("file", F.posexplode(urls_of_envelope(F.col("value"))).alias("pos", "url"))


def write_envelopes(envelopes: DataFrame, path: str, apart: bool = False) -> None:
    """Overwrites ``path`` through Spark's commit protocol: one object a line, or (``apart``) one a file."""
    out = envelopes.select(*[f.name for f in ENVELOPE.fields]).write.mode("overwrite").option("ignoreNullFields", "false")
    (out.option("maxRecordsPerFile", 1) if apart else out).json(path)


def metadata_files(spark: SparkSession, path: str) -> DataFrame:
    """(file) of the ``*.json`` in a folder, in order of their paths; contents aren't read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(path).select(F.col("path").alias("file")).orderBy("file")


def _bases(spark: SparkSession, path: str, there: bool) -> list[tuple[str, str]]:
    """(name, address) of what ``path`` means to Spark, which may hold globs where it must be there already."""
    name = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at = name.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [x.getPath() for x in at.globStatus(name) or []] if there else [at.makeQualified(name)]
    if not found:
        raise AnalysisException(f"[PATH_NOT_FOUND] Path does not exist: {path}.")
    return [(x.toString(), x.toUri().toString()) for x in found]


def _listed(at: fs.FileSystem, name: str, inside: str) -> Iterator[tuple[str, str, bool]]:
    """(name, path, folder) of the metadata files and ``key=value`` folders in a folder, without those that Spark hides."""
    for x in at.get_file_info(fs.FileSelector(inside)):
        if x.base_name.startswith(".") or (x.base_name.startswith("_") and "=" not in x.base_name):
            continue
        folder = x.type == fs.FileType.Directory
        if "=" in x.base_name if folder else x.base_name.endswith(".json") and x.size != 0:
            yield f"{name}/{x.base_name}", x.path, folder


def _walked(at: fs.FileSystem, name: str, path: str, folder: bool) -> Iterator[tuple[str, str]]:
    """(name, path) of a file, or of all files in a folder."""
    if not folder:
        yield name, path
        return
    for x in _listed(at, name, path):
        yield from _walked(at, *x)


def _texts(spark: SparkSession, path: str) -> DataFrame:
    """(file, text, is_object) of the ``*.json`` of a folder."""
    files = _contents(spark, path).select("file", F.decode("content", "UTF-8").alias("text"))
    return files.withColumn("is_object", F.coalesce(F.schema_of_variant(F.try_parse_json("text")).startswith("OBJECT"), F.lit(False)))


def _contents(spark: SparkSession, path: str) -> DataFrame:
    """(file, content) of the ``*.json`` of a folder. One task lists the folder itself; its files, or the folders in it, are spread over all."""
    bases = _bases(spark, path, there=True)
    address = bases[0][1]

    def top(_: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, base in bases:
            at, inside = fs.FileSystem.from_uri(base)
            x = at.get_file_info(inside)
            rows = list(_listed(at, name, inside)) if x.type == fs.FileType.Directory else [(name, inside, False)] * (name.endswith(".json") and x.size != 0)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.bool_()))], ["file", "at", "folder"])

    def opened(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = fs.FileSystem.from_uri(address)[0]
        names, contents, n = [], [], 0
        batch = lambda: pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(contents, pa.binary())], ["file", "content"])
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                for name, file in _walked(at, *row):
                    with at.open_input_stream(file) as f:
                        contents.append(f.read())
                    names.append(name)
                    n += len(contents[-1])
                    if len(names) >= BATCH_FILES or n >= BATCH_BYTES:
                        yield batch()
                        names, contents, n = [], [], 0
        if names:
            yield batch()

    over = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return spark.range(0, 1, 1, 1).mapInArrow(top, "file string, at string, folder boolean").repartition(over).mapInArrow(opened, "file string, content binary")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, text, record) of a folder with one metadata object a file; ``record`` is null where the file holds no object.

    Folders ``key=value`` in it belong to it, as in Spark's listings; files without a byte give no row. Tasks list and
    open the files through Arrow: Spark's own reader lists all on the driver and makes a task of some thirty files.
    A record without an id takes its file's stem; polymorphic ``access_url`` stays text (see ``split_access_urls``).
    """
    files = _texts(spark, path).withColumn("record", F.when(F.col("is_object"), F.from_json("text", RECORD)))
    return files.select("file", "text", F.when(F.col("record").isNotNull(), F.col("record").withField("record_id", record_key(F.col("record")["record_id"], F.col("file")))).alias("record"))


def read_records(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(the records with their ``file``, the files that hold no object as (file, text)), both of one reading.

    Files are told apart before their fields are read: a condition on ``record`` would be moved below it and read the
    text once for each field.
    """
    files = _texts(spark, path)
    records = files.where("is_object").select("file", F.from_json("text", RECORD).alias("r"))
    own = record_key(F.col("r.record_id"), F.col("file")).alias("record_id")
    return records.select(*[own if n == "record_id" else f"r.{n}" for n in RECORD.fieldNames()], "file"), files.where("NOT is_object").select("file", "text")


def file_stem(record_id: Column) -> Column:
    """The name of a record's file: its id with signs that names can't hold escaped; a digest where that is too long."""
    plain = F.regexp_replace(F.regexp_replace(F.url_encode(record_id), r"^\.", "%2E"), "^_", "%5F")
    digest = F.concat(F.lit("%-"), F.sha2(record_id.cast("binary"), 256))
    return F.when(record_id.isNull(), "%null").when(F.is_valid_utf8(record_id) & F.length(plain).between(1, NAME), plain).otherwise(digest)


def write_apart(files: DataFrame, path: str) -> None:
    """Writes (stem, text) as ``<stem>.json``, each task's in a folder ``part=<number>`` of ``path``; stems are distinct.

    Overwrites: tasks write beside ``path``, which is exchanged when all have ended. Tasks may run twice: each fills a
    folder of its own and moves it as a whole, and the first that ends counts. Spark's writer opens, sums and names each
    file by itself, which takes milliseconds a file. The folder is shared by driver and executors.
    """
    (_, address), *_ = _bases(files.sparkSession, path, there=False)
    at, base = fs.FileSystem.from_uri(address)
    beside = f".{uuid.uuid4().hex}.part"
    whole = f"{base.rstrip('/').rpartition('/')[0]}/{beside}"

    def part(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own, n = fs.FileSystem.from_uri(address)[0], f"{whole}/.{uuid.uuid4().hex}", 0
        target = f"{whole}/part={TaskContext.get().partitionId():05d}"
        try:
            for b in batches:
                if not n and b.num_rows:
                    at.create_dir(own)
                for stem, text in zip(*(c.to_pylist() for c in b.columns)):
                    with at.open_output_stream(f"{own}/{stem}.json") as f:
                        f.write(text)
                n += b.num_rows
            if n and at.get_file_info(target).type == fs.FileType.NotFound:
                at.move(own, target)
        finally:
            if at.get_file_info(own).type == fs.FileType.Directory:
                at.delete_dir(own)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    try:
        at.create_dir(whole, recursive=True)
        files.select("stem", F.col("text").cast("binary")).mapInArrow(part, "n bigint").write.format("noop").mode("overwrite").save()
        at.open_output_stream(f"{whole}/_SUCCESS").close()
        if (there := at.get_file_info(base).type) != fs.FileType.NotFound:
            (at.delete_dir if there == fs.FileType.Directory else at.delete_file)(base)
        at.move(whole, base)
    finally:
        if at.get_file_info(whole).type == fs.FileType.Directory:
            at.delete_dir(whole)


def write_records(records: DataFrame, path: str, order: list[str], apart: bool = False) -> None:
    """One object a line, or (``apart``) a file, of each record, the last in ``order`` for an id that comes again; overwrites."""
    out = last_wins(records, "record_id", order).select(*RECORD.fieldNames())
    if apart:
        write_apart(out.select(file_stem(F.col("record_id")).alias("stem"), F.concat(F.to_json(F.struct(*RECORD.fieldNames()), {"ignoreNullFields": "false"}), F.lit("\n")).alias("text")), path)
    else:
        out.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
