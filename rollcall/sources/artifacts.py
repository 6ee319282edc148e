"""Readers for collected artifacts and checks on artifact files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.constants import CONTENT_TYPE_WORDS, METHOD_FOLDERS, ZIP_FILE_TYPES
from rollcall.functions.text import contains_any
from rollcall.functions.variants import kind, parse_whole
from rollcall.operators.dedup import last_wins
from rollcall.schemas import ARTIFACTS, MAP_ARTIFACTS
from rollcall.sources.elements import elements

TENANT_OF_PATH = r"([^/]+)/[^/]+$"


def path_exists(spark: SparkSession, pattern: str) -> bool:
    """True when the glob matches anything, on whatever file system it names."""
    try:
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(pattern).schema
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def _tenant(path: str = "_metadata.file_path") -> Column:
    return F.url_decode(F.regexp_extract(F.col(path), TENANT_OF_PATH, 1))


def _files(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    pattern = f"{root}/*/{name}.json"
    if not path_exists(spark, pattern):
        return None
    return spark.read.text(pattern, wholetext=True).select(
        _tenant().alias("tenant"), "value",
        parse_whole(F.col("value")).alias("doc"),
    )


def read_array(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``root/<tenant>/<name>.json`` for all tenants: one row per array element, with its place.

    A missing file gives no rows, and so does a file that is not a JSON array.
    """
    ddl = ARTIFACTS[name]
    files = _files(spark, root, name)
    if files is None:
        return spark.createDataFrame([], f"tenant string, seq bigint, {ddl}")
    items = F.from_json("value", T.ArrayType(T._parse_datatype_string(ddl)))
    return (
        files.where(kind(F.col("doc")) == "ARRAY")
        .select("tenant", F.posexplode(items).alias("seq", "item"))
        .select("tenant", F.col("seq").cast("bigint").alias("seq"), "item.*")
    )


def read_rows(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The same observations as JSON Lines below ``root/<tenant>/<name>.jsonl``.

    Each line carries its own ``seq``, so files of any size are split over tasks; the form to use
    when one tenant holds a large part of the data.
    """
    pattern = f"{root}/*/{name}.jsonl"
    schema = f"seq bigint, {ARTIFACTS[name]}"
    if not path_exists(spark, pattern):
        return spark.createDataFrame([], f"tenant string, {schema}")
    return spark.read.schema(schema).json(pattern).select(_tenant().alias("tenant"), "*")


def read_map(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``root/<tenant>/<name>.json`` holding one object: one row per key."""
    ddl = MAP_ARTIFACTS[name]
    files = _files(spark, root, name)
    if files is None:
        return spark.createDataFrame([], f"tenant string, domain string, value {ddl}")
    return files.where(kind(F.col("doc")) == "OBJECT").select(
        "tenant", F.explode(F.from_json("value", f"map<string,{ddl}>")).alias("domain", "value")
    )


def scan_array(spark: SparkSession, root: str, name: str) -> DataFrame:
    """:func:`read_array` for files of any size: one file is read by as many tasks as it has splits."""
    ddl, pattern = ARTIFACTS[name], f"{root}/*/{name}.json"
    if not path_exists(spark, pattern):
        return spark.createDataFrame([], f"tenant string, seq bigint, {ddl}")
    return elements(spark, pattern, "[").select(
        _tenant("file").alias("tenant"), "seq",
        F.from_json("text", T._parse_datatype_string(f"struct<{ddl}>")).alias("item")).select(
        "tenant", "seq", "item.*")


def scan_map(spark: SparkSession, root: str, name: str) -> DataFrame:
    """:func:`read_map` for files of any size; of a key given twice the last value counts."""
    ddl, pattern = MAP_ARTIFACTS[name], f"{root}/*/{name}.json"
    if not path_exists(spark, pattern):
        return spark.createDataFrame([], f"tenant string, domain string, value {ddl}")
    entries = elements(spark, pattern, "{").select(
        _tenant("file").alias("tenant"), "seq",
        F.explode(F.from_json("text", f"map<string,{ddl}>")).alias("domain", "value"))
    return last_wins(entries, ["tenant", "domain"], "seq").drop("seq")


def document_path(tenant: Column, method: Column, source_domain: Column, filename: Column) -> Column:
    """Where a document of a known discovery method lies; null for an unknown method."""
    folder = None
    for name, place in METHOD_FOLDERS.items():
        folder = (F if folder is None else folder).when(method == name, F.lit(place))
    return F.when(
        folder.isNotNull(),
        F.concat_ws("/", tenant, folder, F.coalesce(source_domain, F.lit("")), filename),
    )


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Relative paths and sizes below ``root``; contents are never read for a listing."""
    base = root.rstrip("/") + "/"
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(root)
        .select(
            F.element_at(F.split(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))),
                                 "\\Q" + base + "\\E"), -1).alias("filepath"),
            "length",
        )
    )


def attach_file_exists(documents: DataFrame, listing: DataFrame) -> DataFrame:
    """``file_exists`` by a left join of resolved paths to a listing of paths."""
    present = listing.select("filepath").distinct().withColumn("file_exists", F.lit(True))
    return documents.join(present, "filepath", "left").withColumn(
        "file_exists", F.coalesce("file_exists", F.lit(False))
    )


def signature_ok(content: Column, extension: Column, content_type: Column) -> Column:
    """First bytes fit the extension, or the declared content type names a document."""
    head = F.substring(content, 1, 4)
    ext = F.lower(extension)
    declared = F.coalesce(contains_any(F.lower(content_type), CONTENT_TYPE_WORDS), F.lit(False))
    by_bytes = ((ext == "pdf") & (F.hex(head) == "25504446")) | (
        ext.isin(*ZIP_FILE_TYPES) & (F.hex(F.substring(content, 1, 2)) == "504B")
    )
    return F.coalesce(by_bytes, F.lit(False)) | declared


def latest_artifact(files: DataFrame, tenant: str, name: str, prefix: str = "report_",
                    suffix: str = ".docx") -> DataFrame:
    """Per tenant, the name ``<prefix><tenant>_<date><suffix>`` with the greatest date text."""
    head = F.concat(F.lit(prefix), F.col(tenant), F.lit("_"))
    middle = F.substr(F.col(name), F.length(head) + 1,
                      F.length(name) - F.length(head) - len(suffix))
    dated = files.withColumn("report_date", middle).where(
        F.startswith(F.col(name), head)
        & F.col(name).endswith(suffix)
        & F.regexp_like("report_date", F.lit(r"^\d{4}-\d{2}-\d{2}$"))
    )
    return dated.groupBy(tenant).agg(
        F.max("report_date").alias("report_date"),
        F.max_by(name, "report_date").alias(name),
    )
