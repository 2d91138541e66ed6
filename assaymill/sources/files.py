"""Files on storage: listings, whole-file texts, archive members, sharded folders."""

from __future__ import annotations

import io
import tarfile
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The kinds each reader takes.
TEXT_KINDS = ["csv", "tsv", "txt"]
OFFICE_KINDS = ["docx", "pptx", "xlsx", "xls", "doc", "ppt"]
EXPRESSION_KINDS = ["xlsx", "xls", "csv", "tsv", "txt"]


def listing(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, name, extension, length) of the files below a folder; contents are not read."""
    f = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
         .load(folder).select("path", "length"))
    name = F.substring_index("path", "/", -1)
    return f.select("path", name.alias("name"), extension(name).alias("extension"), "length")


def extension(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"[^.]\.([^.]*)$", 1))


def _within(size: str, max_bytes: int | None) -> Column:
    return F.lit(True) if max_bytes is None else F.col(size) <= max_bytes


def usable(files: DataFrame, kinds: list[str], max_bytes: int | None = None) -> DataFrame:
    """Files of the given kinds, not hidden; up to a size where one is given."""
    return files.where(F.col("extension").isin(kinds) & ~F.col("name").startswith(".") & _within("length", max_bytes))


def expression_files(files: DataFrame) -> DataFrame:
    return usable(files, EXPRESSION_KINDS)


def texts(spark: SparkSession, folder: str, pattern: str = "*", max_bytes: int | None = None) -> DataFrame:
    """(path, content) of whole text files; gzip is read through. Files above `max_bytes` are left out where that is given."""
    return (spark.read.format("text").option("wholetext", True).option("recursiveFileLookup", True)
            .option("pathGlobFilter", pattern).load(folder)
            .where(_within("_metadata.file_size", max_bytes))
            .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content")))


def lines(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, pos, line) of text files. A large file is read by many tasks; `pos` orders the lines of a file within one scan.

    Splits depend on the cluster at the time of a scan, so positions of two scans must not be compared: cut what is kept of a scan.
    """
    at = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    return (spark.read.format("text").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
            .select(F.col("_metadata.file_path").alias("path"), at.alias("pos"), F.col("value").alias("line")))


def split_lines(texts: DataFrame, key: str = "path", content: str = "content") -> DataFrame:
    """(key, pos, line) of texts that are held in rows, such as archive members."""
    return texts.select(key, F.posexplode(F.split(content, r"\r?\n")).alias("_n", "line")).select(
        key, F.struct(F.lit(0).cast("bigint").alias("block"), F.col("_n").cast("bigint").alias("at")).alias("pos"), "line")


def contents(spark: SparkSession, folder: str, pattern: str = "*", max_bytes: int | None = None) -> DataFrame:
    """(path, content) of binary files, up to a size where one is given."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
            .load(folder).where(_within("length", max_bytes)).select("path", "content"))


def _members(path: str, blob: bytes) -> list[tuple[str, bytes]]:
    """Members of one zip or tar; folders, resource forks and hidden files are skipped, a bad archive is empty."""
    try:
        if path.lower().endswith(".zip"):
            with zipfile.ZipFile(io.BytesIO(blob)) as z:
                found = [(i.filename, z.read(i)) for i in z.infolist() if not i.is_dir()]
        else:
            with tarfile.open(fileobj=io.BytesIO(blob)) as t:
                found = [(m.name, t.extractfile(m).read()) for m in t.getmembers() if m.isfile()]
    except (zipfile.BadZipFile, tarfile.TarError, OSError):
        return []
    return [(n, b) for n, b in found
            if "/__MACOSX" not in n and not n.startswith("__MACOSX") and not n.rsplit("/", 1)[-1].startswith(".")]


def archive_members(archives: DataFrame) -> DataFrame:
    """(path, member, name, content), one row per member of the archives `(path, content)`."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, blob in zip(b["path"], b["content"]):
                got = _members(path, blob)
                if got:
                    yield pd.DataFrame({"path": path, "member": [n for n, _ in got],
                                        "name": [n.rsplit("/", 1)[-1] for n, _ in got],
                                        "content": [c for _, c in got]})
    return archives.select("path", "content").mapInPandas(
        run, "path string, member string, name string, content binary")


# Name parts and kinds of package members taken although the article does not name them.
SUPPLEMENT_NAME = r"(?i)moesm|supp|table_s|figure_s|additional|appendix"
WANTED_KINDS = ["pdf", "docx", "doc", "xlsx", "xls", "csv", "tsv", "txt", "rtf"]


def supplement_members(members: DataFrame, manifest: DataFrame) -> DataFrame:
    """Package members `(pmc_id, name, …)` an article names `(pmc_id, filename)`, or that look like supplements."""
    named = manifest.select("pmc_id", F.col("filename").alias("name"), F.lit(True).alias("_named")).distinct()
    j = members.join(named, ["pmc_id", "name"], "left")
    looks = (extension(F.col("name")).isin(WANTED_KINDS) & F.col("name").rlike(SUPPLEMENT_NAME)
             & ~F.col("name").contains("Article"))
    return j.where(F.coalesce("_named", F.lit(False)) | looks).drop("_named")


def supplement_folder(pmc_id: Column, root: str = "data/db") -> Column:
    tag = F.when(pmc_id.startswith("PMC"), pmc_id).otherwise(F.concat(F.lit("PMC"), pmc_id))
    return F.concat_ws("/", F.lit(root), F.left(tag, F.lit(5)), F.concat(tag, F.lit("_supp")))
