"""Accession numbers in text: finding, context, confidence, repository and file kinds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from assaymill import dims
from assaymill.functions.genes import literal_map

# Accession spelling and the words that tell whose data it is.
ACCESSION = r"\b(GSE\d{4,8}|GSM\d{4,8}|GDS\d{3,6}|E-[A-Z]{4}-\d+)\b"
OWN_DATA_WORDS = (
    r"(?i)deposited\s+in|uploaded\s+to|submitted\s+to|available\s+(at|from|in|under)|data\s+availability|"
    r"accession\s+(number|code|id)|gene\s+expression\s+omnibus|GEO\s+database|ArrayExpress"
)
REFERENCED_WORDS = (
    r"(?i)reanalyz|downloaded\s+from|previously\s+published|obtained\s+from|"
    r"publicly\s+available\s+data|retrieved\s+from"
)
AVAILABILITY_TITLES = r"(?i)data availability|data access|accession|data deposition"

# File names of count tables and of files never tried.
COUNT_FILE = (
    r"(?i)(count|tpm|fpkm|rpkm|expression|quant|processed|feature[_\s]?count|read[_\s]?count|norm|deseq|"
    r"htseq|rsem|salmon|kallisto|star)"
)
SKIP_FILE = (
    r"(?i)(_RAW\.tar|\.fastq|\.bam|\.bed|peak|\.wig|bigwig|narrowpeak|broadpeak|\.cel|\.idat|\.sdf|"
    r"filelist|readme|md5)"
)
TABULAR_FILE = r"(?i)(\.(txt|csv|tsv)(\.gz)?|\.xlsx?)$"
PACKED_TABULAR_FILE = r"(?i)\.(txt|csv|tsv)\.gz$"
MATRIX_SUFFIX = r"(\.(txt|csv|tsv)\.gz|\.xlsx|\.csv|\.txt)$"
MATRIX_WORD = r"(count|expression|matrix|tpm|fpkm|rpkm|normalized|raw_count|gene|rna|deg|deseq|edger)"


def find_all(text: Column) -> Column:
    """Distinct accessions in order of first occurrence."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(ACCESSION), F.lit(1)))


def snippet(text: Column, accession: Column, width: int = 100) -> Column:
    """Text around the first whole-word hit, `width` characters on each side."""
    pattern = F.concat(F.lit(r"\b"), accession, F.lit(r"\b"))
    at = F.regexp_instr(text, pattern)
    start = F.greatest(F.lit(1), at - width)
    return F.trim(F.substring(text, start, at + F.length(accession) + width - start))


def context_from_words(text: Column) -> Column:
    return (F.when(text.rlike(OWN_DATA_WORDS), "own_data")
            .when(text.rlike(REFERENCED_WORDS), "referenced").otherwise("ambiguous"))


def context_rank(context: Column) -> Column:
    return F.coalesce(F.try_element_at(literal_map(dims.CONTEXT_RANK), context), F.lit(0))


def hit_confidence(context: Column, n_sources: Column, validated: Column) -> Column:
    """Score of a hit in hundredths added up, so that no binary rounding shows: context, agreement, validation."""
    base = F.when(context == "own_data", 80).when(context == "referenced", 60).otherwise(50)
    total = base + F.when(n_sources >= 2, 10).otherwise(0) + F.when(validated, 5).otherwise(0)
    return F.least(total, F.lit(100)) / F.lit(100.0)


def guess_repository(accession: Column) -> Column:
    acc = F.upper(accession)
    return (
        F.when(acc.rlike("^(GSE|GSM)"), "GEO")
        .when(acc.rlike("^(PRJNA|SRP)"), "SRA")
        .when(acc.rlike("^(PRJEB|ERP)"), "ENA")
        .when(acc.startswith("E-"), "ArrayExpress")
        .when(acc.startswith("DRA"), "DDBJ")
        .otherwise("unknown")
    )


def library_data_type(strategies: Column) -> Column:
    """Data type of a set of library strategies."""
    low = F.transform(strategies, F.lower)

    def has(*names):
        return F.arrays_overlap(low, F.array(*[F.lit(n) for n in names]))

    return (
        F.when(has("rna-seq", "rna_seq"), "bulk_rnaseq")
        .when(F.exists(low, lambda s: s.rlike("10x|chromium")), "scrna_seq")
        .when(has("microarray", "other"), "microarray")
        .when(has("atac-seq"), "atac_seq")
        .when(has("chip-seq"), "chip_seq")
        .otherwise("unknown")
    )


def file_name(url: Column) -> Column:
    return F.substring_index(url, "/", -1)


def file_type(name: Column) -> Column:
    low = F.lower(name)
    return (
        F.when(low.rlike(r"\.tar(\.gz)?$"), "archive")
        .when(low.rlike(r"\.(txt|tsv)(\.gz)?$"), "text_table")
        .when(low.rlike(r"\.csv(\.gz)?$"), "csv")
        .when(low.rlike(r"\.xlsx?$"), "excel")
        .when(low.rlike(r"\.cel(\.gz)?$"), "microarray_raw")
        .otherwise("unknown")
    )


def has_count_matrix(name: Column) -> Column:
    low = F.lower(name)
    return low.rlike(MATRIX_SUFFIX) & low.rlike(MATRIX_WORD)
