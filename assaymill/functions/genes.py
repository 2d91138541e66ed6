"""Gene naming: aliases, Ensembl and Entrez ids to panel symbols."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from assaymill import dims


def literal_map(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def strip(c: Column) -> Column:
    """Remove any white space at both ends."""
    return F.btrim(c, F.lit(" \t\n\r\f\v"))


def resolve_alias(name: Column) -> Column:
    """Canonical symbol of a gene name: Ensembl (version dropped), Entrez digits, `_chrN` suffix, alias."""
    upper = F.upper(strip(name))
    bare = F.when(upper.startswith("ENSG"), F.substring_index(upper, ".", 1)).otherwise(upper)
    plain = F.when(bare.contains("_CHR"), F.regexp_replace(bare, r"_CHR\w*$", "")).otherwise(bare)
    return F.coalesce(
        F.when(upper.startswith("ENSG"), F.try_element_at(literal_map(dims.ENSEMBL_TO_SYMBOL), bare)),
        F.when(upper.between("0", "9z"), F.try_element_at(literal_map(dims.ENTREZ_TO_SYMBOL), bare)),
        F.try_element_at(literal_map(dims.GENE_ALIASES), plain),
        plain,
    )


def lookup_key(name: Column) -> Column:
    """Key of a name in `lookup_rows`; names with a `_chrN` suffix only match symbols and aliases."""
    upper = F.upper(strip(name))
    bare = F.when(upper.startswith("ENSG"), F.substring_index(upper, ".", 1)).otherwise(upper)
    return F.when(bare.contains("_CHR"), F.concat(F.lit("_CHR:"), F.regexp_replace(bare, r"_CHR\w*$", ""))).otherwise(bare)


def lookup_rows() -> list[tuple[str, str]]:
    """(key, symbol) of every spelling that means a panel gene."""
    names = {g: g for g in dims.PANEL}
    names.update({a: s for a, s in dims.GENE_ALIASES.items() if s in names})
    rows = list(names.items()) + [(f"_CHR:{n}", s) for n, s in names.items()]
    return rows + list(dims.ENSEMBL_TO_SYMBOL.items()) + list(dims.ENTREZ_TO_SYMBOL.items())


def in_panel(symbol: Column) -> Column:
    """True for canonical panel symbols."""
    return symbol.isin(dims.PANEL)


def is_target_gene(name: Column) -> Column:
    """Whether a name means a panel gene: one hash-set test on its key, which for most names is the name in upper case."""
    return _means_target(F.upper(strip(name)))


def any_target_gene(names: Column) -> Column:
    """Whether some name of an array means a panel gene."""
    return F.exists(F.transform(names, lambda n: F.upper(strip(n))), lambda u: F.coalesce(_means_target(u), F.lit(False)))


def _means_target(upper: Column) -> Column:
    keys = [k for k, _ in lookup_rows()]
    return F.when(upper.startswith("ENSG") | upper.contains("_CHR"), lookup_key(upper).isin(keys)).otherwise(upper.isin(keys))


def category(symbol: Column) -> Column:
    return F.coalesce(F.try_element_at(literal_map(dims.GENE_CATEGORY), symbol), F.lit("unknown"))


def expected_direction(symbol: Column) -> Column:
    return F.coalesce(F.try_element_at(literal_map(dims.EXPECTED_DIRECTION), symbol), F.lit("up"))
