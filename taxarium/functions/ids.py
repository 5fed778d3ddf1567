"""Identifier algebra: pure Column to Column expressions, used as join keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_id(c: Column) -> Column:
    """User ids (U…) stay; else drop RS_/GB_, turn GCA_/GCF_ into G and cut the version."""
    bare = F.regexp_replace(F.regexp_replace(c, "^(RS_|GB_)", ""), "GC[AF]_", "G")
    return F.when(c.startswith("U"), c).otherwise(F.substring_index(bare, ".", 1))


def source_prefixed(c: Column) -> Column:
    return F.when(c.startswith("GCA_"), F.concat(F.lit("GB_"), c)).when(c.startswith("GCF_"), F.concat(F.lit("RS_"), c)).otherwise(c)


def database_key(c: Column) -> Column:
    """Text behind the first underscore of a source-prefixed id."""
    return F.when(c.rlike("^(RS_|GB_)"), F.substring(c, F.lit(4), F.length(c))).otherwise(c)


def formatted_accession(c: Column) -> Column:
    """G and the digits of a bare accession."""
    return F.concat(F.lit("G"), F.substring_index(F.substring(c, F.lit(5), F.length(c)), ".", 1))


def version_base(c: Column) -> Column:
    return F.regexp_replace(c, r"\.[^.]*$", "")


def version_number(c: Column) -> Column:
    return F.element_at(F.split(c, r"\."), -1).try_cast("int")


def is_user(c: Column) -> Column:
    return c.startswith("U_")


def wgs_id(c: Column) -> Column:
    """Letters up to the first digit and a two-digit version."""
    parts = lambda i: F.regexp_extract(c, r"^([^0-9]*)[0-9]*\.?([0-9]*)", i)
    return F.concat(parts(1), F.lpad(parts(2), 2, "0"))


def standard_strain(c: Column) -> Column:
    """Without ``strain`` and without characters other than letters and digits, in upper case."""
    return F.upper(F.regexp_replace(F.replace(c, F.lit("strain"), F.lit("")), r"[^\p{L}\p{N}]+", ""))


def canonical_strain(c: Column) -> Column:
    """Leading ``strain `` and parenthesised text go, then as standard_strain."""
    bare = F.regexp_replace(F.regexp_replace(c, "^strain ", ""), r"\(.+\)", " ")
    return F.upper(F.regexp_replace(bare, r"[^\p{L}\p{N}]+", ""))


def is_strain_id(c: Column) -> Column:
    """Has a digit, and either no blank or only digits and capitals once ``-``, ``.`` and blanks are gone."""
    return c.rlike("[0-9]") & (~c.contains(" ") | F.regexp_replace(c, "[-. ]", "").rlike("^[0-9A-Z]+$"))


def type_variants(ids: Column) -> Column:
    """Ids and, for those that end in T, the ids without it."""
    return F.array_sort(F.array_union(ids, F.transform(F.filter(ids, lambda x: x.endswith("T") & (F.length(x) > 1)), lambda x: F.substring(x, F.lit(1), F.length(x) - 1))))


def without_brackets(c: Column) -> Column:
    """A leading [genus] loses its brackets."""
    return F.when(c.startswith("["), F.regexp_replace(c, r"^\[([^\]]*)\]", "$1")).otherwise(c)


def last_gz_removed(c: Column) -> Column:
    return F.regexp_replace(c, r"\.gz(?!.*\.gz)", "")


def release_key(c: Column) -> Column:
    """Text in front of the version, whichever of the two archives holds it."""
    return F.regexp_replace(version_base(c), "^(RS_GCF|GB_GCA)", "archive")


def formatted_id(c: Column) -> Column:
    """G and the nine digits of an accession."""
    return F.concat(F.lit("G"), F.substring(c, 5, 9))


def split_strains(c: Column) -> Column:
    """Strain ids of one cell: co-identical ones in ``(=…)``, separated by ``;``, ``,`` or ``=``; of ids joined by ``/`` the whole and the parts."""
    bare = F.replace(c, F.lit("type strain:"), F.lit(""))
    bare = F.when(bare.contains("(=") & bare.contains(")"), F.replace(F.replace(bare, F.lit("(="), F.lit("=")), F.lit(")"), F.lit("="))).otherwise(bare)
    parts = F.when(bare.contains("/"), F.concat(F.array(bare), F.split(bare, "/"))).otherwise(F.array(bare))
    return F.flatten(F.transform(parts, lambda p: F.split(p, "[;,=]")))


def _renamed(c: Column, word: str) -> Column:
    """``A (now B) 1`` as A 1 and B 1; null without such a pattern."""
    pattern = rf"(?U)(\w+) \({word} (\w+)\) (\d+)"
    part = lambda i: F.regexp_extract(c, pattern, i)
    return F.when(c.rlike(pattern), F.array(F.concat_ws(" ", part(1), part(3)), F.concat_ws(" ", part(2), part(3))))


def renamed_collections(items: Column) -> Column:
    """Strain ids of a list, both names of renamed collections; other parenthesised text goes."""
    none = F.array().cast("array<string>")

    def variants(x: Column) -> Column:
        now, formerly = _renamed(x, "now"), _renamed(x, "formerly")
        plain = F.when(now.isNull() & formerly.isNull(), F.array(F.trim(F.regexp_replace(x, r"\([^)]*\)", ""))))
        return F.concat(*(F.coalesce(v, none) for v in (now, formerly, plain)))

    return F.flatten(F.transform(items, variants))


def strain_variants(items: Column) -> Column:
    """Sorted strain ids with all forms without blanks, without hyphens and with blanks for hyphens, renamed collections under both names."""
    none = F.array().cast("array<string>")
    out = F.flatten(F.transform(items, lambda x: F.concat(F.array(x), F.coalesce(_renamed(x, "now"), none))))
    for _ in range(3):  # each form of a form is reached after three steps
        out = F.array_distinct(F.flatten(F.transform(out, lambda x: F.array(x, F.replace(x, F.lit(" "), F.lit("")), F.replace(x, F.lit("-"), F.lit("")), F.replace(x, F.lit("-"), F.lit(" "))))))
    return F.array_sort(out)


def three_term_strain(c: Column) -> Column:
    """Three words, numbers and capitals, at least one of each."""
    words = F.split(c, " ")
    number, word = (lambda w: w.rlike("^[0-9]+$")), (lambda w: w.rlike(r"^\p{Lu}+$"))
    return (F.size(words) == 3) & F.exists(words, number) & F.exists(words, word) & F.forall(words, lambda w: number(w) | word(w))


def standard_strains(c: Column) -> Column:
    """Sorted standard ids of a ``;``-separated cell, those that end in T without it too; ``none`` gives none."""
    parts = F.filter(F.transform(F.split(c, ";"), lambda x: F.trim(x)), lambda x: ~x.isin("", "none"))
    return F.array_sort(F.array_distinct(F.transform(type_variants(parts), standard_strain)))


def base_name(c: Column) -> Column:
    return F.substring_index(F.regexp_replace(c, "/+$", ""), "/", -1)


def extension(c: Column) -> Column:
    """The last dot of a file's name and what follows; empty without one."""
    return F.regexp_extract(base_name(c), r"^.+(\.[^.]*)$", 1)


def accession_of_path(c: Column) -> Column:
    """The first two underscore-separated parts of a folder's name."""
    return F.substring_index(base_name(c), "_", 2)
