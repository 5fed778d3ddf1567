"""Names of species: validity ladders, years of priority, epithet endings, categories."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from .ids import without_brackets

#: Fixed values: (phrase looked for in lower case, reason), in order of precedence.
PHRASES = (
    (" bacterium", "bacterium"), (" bacteirum", "bacteirum"), (" bacteria", "bacteria"), (" archaea", "archaea"), (" archaeon", "archaeon"), (" archeaon", "archeaon"), (" archaeum", "archaeum"),
)
LATER = (" group", " subdivision", " taxon", " cluster", " clade", " of ", "sp.", "cf.", " endosymbiont", " symbiont", " mycovirus")
#: Endings of one epithet in its three genders.
ENDINGS = (("us", "a"), ("us", "um"), ("a", "um"), ("is", "e"), ("er", "eris"), ("er", "ere"), ("eris", "ere"))


def tokens(c: Column) -> Column:
    """Runs of other characters than white space."""
    return F.filter(F.split(c, r"\s+"), lambda t: t != "")


def _bare_name(c: Column) -> Column:
    """Without quotes and the species prefix."""
    return F.regexp_replace(F.replace(c, F.lit("'"), F.lit("")), "^s__", "")


def binomial(c: Column) -> Column:
    """The first two words of a species label, three of a Candidatus."""
    test = _bare_name(c)
    return F.concat_ws(" ", F.slice(tokens(test), F.lit(1), F.when(F.lower(test).contains("candidatus"), 3).otherwise(2)))


def species_validity(c: Column) -> Column:
    """null for a valid ``s__`` name, else the first failing rule.  Names of one word after the blanks count as missing the generic name."""
    test, name = _bare_name(c), binomial(c)
    low, candidatus, words = F.lower(name), F.lower(test).contains("candidatus"), tokens(name)
    last = F.try_element_at(words, F.lit(-1))
    ladder = F.when(c == "s__", None).when(~F.replace(c, F.lit("'"), F.lit("")).startswith("s__"), "missing the species prefix")
    ladder = ladder.when((F.size(F.split(test, " ")) <= F.when(candidatus, 2).otherwise(1)) | (F.size(words) < F.when(candidatus, 3).otherwise(2)), "missing the generic name")
    ladder = ladder.when(name.rlike(r"^\p{Ll}"), "lower-case genus").when(last.rlike(r"\p{Lu}") & ~last.rlike(r"\p{Ll}"), "upper-case epithet")
    for phrase, reason in PHRASES:
        ladder = ladder.when(low.contains(phrase), reason)
    ladder = ladder.when(F.lower(last).contains("cyanobacterium"), "cyanobacterium")
    for phrase in LATER:
        ladder = ladder.when(low.contains(phrase), phrase.strip())
    ladder = ladder.when((F.get(tokens(low), F.lit(1)) == "oral") | (low.contains("candidatus") & (F.get(tokens(low), F.lit(2)) == "oral")), "oral")
    ladder = ladder.when(F.lower(test).contains("-like"), "-like")
    for word in ("endosymbiont", "symbiont", "mycovirus"):
        ladder = ladder.when(F.array_contains(tokens(F.lower(test)), word), word)
    ladder = ladder.when(F.array_contains(tokens(test), "phytoplasma"), "phytoplasma")
    return ladder.when(name.rlike(r"[^\p{L} \[\]]"), "character")


def canonical_species(c: Column) -> Column:
    """The prefix, genus and epithet (Candidatus: three words) of a label."""
    return F.concat(F.lit("s__"), binomial(c))


def extract_species(c: Column) -> Column:
    """A binomial label without its prefix and ``Candidatus``; null for bacteria without a name, lower-case genera and single words."""
    bare = F.regexp_replace(F.replace(c, F.lit("s__"), F.lit("")), "[Cc]andidatus", "")
    parts = F.split(bare, " ")
    usable = ~F.lower(c).contains(" bacterium") & ~F.lower(c).contains("sp.") & (bare != "") & ~bare.rlike(r"^\p{Ll}") & (F.size(parts) >= 2)
    return F.when(usable, F.concat(F.lit("s__"), F.concat_ws(" ", F.slice(parts, 1, 2))))


def species_of_lineage(c: Column) -> Column:
    """The subspecies name of an unfiltered lineage if it has one, else the species name; pathovars count as subspecies."""
    taxa = F.transform(F.split(c, ";"), lambda t: F.trim(t))
    last = lambda prefix: F.substring(F.try_element_at(F.filter(taxa, lambda t: t.startswith(prefix)), F.lit(-1)), len(prefix) + 1, 2**31 - 1)
    named = lambda x: F.when(x != "", without_brackets(x))
    return F.coalesce(named(F.replace(last("sb__"), F.lit(" pv. "), F.lit(" subsp. "))), named(last("s__")))


def standard_names(c: Column) -> Column:
    """The species and subspecies names that a raw name stands for: a binomial and its autonym, or a subspecies (and its species if they share the epithet)."""
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"(?i)candidatus\s", ""), r"(?i)serotype.*", ""), r"(?i)ser\..*", "")
    bare = F.trim(without_brackets(F.regexp_replace(bare, "[\"']", "")))
    t = F.split(bare, " ")
    word = lambda i: F.get(t, F.lit(i))
    two = F.concat_ws(" ", word(0), word(1))
    autonym = F.concat(two, F.lit(" subsp. "), word(1))
    own = word(1) == word(3)
    sub = F.when(F.size(t) == 4, F.when(own, F.array(bare, two)).otherwise(F.array(bare))).otherwise(F.when(own, F.array(two, autonym)).otherwise(F.array(F.concat_ws(" ", F.slice(t, 1, 4)))))
    none = F.array().cast("array<string>")
    return F.array_sort(F.when(F.size(t) < 2, none).when((F.size(t) >= 4) & (word(2) == "subsp."), sub).otherwise(F.array(two, autonym)))


def is_heterotypic(name: Column, official: Column) -> Column:
    """No official name has the epithet, whatever its gender."""
    second = lambda n: F.get(tokens(n), F.lit(1))
    return ~F.exists(official, lambda o: same_epithet(second(name), second(o)))


def type_rank(name: Column) -> Column:
    """What a type strain of that name is: of the species, or of a subspecies with another epithet."""
    t = tokens(name)
    at = F.array_position(t, "subsp.").cast("int")
    beside = lambda i: F.get(t, at - 1 + i)
    return F.when(~name.contains("subsp.") | (beside(-1) == beside(1)), "type strain of species").otherwise("type strain of subspecies")


def name_kind(name: Column, synonyms: Column, equivalents: Column, misspellings: Column) -> Column:
    held = lambda names, kind: F.when(F.array_contains(names, name), kind)
    return F.coalesce(held(synonyms, "synonyms"), held(equivalents, "equivalent name"), held(misspellings, "misspelling name"))


def assembly_category(note: Column) -> Column:
    """SAG, MAG or ENV of an assembly report's note; other derived genomes than surveillance ones are an error."""
    ladder = F.when(note.contains("derived from single cell"), "SAG").when(note.contains("derived from metagenome"), "MAG").when(note.contains("derived from environmental source"), "ENV")
    ladder = ladder.when(note.contains("derived from surveillance project"), None)
    return ladder.when(note.contains("derived"), F.raise_error(F.concat(F.lit("unknown kind of derived genome: "), note)))


def line_category(line: Column) -> Column:
    """MAG, SAG or ENV of one line of a flat file; a line that names a metagenome is tested for nothing else."""
    source = line.contains("/metagenome_source") | line.rlike(r"(?i)derived from(\w|\s)*metagenome")
    ladder = F.when(line.contains("metagenome"), F.when(source, "MAG")).when(line.contains("single cell"), "SAG")
    return ladder.when(line.contains("/environmental_sample") | line.contains("derived from environmental source"), "ENV")


def strip_tags(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, "<.*?>", ""))


def without_see(c: Column) -> Column:
    """Without ``(see …)``."""
    return F.regexp_replace(c, r"\(see[^)]+\)", "")


def _accents() -> tuple[str, str]:
    pairs = [(chr(i), plain) for i in range(0xC0, 0x250) if len(plain := unicodedata.normalize("NFKD", chr(i)).encode("ascii", "ignore").decode()) == 1]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def without_accents(c: Column) -> Column:
    """Latin letters without their marks; common entities are resolved, other characters than printable ASCII go."""
    for entity, text in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(text))
    return F.regexp_replace(F.translate(c, *_accents()), r"[^\x09-\x0D\x20-\x7E]", "")


def priority_year(c: Column, this_year: int = 2026) -> Column:
    """First year of an authority, without those of ``emend.`` and ``ex`` citations."""
    bare = F.regexp_replace(F.regexp_replace(c, r"emend\.[^\d]*\d{4}", ""), r"ex [^\d]*\d{4}", "")
    return F.get(F.filter(F.transform(F.regexp_extract_all(bare, F.lit(r"([1-3]\d{3})"), 1), lambda y: y.cast("int")), lambda y: y <= this_year), F.lit(0))


def same_epithet(a: Column, b: Column) -> Column:
    """Equal, or equal but for the ending of the grammatical gender."""
    out = a == b
    for x, y in ENDINGS:
        for p, q in ((x, y), (y, x)):
            out = out | (a.endswith(p) & (F.concat(F.expr("''"), F.substring(a, F.lit(1), F.length(a) - len(p)), F.lit(q)) == b))
    return out


def reverse_complement(c: Column) -> Column:
    return F.reverse(F.translate(c, "ACGT", "TGCA"))


#: Fixed values: (phrase looked for in lower case, word of the reason), in order of precedence.
LAX_PHRASES = (
    (" bacterium", "bacterium"), (" archaeon", "archaeon"), (" archeaon", "archeaon"), ("-like", "-like"), (" group ", "group"), (" symbiont", "symbiont"), (" endosymbiont", "endosymbiont"),
    (" taxon", "taxon"), (" cluster", "cluster"), (" of ", "of"),
)


def species_validity_lax(c: Column, full: bool = True, prefixed: bool = True) -> Column:
    """null for an acceptable species label, else the first failing rule of the shorter ladder."""
    test = F.regexp_replace(c, "^s__", "")
    low = F.lower(test)
    ladder = F.when(c == "s__", None)
    if prefixed:
        ladder = ladder.when(~c.startswith("s__"), "missing the species prefix")
    if full:
        ladder = ladder.when(F.size(F.split(test, " ")) <= F.when(low.contains("candidatus"), 2).otherwise(1), "missing the generic name")
    for phrase, reason in LAX_PHRASES:
        ladder = ladder.when(low.contains(phrase), reason)
    return ladder.when(test.rlike(r"^\p{Ll}"), "lower-case genus").when(low.contains("sp."), "sp.")
