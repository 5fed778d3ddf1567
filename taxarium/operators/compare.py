"""Release comparison: field diffs, set differences, label propagation, snapshot merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids
from ..functions.cells import normal_cell


def field_changes(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """column, percent of common ids whose value differs (text comparison, null-safe), least first."""
    pairs = new.select(key, *columns).join(old.select(key, *(F.col(c).alias(f"_old_{c}") for c in columns)), key)
    both = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), (~F.col(c).cast("string").eqNullSafe(F.col(f"_old_{c}").cast("string"))).cast("int").alias("changed")) for c in columns)))
    return pairs.select(both.alias("x")).groupBy("x.column").agg(F.bround(100.0 * F.sum("x.changed") / F.count("*"), 2).alias("percent_changed"), F.count("*").alias("compared"))


def compare_field(old: DataFrame, new: DataFrame, key: str, column: str) -> DataFrame:
    joined = old.select(key, F.col(column).alias("old_value")).join(new.select(key, F.col(column).alias("new_value")), key)
    return joined.withColumn("similarity", F.when(F.col("old_value").eqNullSafe(F.col("new_value")), "Identical").otherwise("Different"))


def membership(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """key, status: added, removed or common, in one full outer join."""
    joined = old.select(F.col(key), F.lit(True).alias("_o")).distinct().join(new.select(F.col(key), F.lit(True).alias("_n")).distinct(), key, "full_outer")
    return joined.select(key, F.when(F.col("_o").isNull(), "added").when(F.col("_n").isNull(), "removed").otherwise("common").alias("status"))


def moved_ids(previous: DataFrame, current: DataFrame, key: str, ahead: int = 4) -> DataFrame:
    """key, n, previous key (_from), move: absent previous ids that a current id stands for, in another version or archive.

    Versions 1 to ``ahead`` beyond the current count; of one version the same archive goes first,
    then the other one.  Ids meet by what is left without version and archive, one row each.
    """
    left = previous.join(current.select(key), key, "left_anti").select(F.col(key).alias("_from"))
    left = left.select("_from", ids.release_key(F.col("_from")).alias("_base"), ids.version_number(F.col("_from")).alias("n"))
    c = F.col(key)
    now = current.filter(~ids.is_user(c)).select(key, ids.release_key(c).alias("_base"), ids.version_number(c).alias("_v")).distinct()
    pairs = now.join(left, "_base").filter((F.col("n") >= 1) & (F.col("n") <= F.col("_v") + ahead) & (F.col("_from") == F.concat(ids.version_base(F.col("_from")), F.lit("."), F.col("n"))))
    same = ids.version_base(c) == ids.version_base(F.col("_from"))
    move = F.when(same, "same").when(c.contains("RS_GCF"), "moved_to_refseq").otherwise("moved_to_genbank")
    first = pairs.select(key, "n", "_from", move.alias("move"), F.when(same, 0).otherwise(1).alias("_rank"))
    return first.groupBy(key, "n").agg(F.min_by(F.struct("_from", "move"), "_rank").alias("m")).select(key, "n", "m._from", "m.move")


def propagate_labels(previous: DataFrame, current: DataFrame, key: str, label: str) -> DataFrame:
    """Labels of retained ids, and of others through their versions and archives; one row per version that matches."""
    kept = previous.join(current.select(key), key, "left_semi").select(key, label, F.lit("retained").alias("move"))
    moved = moved_ids(previous, current, key).join(previous.select(F.col(key).alias("_from"), label), "_from")
    return kept.unionByName(moved.select(key, label, "move"))


def propagate(previous: DataFrame, current: DataFrame, key: str, label: str) -> DataFrame:
    """As propagate_labels, with labels only; a retained id whose label has changed is an error."""
    both = previous.filter(F.col(label).isNotNull()).select(key, label).join(current.select(key, F.col(label).alias("_now")), key)
    checked = F.when(F.col("_now").eqNullSafe(F.col(label)), F.col(label)).otherwise(F.raise_error(F.concat(F.lit("another label for "), key)))
    moved = moved_ids(previous, current, key).join(previous.filter(F.col(label).isNotNull()).select(F.col(key).alias("_from"), label), "_from")
    return both.select(key, checked.alias(label)).unionByName(moved.select(key, label))


def representatives(previous: DataFrame, current: DataFrame, key: str, flag: str) -> DataFrame:
    """key, flag of all current ids: representatives stay so under their new version or archive."""
    reps = previous.filter(flag).select(F.col(key).alias("_from")).distinct()
    kept = reps.select(F.col("_from").alias(key)).unionByName(moved_ids(previous, current, key).join(reps, "_from", "left_semi").select(key)).distinct()
    return current.select(key).distinct().join(kept.withColumn(flag, F.lit(True)), key, "left").select(key, F.coalesce(flag, F.lit(False)).alias(flag))


def propagation_report(previous: DataFrame, current: DataFrame, key: str, flag: str) -> DataFrame:
    """fate, genomes, percent, representatives of the previous ids: retained, new version, moved to an archive, or absent."""
    moved = moved_ids(previous, current, key).groupBy(F.col("_from").alias(key)).agg(F.min_by("move", F.when(F.col("move") == "same", 0).otherwise(1)).alias("_m"))
    old = previous.select(key, flag).join(current.select(key, F.lit(True).alias("_in")).distinct(), key, "left").join(moved, key, "left")
    fate = F.when(F.col("_in"), "retained").when(F.col("_m") == "same", "new version").otherwise(F.coalesce("_m", F.lit("absent")))
    counts = old.groupBy(fate.alias("fate")).agg(F.count("*").alias("genomes"), F.count_if(F.col(flag)).alias("representatives"))
    return counts.join(counts.agg(F.sum("genomes").alias("_all"))).select("fate", "genomes", F.bround(100.0 * F.col("genomes") / F.col("_all"), 2).alias("percent"), "representatives")


def merge_actions(existing: DataFrame, incoming: DataFrame, key: str, path: str) -> DataFrame:
    """key, action for the slowly changing merge of a genome table, joined on id and on version base."""
    e = existing.select(F.col(key), F.col(path).alias("_old"))
    n = incoming.select(F.col(key), F.col(path).alias("_new"))
    base = e.join(n, key, "left_anti").groupBy(ids.version_base(F.col(key)).alias("_base")).agg(F.min(key).alias("previous"))
    both = e.join(n, key, "full_outer").withColumn("_base", ids.version_base(F.col(key))).join(base, "_base", "left")
    action = (
        F.when(F.col("_old").isNotNull() & F.col("_new").isNotNull(), F.when(F.col("_old") == F.col("_new"), "unchanged").otherwise("update"))
        .when(F.col("_new").isNotNull(), F.when(F.col("previous").isNotNull(), "version").otherwise("add"))
        .otherwise("removed")
    )
    return both.select(key, action.alias("action"), F.when(action == "version", F.col("previous")).alias("previous"))


def upsert(target: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The next snapshot: new values over old ones, row by row."""
    fresh = new.select(key, *(F.col(c).alias(f"_new_{c}") for c in columns))
    joined = target.join(fresh, key, "full_outer")
    return joined.select(key, *(F.coalesce(f"_new_{c}", c).alias(c) if c in columns else F.col(c) for c in target.columns if c != key))


def outer_tables(tables: list[DataFrame], key: str) -> DataFrame:
    """Full outer join of tables on a key, blanks for missing text; of columns with one name the last table's counts."""
    owner = {c: i for i, t in enumerate(tables) for c in t.columns if c != key}
    parts = [t.select(key, *(c for c in t.columns if owner.get(c) == i)) for i, t in enumerate(tables)]
    out = parts[0]
    for t in parts[1:]:
        out = out.join(t, key, "full_outer")
    return out.select(key, *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in out.columns if c != key))


def column_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """column, change: columns of one release only."""
    rows = [(c, "deprecated") for c in old.columns if c not in new.columns] + [(c, "new") for c in new.columns if c not in old.columns]
    return old.sparkSession.createDataFrame(rows, "`column` string, change string")


def release_overview(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """column, percent_changed, compared: all common columns of common ids in normal form, least changed first.  User genomes of the old release do not count."""
    common = [c for c in new.columns if c in old.columns and c != key]
    normal = lambda t: t.select(key, *(normal_cell(c, F.col(c).cast("string")).alias(c) for c in common))
    return field_changes(normal(old.filter(~ids.is_user(F.col(key)))), normal(new), key, common).orderBy("percent_changed", "column")


def clean_up(existing: DataFrame, incoming: DataFrame, key: str, species: DataFrame) -> DataFrame:
    """key, status (deleted or added), species: added genomes with the species of (key, species), else N/A."""
    changed = membership(existing, incoming, key).filter("status <> 'common'")
    named = changed.join(species.select(key, "species"), key, "left")
    return named.select(key, F.when(F.col("status") == "removed", "deleted").otherwise("added").alias("status"), F.when(F.col("status") == "added", F.coalesce("species", F.lit("N/A"))).alias("species"))


def mirror_update(existing: DataFrame, summary: DataFrame, folders: DataFrame, key: str) -> DataFrame:
    """key, path, status: what a mirror adds, removes or compares.  Only latest versions of the summary with a folder in the newer archive (``GCF``) count."""
    latest = summary.filter("version_status = 'latest'").select(key).distinct()
    new = folders.filter(F.col(key).startswith("GCF")).join(latest, key, "left_semi")
    status = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").otherwise("compare")
    both = existing.select(key, F.col("path").alias("_old")).join(new.select(key, F.col("path").alias("_new")), key, "full_outer")
    return both.select(key, F.coalesce("_new", "_old").alias("path"), status.alias("status"))


def unpaired(summary: DataFrame, key: str, held: DataFrame, formatted: str) -> DataFrame:
    """Latest assemblies of the summary (key, version_status, note) that are no surveillance ones and whose formatted id is not held yet."""
    usable = summary.filter((F.col("version_status") == "latest") & ~F.coalesce(F.col("note"), F.lit("")).contains("surveillance"))
    return usable.withColumn("_f", ids.formatted_id(F.col(key))).join(held.select(F.col(formatted).alias("_f")), "_f", "left_anti").drop("_f")


def stale(rows: DataFrame, key: str, checksum: str, stored: DataFrame) -> DataFrame:
    """Rows whose checksum is not the stored one (key, checksum): what is still to be run."""
    known = stored.select(key, F.col(checksum).alias("_stored"))
    return rows.join(known, key, "left").filter(~F.col(checksum).eqNullSafe(F.col("_stored"))).drop("_stored")


def disagreements(a: DataFrame, b: DataFrame, key: str, column: str) -> DataFrame:
    """key, both values where both are given and differ."""
    one, two = a.select(key, F.col(column).alias("value_a")), b.select(key, F.col(column).alias("value_b"))
    return one.join(two, key).filter("value_a <> value_b")


def lookup(rows: DataFrame, key: str, known: DataFrame, column: str, default) -> DataFrame:
    """rows with the known value of their key, or the default."""
    return rows.join(known.select(key, F.col(column).alias("_v")), key, "left").withColumn(column, F.coalesce("_v", F.lit(default))).drop("_v")


def expand_if_shared(ids_: Column, more: Column) -> Column:
    """The union of both sets if they share an id, else the first."""
    return F.when(F.arrays_overlap(ids_, more), F.array_sort(F.array_union(ids_, more))).otherwise(ids_)


def folder_status(old: DataFrame, new: DataFrame, key: str, called: DataFrame | None = None) -> DataFrame:
    """key and sorted statuses of genome folders in both tables (key, kind, name, hash).

    A fasta file on one side only: incomplete.  Another hash of one: modified.  Else unmodified
    (but for the ``called`` keys, which have genes of their own), with new_protein, new_metadata or
    new_cds_rna where a new file of that kind is not the old one.  Files of kind report, which both
    sides should have: another hash is new_metadata; of the one named ``hashes`` neither side's is
    old_folder_dir, a new one alone new_hashes; any other lack is to_curate.
    """
    both = old.select(key).distinct().join(new.select(key).distinct(), key)
    files = old.select(key, "kind", "name", F.col("hash").alias("_a")).join(new.select(key, "kind", "name", F.col("hash").alias("_b")), [key, "kind", "name"], "full_outer")
    report = F.col("kind") == "report"
    fasta, changed = F.col("kind") == "fasta", F.col("_b").isNotNull() & ~F.col("_a").eqNullSafe(F.col("_b"))
    seen = lambda condition: F.coalesce(F.bool_or(condition), F.lit(False))
    paired, hashes = F.col("_a").isNotNull() & F.col("_b").isNotNull(), F.col("name") == "hashes"
    facts = files.groupBy(key).agg(
        seen(fasta & (F.col("_a").isNull() | F.col("_b").isNull())).alias("_i"), seen(fasta & changed).alias("_m"),
        *(seen((F.col("kind") == kind) & changed).alias(name) for kind, name in (("protein", "new_protein"), ("extra_fasta", "new_cds_rna"))),
        seen(((F.col("kind") == "other") & changed) | (report & paired & changed)).alias("new_metadata"),
        seen(report).alias("_reports"), seen(report & hashes).alias("_hashes"), seen(report & hashes & F.col("_a").isNull()).alias("new_hashes"),
        seen(report & ~paired & ~(hashes & F.col("_a").isNull())).alias("to_curate"),
    )
    facts = facts.withColumn("old_folder_dir", F.col("_reports") & ~F.col("_hashes"))
    called = (called if called is not None else both.limit(0)).select(key, F.lit(True).alias("_called")).distinct()
    names = ("new_protein", "new_metadata", "new_cds_rna", "old_folder_dir", "new_hashes", "to_curate")
    extra = F.array_compact(F.array(F.when(F.col("_called").isNull(), "unmodified"), *(F.when(F.col(n), n) for n in names)))
    status = F.when(F.col("_i"), F.array(F.lit("incomplete"))).when(F.col("_m"), F.array(F.lit("modified"))).otherwise(F.array_sort(extra))
    return facts.join(both, key, "left_semi").join(called, key, "left").select(key, status.alias("status"))


def candidate_lookup(rows: DataFrame, key: str, candidates: str, known: DataFrame, name: str, value: str) -> DataFrame:
    """key, value of the first candidate name (in array order) that is known; rows without any give none."""
    tried = rows.select(key, F.posexplode(candidates).alias("_i", name))
    return tried.join(known.select(name, value), name).groupBy(key).agg(F.min_by(value, F.struct("_i", value)).alias(value))
