"""Writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tsv(df: DataFrame, path: str) -> None:
    df.write.csv(path, sep="\t", header=True)


def lineages(df: DataFrame, path: str, key: str, taxa: str) -> None:
    df.select(F.concat_ws("\t", F.col(key), F.concat_ws(";", taxa)).alias("value")).write.text(path)


def star_tree(ids: Column) -> Column:
    """Aggregate: a Newick tree whose leaves are the distinct ids."""
    return F.concat(F.lit("("), F.concat_ws(",", F.array_sort(F.collect_set(ids))), F.lit(");"))


def schema_description(df: DataFrame, descriptions: dict[str, str]) -> list[tuple[str, str, str]]:
    """Field, description and upper-case type of every column, sorted."""
    kinds = {"int": "INT", "bigint": "INT", "double": "FLOAT", "float": "FLOAT", "boolean": "BOOL"}
    return sorted((name, descriptions.get(name, ""), kinds.get(kind, "STR")) for name, kind in df.dtypes)


def text_table(df: DataFrame, limit: int, sort_by: list[str] | None = None, start: int = 0) -> str:
    """At most ``limit`` rows as a ruled table of text."""
    shown = (df.orderBy(*sort_by) if sort_by else df).offset(start).limit(limit).collect()
    cells = [list(df.columns)] + [["None" if v is None else str(v) for v in row] for row in shown]
    widths = [max(map(len, column)) for column in zip(*cells)]
    rule = "+" + "+".join("-" * (w + 2) for w in widths) + "+"
    drawn = ["|" + "|".join(f" {v:^{w}} " for v, w in zip(row, widths)) + "|" for row in cells]
    return "\n".join([rule, drawn[0], rule, *drawn[1:], *([rule] if len(drawn) > 1 else [])])


def html_table(df: DataFrame, limit: int) -> str:
    """At most ``limit`` rows as an HTML table, escaped."""
    return df.limit(limit).toPandas().to_html(index=False)
