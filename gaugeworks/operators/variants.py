"""Product variants: spec rows in long form, groups of equal specs, group ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.config import SPEC_RESERVED
from gaugeworks.functions import text as t
from gaugeworks.operators.relational import GateError
from gaugeworks.operators.sequence import row_above


def long_specs(files: Sequence[DataFrame], reserved: Sequence[str] = SPEC_RESERVED) -> DataFrame:
    """Spec tables of different columns as one: reserved columns, file_no, row_no and a map `specs`."""
    out = None
    for k, df in enumerate(files):
        own = [c for c in df.columns if c not in reserved and c not in ("file_no", "row_no")]
        specs = F.create_map(*[x for c in own for x in (F.lit(c), F.coalesce(F.col(f"`{c}`"), F.lit("")))]) if own else F.create_map().cast("map<string,string>")
        row = F.col("row_no") if "row_no" in df.columns else F.monotonically_increasing_id()
        part = df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in reserved], F.lit(k).alias("file_no"), row.alias("row_no"), specs.alias("specs"))
        out = part if out is None else out.unionByName(part)
    return out


def spec_tables(rows: DataFrame, reserved: Sequence[str] = SPEC_RESERVED) -> DataFrame:
    """The same of all files of an ordered read (file_no, row_no, cells), whose headers may differ: see `sources.ordered`."""
    return rows.select(*[F.coalesce(F.try_element_at("cells", F.lit(c)), F.lit("")).alias(c) for c in reserved], "file_no", "row_no", F.map_filter("cells", lambda k, _: ~k.isin(*reserved)).alias("specs"))


def variant_groups(rows: DataFrame, colours=None, same: dict | None = None) -> DataFrame:
    """Adds base, spec_key and variant_group; a base with several specs is told apart by its first product's finish."""
    base = t.base_name(F.col("product_name"), **({"colours": colours} if colours else {}), same=same)
    rows = rows.withColumns({"base": base, "spec_key": F.to_json(F.array_sort(F.map_entries("specs")))})
    first = F.min_by("product_name", F.struct("file_no", "row_no")).alias("_first")
    groups = rows.groupBy("category", "base", "spec_key").agg(first)
    split = F.count(F.lit(1)).over(Window.partitionBy("category", "base")) > 1
    tail = t.slug(F.coalesce(t.last_part(F.col("_first")), F.lit("standard")))
    groups = groups.withColumn("variant_group", F.when(split, F.concat_ws("-", t.slug(F.col("base")), tail)).otherwise(t.slug(F.col("base"))))
    return rows.join(groups.drop("_first"), ["category", "base", "spec_key"])


def collisions(grouped: DataFrame) -> DataFrame:
    """Group ids that stand for several groups."""
    return grouped.select("variant_group", "category", "base", "spec_key").distinct().groupBy("variant_group").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def check_collisions(grouped: DataFrame) -> None:
    bad = [r.variant_group for r in collisions(grouped).orderBy("variant_group").limit(20).collect()]
    if bad:
        raise GateError(f"group ids that collide: {bad}")


def spec_numbers(rows: DataFrame) -> DataFrame:
    """One row for each spec value that holds a number."""
    long = rows.select("file_no", "row_no", "category", "product_name", F.explode("specs").alias("spec", "value"))
    return long.withColumn("number", t.number(F.col("value"))).where("number is not null")


def drag_fill_suspects(rows: DataFrame, least: int = 2) -> DataFrame:
    """Rows whose numbers are one over the row above, in `least` columns, same file and category."""
    df = row_above(rows, ["file_no"], ["row_no"], ["category", "specs", "product_name"], "_above").where(F.col("_above.category") == F.col("category"))
    hits = F.filter(F.map_keys("specs"), lambda k: t.number(F.col("specs")[k]) - t.number(F.try_element_at(F.col("_above.specs"), k)) == 1)
    return df.withColumns({"above": F.col("_above.product_name"), "hits": F.array_sort(hits)}).where(F.size("hits") >= least).drop("_above")
