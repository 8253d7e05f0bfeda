"""Change feeds and trees of folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import tables
from .land import DELETED


def folded(events: DataFrame, key: Sequence[str], deleted: Column, order: Sequence[Column]) -> DataFrame:
    """Changes of each key as one row: the last event, and whether any of them deletes."""
    return events.groupBy(*key).agg(F.max_by(F.struct(*[c for c in events.columns if c not in key]), F.struct(*order)).alias("last"), F.bool_or(deleted).alias("deleted"), F.count(F.lit(1)).alias("changes"))


def fetched_changes(changes: DataFrame, fetched: DataFrame, key: str, deleted: Column) -> DataFrame:
    """Rows to land of a history (``key`` and what ``deleted`` reads) and of what was ``fetched`` for it (``key`` and columns), one for each changed id.

    An id with any deletion is a tombstone, and so is one that was gone when it was
    fetched; what was fetched and isn't in the history is left out.  One aggregate, in
    which a much-changed id is one row for each task.
    """
    columns = [c for c in fetched.columns if c != key]
    row = F.struct(*[F.col(f"`{c}`") for c in columns])
    told = changes.where(F.col(key).isNotNull()).select(F.col(key), F.lit(True).alias("_told"), deleted.alias("_gone"), F.lit(None).cast(fetched.select(row.alias("r")).schema["r"].dataType).alias("_row"))
    found = fetched.select(F.col(key), F.lit(False).alias("_told"), F.lit(False).alias("_gone"), row.alias("_row"))
    one = told.unionAll(found).groupBy(key).agg(F.bool_or("_told").alias("_told"), F.bool_or(F.coalesce("_gone", F.lit(False))).alias("_gone"), F.max_by("_row", F.col("_row").isNotNull()).alias("_row"))
    gone = F.col("_gone") | F.col("_row").isNull()
    return one.where("_told").select(key, *[F.when(~gone, F.col("_row")[c]).alias(c) for c in columns], gone.alias(DELETED))


def subtree(spark: SparkSession, nodes: DataFrame, root: str) -> DataFrame:
    """(id, depth) of everything at or below ``root`` in ``nodes`` (id, parent); what hangs in a cycle is below nothing.

    Every node points to its parent, then to the parent's parent, and so on, twice as far
    each round: as many joins as the logarithm of the depth, whatever the number of nodes.
    """
    at_root = F.col("id") == root
    far = nodes.where("id is not null").dropDuplicates(["id"]).select("id", F.when(at_root, F.lit(root)).otherwise(F.col("parent")).alias("above"), F.when(at_root, 0).otherwise(1).cast("long").alias("depth"))
    path = tables.scratch(spark, "tree")
    far.write.parquet(f"{path}/0")
    rounds = 0
    while True:
        far = spark.read.parquet(f"{path}/{rounds}")
        open_ones = far.where(~at_root & (F.col("above") != root))
        # Beyond as many steps as there are nodes only cycles are left.
        if open_ones.isEmpty() or 2**rounds > far.count():
            return far.where(F.col("above") == root).select("id", F.col("depth").cast("int").alias("depth"))
        higher = far.select(F.col("id").alias("above"), F.col("above").alias("next"), F.col("depth").alias("more"))
        step = open_ones.join(higher, "above").where("next is not null").select("id", F.col("next").alias("above"), (F.col("depth") + F.col("more")).alias("depth"))
        rounds += 1
        far.where(at_root | (F.col("above") == root)).unionByName(step).write.parquet(f"{path}/{rounds}")


def glob_pattern(glob: str) -> str:
    """An anchored regular expression for a glob: ``*``, ``?`` and ``[...]`` stay within a folder, ``**/`` spans any number of them."""
    out, i = "", 0
    while i < len(glob):
        end = glob.find("]", i + 2) if glob[i] == "[" else -1
        if glob.startswith("**/", i):
            out, i = out + "(?:.*/)?", i + 3
        elif glob.startswith("**", i):
            out, i = out + ".*", i + 2
        elif end > 0:
            one = glob[i + 1 : end]
            not_in = one[0] in "!^" and len(one) > 1
            kept = "".join(c if c.isalnum() or c == "-" else "\\" + c for c in (one[1:] if not_in else one))
            out, i = out + (f"[^/{kept}]" if not_in else f"[{kept}]"), end + 1
        else:
            c = glob[i]
            out, i = out + ("[^/]*" if c == "*" else "[^/]" if c == "?" else c if c.isalnum() or c in "_/" else "\\" + c), i + 1
    return f"^{out}$"


def name_fits(name: Column, glob: str | None) -> Column:
    """Whether a file's name fits a glob, whatever the case of either; a null name fits none."""
    return F.lit(True) if glob is None else F.coalesce(F.lower(name).rlike(glob_pattern(glob.lower())), F.lit(False))


def delta(items: DataFrame, folders: bool = False, glob: str | None = None) -> DataFrame:
    """A delta page of items (id, name, is_folder, is_root, deleted, ...) as rows to land.

    Deleted entries become tombstones with their id alone, whatever their name; the root
    goes, and so do folders unless they are asked for and names outside the glob.
    """
    fits = name_fits(F.col("name"), glob)
    gone = F.col("deleted")
    if glob is not None:
        # A deletion that still has its name is held against the glob.
        fits = fits | (gone & F.col("name").isNull())
    kept = items.where(~F.col("is_root") & fits & (gone | F.lit(folders) | ~F.col("is_folder")))
    own = [c for c in items.columns if c not in ("id", "deleted", "is_root")]
    return kept.select("id", *[F.when(~gone, F.col(c)).alias(c) for c in own], gone.alias(DELETED))


def scoped(spark, folders: DataFrame, landed: DataFrame, changes: DataFrame, root: str, glob: str | None = None) -> DataFrame:
    """Rows to land (id, parent, name, _connector_deleted) from a feed that knows no scope.

    ``folders`` (id, parent) and ``landed`` (id, parent, name) say what was known; ``changes``
    (id, parent, name, is_folder, gone, seq) what happened.  The last change of an id counts.
    A changed file in scope is an upsert; a landed file that is gone, fell out of the scope or
    the glob, or whose folder did, is a tombstone; a file never landed gives none.
    """
    last = changes.groupBy("id").agg(F.max_by(F.struct("parent", "name", "is_folder", "gone"), "seq").alias("c")).select("id", "c.*")
    tree = folders.join(last, "id", "left_anti").select("id", "parent").unionByName(last.where("is_folder and not gone").select("id", "parent"))
    inside = subtree(spark, tree, root).select(F.col("id").alias("parent"), F.lit(True).alias("inside"))
    files = last.where("not is_folder").select("id", "parent", "name", "gone", F.lit(True).alias("changed"))
    known = landed.join(files.select("id"), "id", "left_anti").select("id", "parent", "name", F.lit(False).alias("gone"), F.lit(False).alias("changed"))
    had = landed.select("id", F.lit(True).alias("had"))
    fits = name_fits(F.col("name"), glob)
    state = files.unionByName(known).join(inside, "parent", "left").join(had, "id", "left")
    state = state.withColumn("_in", F.coalesce(F.col("inside"), F.lit(False)) & ~F.col("gone") & fits)
    rows = state.where((F.col("_in") & F.col("changed")) | (~F.col("_in") & F.col("had")))
    return rows.select("id", F.when(F.col("_in"), F.col("parent")).alias("parent"), F.when(F.col("_in"), F.col("name")).alias("name"), (~F.col("_in")).alias(DELETED))


def resynced(landed: DataFrame, scanned: DataFrame, key: Sequence[str], tag: str) -> DataFrame:
    """key and state (new, changed, same, gone) of a full scan against what is landed, by each row's tag."""
    was = landed.select(*key, F.col(tag).alias("_was"), F.lit(True).alias("_had"))
    now = scanned.select(*key, F.col(tag).alias("_now"), F.lit(True).alias("_has"))
    state = F.when(F.col("_had").isNull(), "new").when(F.col("_has").isNull(), "gone").when(F.col("_was").eqNullSafe(F.col("_now")), "same").otherwise("changed")
    return was.join(now, list(key), "full").select(*key, state.alias("state"))
