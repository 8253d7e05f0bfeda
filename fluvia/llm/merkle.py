"""Operator 11: Merkle manifest of a dataset as a persistent tree.

Every row is a leaf: the SHA-256 of doc_id, source, lang, n_chars and text, each as
its UTF-8 bytes' count, ``:`` and the value, a null as ``-``.  The leaves of a source
in order of doc_id (nulls first, equal ids by their digests) make a tree of arity
16; the sources' roots, in order of the source (null first), make another one.

Places come from range partitions that are written with each row's number; a few
counts for each partition turn them into exact ranks.  Trees go up in aligned
blocks of 16^3 nodes, one block to a task, whose roots are the nodes of the next
round; a source of any size thus needs a few rounds.  The siblings above a block
come down the same way, as one row for each block.  In the blocks of leaves every
changed leaf then makes a version of the tree: it copies the ancestors of the
leaf, first those in its block, then those above, and shares all other nodes.

Rows that are repeated are leaves of their own.  An empty table gives no rows.  A
lone leaf is its source's root, a lone source's root the root.  A null doc_id is
never tampered with.  Other columns are left aside.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Children of a node, levels of a block that one task builds, and the nodes that it holds.
ARITY, LEVELS = 16, 3
BLOCK = ARITY**LEVELS

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What lies above a node: for each level up to the root, the digests left and right of it in its run.
_PATH = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
_ABOVE = pa.schema([("tree", pa.string()), ("i", pa.int64()), ("above", _PATH), ("subroot", pa.string()), ("root", pa.string())])
_ABOVE_DDL = "tree string, i long, above array<struct<left string, right string>>, subroot string, root string"


def tampered_id(doc_id: Column) -> Column:
    """Whether 5 divides the unsigned crc32 of the id in decimals."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def leaf_digest(text: Column) -> Column:
    """The digest of a row whose text is ``text``."""
    cells = [F.col("doc_id").cast("long"), F.col("source"), F.col("lang"), F.col("n_chars").cast("long"), text]
    parts = []
    for cell in cells:
        value = cell.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _ranked(df: DataFrame, tree: str, order: list[str], name: str) -> DataFrame:
    """``df`` with ``i``, the exact place in ``tree`` by ``order``, and ``size``, the nodes of that tree.

    The rows are dealt by ranges once and written with their number in the partition, so that
    ranks and rows come from one dealing.
    """
    dealt = df.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order).withColumn("_n", F.monotonically_increasing_id())
    dealt = common.staged(dealt.withColumn("_part", F.shiftright("_n", 33)), name)
    runs = dealt.groupBy(tree, "_part").agg(F.count(F.lit(1)).alias("_count"), F.min("_n").alias("_first"))
    own = Window.partitionBy(tree)
    before = own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each partition that a tree has rows in.
    starts = runs.select(tree, "_part", "_first", F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_start"), F.sum("_count").over(own).alias("size"))
    return dealt.join(starts, [tree, "_part"]).withColumn("i", F.col("_start") + F.col("_n") - F.col("_first")).drop("_n", "_part", "_start", "_first")


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels_of(nodes: list[str], size: int) -> list[list[str]]:
    """The levels of a block, from its lowest nodes up, of a tree that has ``size`` nodes on that level."""
    out = [nodes]
    while size > 1 and len(out) <= LEVELS:
        out.append([digest(out[-1][a : a + ARITY]) for a in range(0, len(out[-1]), ARITY)])
        size = -(-size // ARITY)
    return out


def copied_path(levels: list[list[str]], at: int, node: str) -> list[str]:
    """The nodes that a version with ``node`` at ``at`` has of its own in a block; it shares all others."""
    own = [node]
    for level in levels[:-1]:
        first = at - at % ARITY
        own.append(digest([*level[first:at], own[-1], *level[at + 1 : first + ARITY]]))
        at //= ARITY
    return own


def siblings(levels: list[list[str]], at: int) -> list[dict[str, str]]:
    out = []
    for level in levels[:-1]:
        first = at - at % ARITY
        out.append({"left": "".join(level[first:at]), "right": "".join(level[at + 1 : first + ARITY])})
        at //= ARITY
    return out


def _block(group: pa.Table) -> tuple[pa.Table, list[list[str]]]:
    group = group.sort_by("i")
    return group, levels_of(group.column("digest").to_pylist(), group.column("size")[0].as_py())


def _root(key: tuple, group: pa.Table) -> pa.Table:
    _, levels = _block(group)
    return pa.table({"tree": [key[0].as_py()], "i": [key[1].as_py()], "digest": [levels[-1][0]], "size": pa.array([-(-group.column("size")[0].as_py() // BLOCK)], pa.int64())})


def _blocks(nodes: DataFrame):
    return nodes.withColumn("block", F.expr(f"i div {BLOCK}")).groupBy("tree", "block")


def _grown(nodes: DataFrame) -> list[DataFrame]:
    """The rounds of trees (tree, i, digest, size) from ``nodes`` up to one root for each tree."""
    rounds = [nodes]
    while (rounds[-1].agg(F.max("size")).first()[0] or 0) > 1:
        rounds.append(common.staged(_blocks(rounds[-1].select("tree", "i", "digest", "size")).applyInArrow(_root, "tree string, i long, digest string, size long"), "merkle-nodes"))
    return rounds


def _inherited(key: tuple, group: pa.Table, above: pa.Table) -> pa.Table:
    """The paths of a block's nodes: inside the block, then what lies above its root."""
    group, levels = _block(group)
    higher, subroot, root = (above.column(c)[0].as_py() for c in ("above", "subroot", "root"))
    place = group.column("i").to_pylist()
    paths = [siblings(levels, at - place[0]) + higher for at in place]
    n = len(place)
    return pa.table([pa.array([key[0].as_py()] * n), pa.array(place, pa.int64()), pa.array(paths, _PATH), pa.array([subroot] * n, pa.string()), pa.array([root] * n, pa.string())], schema=_ABOVE)


def _descended(rounds: list[DataFrame], top: DataFrame) -> DataFrame:
    """(tree, i, above, subroot, root) for the nodes of the second round, from that of the roots."""
    above = top
    for nodes in reversed(rounds[1:-1]):
        above = common.staged(_blocks(nodes.select("tree", "i", "digest", "size")).cogroup(above.groupBy("tree", "i")).applyInArrow(_inherited, _ABOVE_DDL), "merkle-paths")
    return above


_PROVED = pa.schema([(c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")] + [("copied", pa.list_(pa.string()))])


def _proved(key: tuple, group: pa.Table, above: pa.Table) -> pa.Table:
    group, levels = _block(group)
    higher, subroot, root = (above.column(c)[0].as_py() for c in ("above", "subroot", "root"))
    beyond = "".join(step["left"] + step["right"] for step in higher)
    first = group.column("i")[0].as_py()
    rows = []
    for at, leaf, bent in zip(group.column("i").to_pylist(), levels[0], group.column("bent").to_pylist(), strict=True):
        at -= first
        proof = digest([s for step in siblings(levels, at) for s in step.values()] + [beyond])
        own = copied_path(levels, at, bent or leaf)
        for step in higher:
            own.append(digest([step["left"], own[-1], step["right"]]))
        rows.append((leaf, subroot, root, proof, own[-1], own if bent else None))
    proved = pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), _PROVED, strict=True)], schema=_PROVED)
    return proved.add_column(0, pa.field("doc_id", pa.int64()), group.column("doc_id")).add_column(1, pa.field("source", pa.string()), group.column("source"))


def manifest(df: DataFrame, tampered: Column | None = None, text: Column | None = None) -> DataFrame:
    """Of every row of ``df`` (doc_id, source, lang, n_chars, text): doc_id, source, leaf, subroot, root, proof_sha256, folded_root, verified, copied.

    ``tampered``: which rows are changed in what is checked, and ``text``: their texts then
    (as the contract has it where not given).  ``copied``: the nodes of a changed row's
    version from the leaf to the root, null for the others.
    """
    text = F.translate(F.col("text"), _UPPER, _LOWER) if text is None else text
    tampered = tampered_id(F.col("doc_id").cast("long")) if tampered is None else tampered
    leaves = df.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), leaf_digest(F.col("text")).alias("digest"), F.when(tampered, leaf_digest(text)).alias("bent"),
        # A null source is a tree of its own, before all others.
        F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("")).alias("tree"),
    )
    leaves = common.staged(_ranked(common.staged(leaves, "leaves"), "tree", ["doc_id", "digest"], "dealt-leaves"), "ranked-leaves")
    rounds = _grown(leaves)
    subroots = rounds[-1].select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest")
    tops = common.staged(_ranked(subroots, "tree", ["of"], "dealt-sources"), "ranked-sources")
    sources = _grown(tops)
    # Round by round from the root to the sources, and from a source's root to its leaves.
    root = sources[-1].select("tree", "i", F.array().cast("array<struct<left:string,right:string>>").alias("above"), F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    above = _descended([tops, *sources], root)
    named = tops.select("i", F.col("of"), F.col("digest").alias("_subroot"))
    above = common.staged(above.drop("tree", "subroot").join(named, "i").select(F.col("of").alias("tree"), F.lit(0).cast("long").alias("i"), "above", F.col("_subroot").alias("subroot"), "root"), "merkle-paths")
    above = _descended(rounds, above)
    ddl = "doc_id long, source string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, copied array<string>"
    out = _blocks(leaves).cogroup(above.groupBy("tree", "i")).applyInArrow(_proved, ddl)
    verified = (F.col("folded_root") == F.col("root")).alias("verified")
    return out.select("doc_id", "source", "leaf", "subroot", "root", "proof_sha256", "folded_root", verified, "copied")


def sql() -> str:
    """The same rows by plain recursion over levels, for tables of up to 16^5 rows a source and 16^3 sources."""
    return _SQL


def _levels_sql(name: str, levels: int) -> str:
    """From the table name_0 (tree, i, h, n): name_1 and so on, and the runs of each level."""
    out = []
    for k in range(levels):
        out.append(
            f"{name}r_{k} AS (SELECT tree, i // 16 AS run, list(h ORDER BY i) AS hs, any_value(n) AS n FROM {name}_{k} GROUP BY tree, i // 16),\n"
            f"{name}_{k + 1} AS (SELECT tree, run AS i, CASE WHEN n > 1 THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h, (n + 15) // 16 AS n FROM {name}r_{k}),"
        )
    return "\n".join(out)


def _fold_sql(name: str, levels: int, source: str, i: str) -> str:
    """Joins each row of ``source`` with its runs, level by level: proof and folded digest."""
    out, last = [], source
    for k in range(levels):
        at = f"(({i} // {16**k}) % 16)"
        out.append(
            f"{name}f_{k} AS (SELECT s.* EXCLUDE (proof, folded), CASE WHEN r.n > 1 THEN proof || array_to_string(hs[:{at}], '') || array_to_string(hs[{at} + 2:], '') ELSE proof END AS proof,\n"
            f"  CASE WHEN r.n > 1 THEN sha256(array_to_string(hs[:{at}], '') || folded || array_to_string(hs[{at} + 2:], '')) ELSE folded END AS folded\n"
            f"  FROM {last} s JOIN {name}r_{k} r ON r.tree = s.{name}tree AND r.run = s.{i} // {16 ** (k + 1)}),"
        )
        last = f"{name}f_{k}"
    return "\n".join(out)


def _cell_sql(e: str) -> str:
    return f"coalesce(CAST(octet_length(encode(CAST({e} AS VARCHAR))) AS VARCHAR) || ':' || CAST({e} AS VARCHAR), '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_cell_sql(e) for e in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def crc32_sql(digits: str) -> str:
    """Unsigned crc32 of a text of ASCII characters."""
    step = "xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)"
    each = f"list_transform(string_split({digits}, ''), lambda b: CAST(ascii(b) AS BIGINT))"
    inner = f"list_reduce(CAST(range(8) AS BIGINT[]), lambda c, k: {step}, xor(s, b))"
    return f"xor(list_reduce({each}, lambda s, b: {inner}, CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT))"


_SQL = f"""
WITH base AS (
  SELECT doc_id, coalesce('s' || source, '') AS tree, {_leaf_sql("text")} AS leaf,
    CASE WHEN {crc32_sql("CAST(doc_id AS VARCHAR)")} % 5 = 0 THEN {_leaf_sql(f"translate(text, '{_UPPER}', '{_LOWER}')")} END AS bent
  FROM documents),
l_0 AS (SELECT *, leaf AS h, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM base),
{_levels_sql("l", 5)}
t_0 AS (SELECT '' AS tree, tree AS source_tree, h, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM l_5),
{_levels_sql("t", 3)}
start AS (SELECT doc_id, l_0.tree AS ltree, '' AS ttree, l_0.i AS li, t_0.i AS ti, leaf, t_0.h AS subroot, '' AS proof, coalesce(bent, leaf) AS folded FROM l_0 JOIN t_0 ON t_0.source_tree = l_0.tree),
{_fold_sql("l", 5, "start", "li")}
{_fold_sql("t", 3, "lf_4", "ti")}
top AS (SELECT h AS root FROM t_3)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified FROM tf_2, top
"""
