"""A Merkle manifest of a dataset by cogrouped subtree exchange.

Every row is a leaf, every source a tree of its leaves in order, and the sources' roots a tree of their own. A tree is cut
into superblocks of ``FAN ** LEVELS`` consecutive nodes. Going up, each superblock is reduced to one node, and those nodes are
cut into superblocks again until every tree has one node. Going down, the nodes of a superblock are cogrouped with the outer
nodes that its own node needs (the siblings on the way from it to the root): one ``applyInPandas`` call repeats the local
reduction, joins the local proof with the outer one, and folds each claimed leaf up to the root. No call sees more than a
superblock and one outer path, and what crosses the network per row is its leaf, not its text.
"""

from __future__ import annotations

from hashlib import sha256

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranks import numbered
from ..sources.shared import settle
from .workers import with_package

FAN = 3
#: levels that one call reduces; a superblock has at most FAN ** LEVELS nodes
LEVELS = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

NODES = "tree long, at long, node string, depth int"
PATHS = "tree long, at long, depth int, subroot string, lefts array<string>, rights array<string>"
PROOFS = "doc_id string, leaf string, subroot string, lefts array<string>, rights array<string>, claimed string, folded_root string"


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    """SHA-256 over the values, each as its length in bytes, a colon and itself; ``-`` for null. Binary."""
    return F.unhex(F.sha2(F.concat(*map(_field, values)), 256))


def leaves(documents: DataFrame, claimed_text: Column | None = None) -> DataFrame:
    """(doc_id, source, leaf, claimed): the digest of every row, and of the same row with the text it is said to have.

    ``claimed`` is null where ``claimed_text`` is, or is not given: there the row's own leaf is folded.
    """
    values = [F.col(f"`{c}`") for c in FIELDS]
    claimed = F.lit(None).cast("binary")
    if claimed_text is not None:
        claimed = F.when(claimed_text.isNotNull(), leaf_digest(*values[:-1], claimed_text))
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                            leaf_digest(*values).alias("leaf"), claimed.alias("claimed"))


def digest(parts: str) -> str:
    return sha256(parts.encode()).hexdigest()


def climb(nodes: list[str], levels: int, fan: int = FAN) -> list[list[str]]:
    """The nodes of a superblock at every level, the given ones first; a run of fewer nodes, even one, is hashed like a full one."""
    out = [nodes]
    for _ in range(levels):
        nodes = [digest("".join(nodes[k:k + fan])) for k in range(0, len(nodes), fan)]
        out.append(nodes)
    return out


def siblings(rows: list[list[str]], fan: int = FAN) -> list[tuple[list[str], list[str]]]:
    """For every lowest node: what stands left and right of it in its run at each level below the last."""
    paths: list[tuple[list[str], list[str]]] = [([], [])] * len(rows[-1])
    for nodes in reversed(rows[:-1]):
        below = []
        for at in range(len(nodes)):
            run, (lefts, rights) = at - at % fan, paths[at // fan]
            below.append((["".join(nodes[run:at]), *lefts], ["".join(nodes[at + 1:run + fan]), *rights]))
        paths = below
    return paths


def fold(leaf: str, lefts: list[str], rights: list[str]) -> str:
    for left, right in zip(lefts, rights):
        leaf = digest(left + leaf + right)
    return leaf


def _reduced(levels: int, fan: int):
    import pandas as pd

    def reduce(key, part):
        part = part.sort_values("place")
        depth = int(part["depth"].iloc[0])
        top = climb(list(part["node"]), min(levels, depth), fan)[-1]
        return pd.DataFrame({"tree": [key[0]], "at": [key[1]], "node": top, "depth": [depth - levels]})

    return reduce


def _joined(levels: int, fan: int, finish):
    """A cogrouped function: reduces a superblock again and puts the outer path behind every local one."""
    def join(part, outer):
        if not len(part):
            return finish(part, [], None)
        part = part.sort_values("place")
        local = siblings(climb(list(part["node"]), min(levels, int(part["depth"].iloc[0])), fan), fan)
        above = outer.iloc[0]
        more = list(above["lefts"]), list(above["rights"])
        return finish(part, [([*a, *more[0]], [*b, *more[1]]) for a, b in local], above)

    return join


def _paths(part, paths, above):
    import pandas as pd

    return pd.DataFrame({"tree": part["tree"], "at": part["at"], "depth": part["depth"], "subroot": above["subroot"] if above is not None else None,
                         "lefts": [p[0] for p in paths], "rights": [p[1] for p in paths]})


def _proofs(part, paths, above):
    import pandas as pd

    used = [c if c is not None else n for c, n in zip(part["claimed"], part["node"])]
    return pd.DataFrame({"doc_id": part["doc_id"], "leaf": part["node"], "subroot": above["subroot"] if above is not None else None,
                         "lefts": [p[0] for p in paths], "rights": [p[1] for p in paths], "claimed": part["claimed"],
                         "folded_root": [fold(n, *p) for n, p in zip(used, paths)]})


def _depth(n: Column, fan: int) -> Column:
    """Levels of a tree of ``n`` leaves: the least d with fan ** d >= n."""
    powers = []
    while not powers or powers[-1] * fan < 1 << 63:
        powers.append(powers[-1] * fan if powers else 1)
    return F.size(F.filter(F.array(*map(F.lit, powers)), lambda p: p < n)).cast("int")


def _cut(nodes: DataFrame, levels: int, fan: int) -> DataFrame:
    """Nodes with their superblock and their place in it."""
    return nodes.withColumn("block", F.floor(F.col("at") / fan ** levels)).withColumn("place", F.col("at") % fan ** levels)


def _up(level: DataFrame, levels: int, fan: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """From (tree, at, node, depth): the nodes of every superblock level, and of each level the trees that end there."""
    stack, ended = [], []
    while True:
        stack.append(level)
        cut = _cut(level.select("tree", "at", "node", "depth"), levels, fan)
        nodes = settle(cut.groupBy("tree", "block").applyInPandas(_reduced(levels, fan), NODES), "nodes")
        ended.append(nodes.where("depth <= 0").select("tree", F.col("node").alias("subroot")))
        level = nodes.where("depth > 0")
        if level.isEmpty():
            return stack, ended


def _down(level: DataFrame, outer: DataFrame, levels: int, fan: int, finish, schema: str) -> DataFrame:
    cut = _cut(level, levels, fan)
    outer = outer.withColumnRenamed("at", "block").drop("depth")
    return cut.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block")).applyInPandas(_joined(levels, fan, finish), schema)


def _tops(ended: DataFrame, paths: DataFrame) -> DataFrame:
    """The outer paths of trees that end at a level: those of their roots."""
    zero = F.lit(0)
    return ended.join(paths, "tree").select("tree", zero.cast("long").alias("at"), zero.cast("int").alias("depth"), "subroot", "lefts", "rights")


def prove(leaf_rows: DataFrame, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """One row per leaf: doc_id, leaf, subroot, root, lefts, rights, claimed, folded_root.

    ``lefts`` and ``rights`` hold, level by level from the leaf to the root, what stands on either side of the node on the way
    in its run (hex digests end to end; empty where nothing does). ``folded_root`` is what the claimed leaf (the own one where
    null) gives with them. Leaves of a source ascend by doc_id, null first, then by leaf; sources ascend bytewise, null first.
    No rows give no rows.
    """
    spark = leaf_rows.sparkSession
    with_package(spark)
    rows = settle(leaf_rows.withColumn("_row", F.monotonically_increasing_id()), "leaves")
    ordered = numbered(rows, ["source", "doc_id", "leaf", "_row"], "_at", "placed")
    sources = ordered.groupBy("source").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    sources = settle(numbered(sources, ["source"], "tree", "sources"), "sources")
    many = sources.count()
    if not many:
        return spark.createDataFrame([], f"{PROOFS}, root string").select(F.col("doc_id").cast("long").alias("doc_id"), "leaf", "subroot", "root", "lefts", "rights", "claimed", "folded_root")
    own = sources.select(F.col("source").alias("_s"), "_first", "tree", _depth(F.col("_n"), fan).alias("depth"))
    placed = ordered.join(own, F.col("source").eqNullSafe(F.col("_s")))
    low = settle(placed.select("tree", (F.col("_at") - F.col("_first")).alias("at"), F.lower(F.hex("leaf")).alias("node"), "depth",
                               F.lower(F.hex("claimed")).alias("claimed"), F.col("doc_id").cast("string").alias("doc_id")), "tree")
    stack, ended = _up(low, levels, fan)

    # the sources' roots are the leaves of one tree more, whose own root has nothing around it
    subroots = ended[0]
    for e in ended[1:]:
        subroots = subroots.unionByName(e)
    zero = F.lit(0).cast("long")
    tops = settle(subroots.select(zero.alias("tree"), F.col("tree").alias("at"), F.col("subroot").alias("node"), _depth(F.lit(many).cast("long"), fan).alias("depth")), "subroots")
    upper, ends = _up(tops, levels, fan)
    none = F.array().cast("array<string>")
    paths = ends[-1].select("tree", zero.alias("at"), F.lit(0).alias("depth"), "subroot", none.alias("lefts"), none.alias("rights"))
    root = paths.first()["subroot"]
    for level in reversed(upper):
        paths = settle(_down(level, paths, levels, fan, _paths, PATHS), "paths")
    of_source = paths.select(F.col("at").alias("tree"), "lefts", "rights")

    outer = None
    for k in reversed(range(len(stack))):
        here = _tops(ended[k], of_source)
        outer = here if outer is None else here.unionByName(outer)
        if k:
            outer = settle(_down(stack[k], settle(outer, "outer"), levels, fan, _paths, PATHS), "paths")
    found = _down(low, settle(outer, "outer"), levels, fan, _proofs, PROOFS)
    return found.select(F.col("doc_id").cast("long").alias("doc_id"), "leaf", "subroot", F.lit(root).alias("root"), "lefts", "rights", "claimed", "folded_root")


def manifest(documents: DataFrame, claimed_text: Column | None = None, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf covers doc_id, source, lang, n_chars and text; null and empty differ. A null source is a source of its own and the
    first. Rows that repeat a doc_id, or have none (they come first), are leaves of their own, in the order of their digests;
    rows alike in all five columns are leaves of equal digest. ``claimed_text`` gives the text to check a row by; null takes
    the row as it is. An empty table gives no rows; further columns are ignored.
    """
    proved = prove(leaves(documents, claimed_text), fan, levels)
    sides = F.zip_with("lefts", "rights", lambda a, b: F.concat(a, b))
    return proved.select("doc_id", "leaf", "subroot", "root", F.sha2(F.array_join(sides, ""), 256).alias("proof_sha256"), "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"))
