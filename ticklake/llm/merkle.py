"""Merkle manifest of a dataset: a leaf a row, a tree a group, a tree over the
groups' roots, and for every leaf the proof that leads from it to the root.

A node's place is its rank; the digits of the rank to the base ``FAN`` say
where it stands in its run at each level.  Ranks come from one range sort:
each sorted partition numbers its rows, and the partitions' counts, summed per
group, give what lies before (no window over the rows of a group).

Roll-up.  Within a block of FAN ** BLOCK_LEVELS ranks one digit column after
the other is grouped away; what it groups becomes a struct of the run's hash
and its children, so that a block ends as one nested struct of at most 729
leaves.  All groupings keep to the one exchange by (group, block).  The blocks'
hashes are the nodes of the next tier, until each group is one block.

Proofs.  From the top tier down, a nested ``transform`` walks each block and
gathers at every level the hashes left and right of the child it follows;
``explode`` gives the rows.  What the tier above found for a block is grouped
together with the block's struct by (group, block): nothing is joined.

Hot groups are blocks like all others.  Stored tables between the tiers keep a
lost executor from costing more than the tier it was in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import store

FAN = 3
BLOCK_LEVELS = 6
BLOCK = FAN ** BLOCK_LEVELS
STEPS = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """H: lowercase hex SHA-256 of the parts one after the other."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """'-' for null, else the UTF-8 length, ':' and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


# ---------------------------------------------------------------- ranks
def ranked(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Stored ``rows`` with ``rank`` (from 0) in their ``grp`` by ``order``
    (which must tell rows apart) and ``levels``: the levels of a tree over the
    group, the least L with FAN ** L at least its size."""
    ordered = store(rows.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order)
                    .withColumn("_at", F.monotonically_increasing_id()), name)
    part = F.shiftright("_at", 33).alias("_part")
    runs = ordered.groupBy("grp", part).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    powers = F.array(*[F.lit(FAN ** i).cast("long") for i in range(40)])
    # a group has as many rows here as partitions hold it
    runs = runs.groupBy("grp").agg(F.array_sort(F.collect_list(F.struct("_part", "_first", "_n"))).alias("_runs"),
                                   F.sum("_n").alias("_size"))
    before = F.aggregate("_runs", F.struct(F.lit(0).cast("long").alias("sum"),
                                           F.array().cast("array<bigint>").alias("all")),
                         lambda acc, x: F.struct((acc["sum"] + x["_n"]).alias("sum"),
                                                 F.concat(acc["all"], F.array(acc["sum"])).alias("all")),
                         lambda acc: acc["all"])
    runs = runs.select("grp", F.size(F.filter(powers, lambda p: p < F.col("_size"))).alias("levels"),
                       F.explode(F.arrays_zip(F.col("_runs").alias("run"), before.alias("before"))).alias("r"))
    runs = runs.select("grp", "levels", F.col("r.run._part").alias("_part"),
                       (F.col("r.before") - F.col("r.run._first")).alias("_shift"))
    return (ordered.withColumn("_part", part).join(runs, ["grp", "_part"])
            .withColumn("rank", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift"))


# ---------------------------------------------------------------- up
def roll_up(nodes: DataFrame) -> DataFrame:
    """(grp, rank, levels, h, item) -> (grp, block, levels, node): node nests
    its children down to (h, item).  Levels beyond ``levels`` hash nothing."""
    rank = F.col("rank")
    rows = nodes.select("grp", "levels", F.floor(rank / BLOCK).cast("long").alias("block"),
                        *[(F.floor(rank / FAN ** i) % FAN).cast("int").alias(f"d{i}") for i in range(BLOCK_LEVELS)],
                        F.struct("h", "item").alias("node"))
    rows = rows.repartition("grp", "block")
    for i in range(BLOCK_LEVELS):
        keys = ["grp", "block", "levels", *[f"d{j}" for j in range(i + 1, BLOCK_LEVELS)]]
        rows = rows.groupBy(*keys).agg(
            F.array_sort(F.collect_list(F.struct(F.col(f"d{i}").alias("d"), "node"))).alias("kids"))
        first = F.col("kids")[0]["node"]["h"]
        h = F.when(F.col("levels") > i, digest(F.array_join(F.col("kids.node.h"), ""))).otherwise(first)
        rows = rows.select(*keys, F.struct(h.alias("h"), "kids").alias("node"))
    return rows


def tiers_of(nodes: DataFrame, name: str) -> list[DataFrame]:
    """The stored blocks of every tier; those of the last are one a group."""
    levels, tiers = nodes.agg(F.max("levels")).first()[0] or 0, []
    while True:
        blocks = store(roll_up(nodes), f"{name}-{len(tiers)}")
        tiers.append(blocks)
        levels -= BLOCK_LEVELS
        if levels <= 0:
            return tiers
        nodes = blocks.select("grp", F.col("block").alias("rank"), F.col("node.h").alias("h"),
                              F.greatest(F.col("levels") - BLOCK_LEVELS, F.lit(0)).alias("levels"),
                              F.struct("block").alias("item"))


# ---------------------------------------------------------------- down
def _paths(node: Column, level: int, levels: Column, above: Column) -> Column:
    """The leaves below a node as array<struct<item, proof>>; a proof's steps go from the leaf up."""
    if level == 0:
        return F.array(F.struct(node["item"].alias("item"), above.alias("proof")))
    hashes = F.transform(node["kids"], lambda k: k["node"]["h"])

    def below(kid: Column, i: Column) -> Column:
        step = F.array(F.struct(F.array_join(F.slice(hashes, F.lit(1), i), "").alias("left"),
                                F.array_join(F.slice(hashes, i + 2, F.lit(FAN)), "").alias("right")))
        step = F.when(levels >= level, step).otherwise(F.array().cast(STEPS))
        return _paths(kid["node"], level - 1, levels, F.concat(step, above))
    return F.flatten(F.transform(node["kids"], below))


def hand_down(tiers: list[DataFrame], ups: DataFrame) -> DataFrame:
    """(grp, block 0, up) -> (grp, item, up) of the lowest nodes, where up is
    struct<proof, subroot, root> and the proof is now that of the node."""
    for n, blocks in reversed(list(enumerate(tiers))):
        up_type = ups.schema["up"].dataType
        both = (blocks.withColumn("up", F.lit(None).cast(up_type))
                .unionByName(ups.select("grp", "block", "up"), allowMissingColumns=True))
        whole = both.groupBy("grp", "block").agg(*[F.first(c, ignorenulls=True).alias(c)
                                                   for c in ("levels", "node", "up")])
        rows = whole.select("grp", "up", F.explode(_paths(F.col("node"), BLOCK_LEVELS, F.col("levels"),
                                                          F.col("up.proof"))).alias("x"))
        rows = rows.select("grp", F.col("x.item").alias("item"),
                           F.struct(F.col("x.proof").alias("proof"), F.col("up.subroot").alias("subroot"),
                                    F.col("up.root").alias("root")).alias("up"))
        if n:
            ups = rows.select("grp", F.col("item.block").alias("block"), "up")
    return rows


def manifest(rows: DataFrame, group: str, key: str, leaf: str, name: str = "merkle") -> DataFrame:
    """``rows`` with ``subroot``, ``root`` and ``proof`` (array of (left,
    right): the hashes of the run on either side, from the leaf up).

    Leaves of a group ascend by ``key`` (null first; equal keys by leaf, and
    equal leaves stand in any order, which changes no result); groups ascend
    by their UTF-8 bytes (null first).  An empty table gives no rows."""
    grp = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    rest = F.struct(*rows.columns)
    leaves = store(rows.select(grp.alias("grp"), F.col(key).alias("_key"), F.col(leaf).alias("h"), rest.alias("item"),
                               F.monotonically_increasing_id().alias("_row")), f"{name}-leaves")
    trees = tiers_of(ranked(leaves, ["_key", "h", "_row"], f"{name}-order").drop("_key", "_row"), f"{name}-blocks")
    subroots = trees[-1].select(F.lit("").alias("grp"), F.col("grp").alias("_key"), F.col("node.h").alias("h"),
                                F.struct(F.col("grp"), F.col("node.h").alias("subroot")).alias("item"))
    top = tiers_of(ranked(subroots, ["_key"], f"{name}-groups").drop("_key"), f"{name}-top")
    root = top[-1].select("grp", "block", F.struct(F.array().cast(STEPS).alias("proof"),
                                                   F.lit(None).cast("string").alias("subroot"),
                                                   F.col("node.h").alias("root")).alias("up"))
    groups = hand_down(top, root).select(
        F.col("item.grp").alias("grp"), F.lit(0).cast("long").alias("block"),
        F.struct(F.col("up.proof").alias("proof"), F.col("item.subroot").alias("subroot"),
                 F.col("up.root").alias("root")).alias("up"))
    return hand_down(trees, groups).select("item.*", "up.subroot", "up.root", "up.proof")


def siblings(proof: Column) -> Column:
    """The hashes that a proof holds, one after the other."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "")


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(proof, leaf, lambda h, s: digest(s["left"], h, s["right"]))


def audit_documents(docs: DataFrame, fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text")) -> DataFrame:
    """The manifest of documents, checked against a copy in which half of the
    documents (even CRC-32 of the decimal doc_id) have lost their line breaks.

    A null doc_id sorts first and is never tampered with; null fields count
    as '-'; empty texts, repeated rows and repeated ids are leaves of their
    own; other columns are ignored."""
    values = {f: F.col(f) for f in fields}
    lost = values | {"text": F.replace(F.col("text"), F.lit("\n"), F.lit(""))}
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", leaf_hash(*values.values()).alias("leaf"),
                       F.when(tampered, leaf_hash(*lost.values())).alias("tampered_leaf"))
    made = manifest(rows, "source", "doc_id", "leaf")
    back = made.withColumn("folded_root", folded(F.coalesce("tampered_leaf", "leaf"), F.col("proof")))
    return back.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("proof")), 256).alias("proof_sha256"),
                       "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
