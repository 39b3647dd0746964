"""Merkle manifest of a table: a tree of hashes per language, one over their roots, and a proof of
every row that is climbed by a recursive query."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordstrata.llm.common import stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 2
DIGEST_DIGITS = 64
# Levels that one node row spans at most: 2 ** 10 hashes are gathered for it.
MOST_SPAN = 10
POWERS = [FAN**k for k in range(63)]
TOP = ""
NODES = "id string, parent string, sides string, siblings binary, row long"
# Rows that may be sent to all tasks: counts by range and tree, some 30 bytes each, and node rows,
# each a hash or two for up to ten levels.
MOST_SENT = 100_000
RECURSION_ROWS = "spark.sql.cteRecursionRowLimit"


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf_hash(columns: dict[str, Column]) -> Column:
    """Hash of a row: ``-`` for a null, else the length in UTF-8 bytes, ``:`` and the value."""
    parts = []
    for name in FIELDS:
        value = columns[name].cast("string")
        parts.append(
            F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))
        )
    return digest(F.concat(*parts))


def tampered(modulus: int = 7) -> Column:
    """Rows that the check of the manifest changes: ``modulus`` divides the checksum of doc_id."""
    by_id = F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == 0
    return F.coalesce(by_id, F.lit(False)) & F.col("n_chars").isNotNull()


def leaves(docs: DataFrame, changed: Column) -> DataFrame:
    """(doc_id, tree, leaf, given, row): the hash of every row and the hash that a reader finds, in
    which ``n_chars`` is one more where ``changed`` holds. The tree is that of the language; its
    name sorts like the language, null first."""
    own = {name: F.col(name) for name in FIELDS}
    more = {**own, "n_chars": F.col("n_chars") + 1}
    leaf = leaf_hash(own)
    return stored(
        docs.select(
            "doc_id",
            F.coalesce(F.concat(F.lit("="), "lang"), F.lit("-")).alias("tree"),
            leaf.alias("leaf"),
            F.when(changed, leaf_hash(more)).otherwise(leaf).alias("given"),
            F.monotonically_increasing_id().alias("row"),
        )
    )


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``at``, their place in their ``tree`` by ``order``, and ``n``, its size.

    The rows are sorted in ranges, so a tree that holds a third of all rows takes many tasks. Each
    range counts its rows of each tree; sums of these counts turn places in a range into places in
    the tree.
    """
    placed = stored(
        rows.repartitionByRange("tree", *order)
        .sortWithinPartitions("tree", *order)
        .withColumn("nth", F.monotonically_increasing_id())
        .withColumn("part", F.spark_partition_id())
    )
    # A row for each range and tree in it.
    runs = placed.groupBy("part", "tree").agg(F.min("nth").alias("first"), F.count("*").alias("n"))
    runs = runs.coalesce(1)
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        "part",
        "tree",
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(Window.partitionBy("tree")).alias("n"),
    )
    starts = stored(starts)
    if starts.count() <= MOST_SENT:
        starts = F.broadcast(starts)
    joined = placed.join(starts, ["part", "tree"])
    return joined.withColumn("at", F.col("nth") + F.col("shift")).drop("part", "nth", "shift")


def _ranked(rows: DataFrame) -> DataFrame:
    """:func:`numbered` for few rows, by ``name``."""
    tree = Window.partitionBy("tree")
    at = F.row_number().over(tree.orderBy("name")) - 1
    return rows.withColumns({"at": at.cast("long"), "n": F.count("*").over(tree)})


def _power(exponent: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, POWERS)), (exponent + 1).cast("int"))


def _levels(n: Column) -> Column:
    """How many levels are above ``n`` nodes."""
    return F.size(F.filter(F.array(*map(F.lit, POWERS)), lambda power: power < n))


def node_id(tree: Column, level: Column, at: Column) -> Column:
    return F.concat_ws("/", tree, level.cast("string"), at.cast("string"))


def _level_above(below: Column) -> Column:
    last = F.floor((F.size(below) - 1) / FAN).cast("int")
    return F.transform(
        F.sequence(F.lit(0), last),
        lambda run: digest(F.array_join(F.slice(below, run * FAN + 1, F.lit(FAN)), "")),
    )


def _step(level: Column, place: Column) -> Column:
    """What stands left and right of a node in its run."""
    in_run = (place % FAN).cast("int")
    first = (place - in_run).cast("int")
    return F.struct(
        F.array_join(F.slice(level, first + 1, in_run), "").alias("left"),
        F.array_join(F.slice(level, first + in_run + 2, FAN - 1 - in_run), "").alias("right"),
    )


def _climbed(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From nodes (tree, id, at, hash, n, level, span, row) those ``span`` levels above, or the root
    of the tree if that is nearer, and the rows (id, parent, sides, siblings, row) that link them.
    ``row`` is that of a leaf.

    All nodes under one parent are gathered, ``FAN ** span`` at most. ``siblings`` are a node's on
    each level on the way, see :func:`_bytes_of`."""
    below = F.least(F.col("span"), _levels(F.col("n"))).alias("rise")
    members = F.sort_array(F.collect_list(F.struct("at", "id", "hash", "row"))).alias("members")
    block = F.floor(F.col("at") / _power(F.col("span"))).alias("block")
    blocks = nodes.groupBy("tree", "level", "n", "span", block).agg(members)
    blocks = blocks.withColumn("rise", below).withColumn("level_0", F.col("members.hash"))
    for k in range(MOST_SPAN):
        above = F.when(F.col("rise") > k, _level_above(F.col(f"level_{k}")))
        blocks = blocks.withColumn(f"level_{k + 1}", above)
    levels = F.array(*(f"level_{k}" for k in range(MOST_SPAN + 1)))
    blocks = stored(
        blocks.select(
            "tree",
            "span",
            "block",
            (F.col("level") + F.col("rise")).alias("level"),
            F.ceil(F.col("n") / _power(F.col("rise"))).cast("long").alias("n"),
            F.transform(
                F.col("members"),
                lambda member, place: F.struct(
                    member["id"].alias("id"),
                    member["row"].alias("row"),
                    F.transform(
                        F.sequence(F.lit(0), F.col("rise") - 1),
                        lambda k: _step(
                            F.element_at(levels, k + 1), F.floor(place / _power(k)).cast("int")
                        ),
                    ).alias("steps"),
                ),
            ).alias("climbs"),
            F.element_at(F.element_at(levels, F.col("rise") + 1), 1).alias("hash"),
        ).withColumn(
            "climbs",
            F.transform(
                "climbs",
                lambda c: F.struct(
                    c["id"].alias("id"), c["row"].alias("row"), *_bytes_of(c["steps"])
                ),
            ),
        )
    )
    above_id = node_id(F.col("tree"), F.col("level"), F.col("block")).alias("id")
    no_row = F.lit(None).cast("long").alias("row")
    above = blocks.select(
        "tree", above_id, F.col("block").alias("at"), "hash", "n", "level", "span", no_row
    )
    links = blocks.select(above_id.alias("parent"), F.inline("climbs"))
    return above, links.select("id", "parent", "sides", "siblings", "row")


def _bytes_of(steps: Column) -> tuple[Column, Column]:
    """Steps in few bytes: ``sides`` has two digits a step, how many digests stand left and right, and
    ``siblings`` these digests one after another."""
    sides = F.transform(
        steps,
        lambda s: F.concat(
            *((F.length(s[side]) / DIGEST_DIGITS).cast("int").cast("string") for side in ("left", "right"))
        ),
    )
    digests = F.transform(steps, lambda s: F.concat(s["left"], s["right"]))
    return F.array_join(sides, "").alias("sides"), F.unhex(F.array_join(digests, "")).alias("siblings")


def tree_nodes(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Roots (tree, id, hash) of the trees whose lowest nodes are given, and tables of rows (id,
    parent, sides, siblings, row) that lead from every node to its root.

    A table stands for several levels, as evenly as may be, so that its nodes have many parents. A
    tree of one node has no row: it is its own root.
    """
    levels = _levels(F.col("n"))
    rounds = F.ceil(levels / MOST_SPAN)
    span = F.greatest(F.ceil(levels / F.greatest(rounds, F.lit(1))), F.lit(1)).cast("int")
    todo = stored(nodes.withColumns({"level": F.lit(0), "span": span}))
    roots, links = [], []
    while True:
        roots.append(todo.filter("n = 1").select("tree", "id", "hash").repartition(1))
        todo = _gathered(todo.filter("n > 1"))
        if todo.isEmpty():
            break
        todo, linked = _climbed(todo)
        links.append(linked)
    found = roots[0]
    for more in roots[1:]:
        found = found.union(more)
    return stored(found.coalesce(1)), links


def _gathered(rows: DataFrame) -> DataFrame:
    """Few rows in one partition, which saves the shuffles of what follows; others as they are."""
    return rows.coalesce(1) if rows.limit(MOST_SENT + 1).count() <= MOST_SENT else rows


@dataclass(frozen=True)
class Manifest:
    """Tables ``subroots`` (tree, id, hash), ``leaves`` and ``nodes`` (id, parent, sides, siblings,
    row), which are the lowest and the higher nodes, and the hash of the root, which is None for an
    empty table.
    """

    subroots: DataFrame
    leaves: DataFrame
    nodes: DataFrame
    root: str | None


def manifest(rows: DataFrame) -> Manifest:
    """The manifest of the rows of :func:`leaves`. Rows of a tree are ordered by doc_id, equal ids
    by hash, so copies of a row give the same manifest in any order."""
    ordered = numbered(rows.select("tree", "doc_id", "leaf", "row"), ["doc_id", "leaf", "row"])
    leaf_id = node_id(F.col("tree"), F.lit(0), F.col("at")).alias("id")
    subroots, links = tree_nodes(
        ordered.select("tree", leaf_id, "at", F.col("leaf").alias("hash"), "n", "row")
    )
    over = subroots.select(F.lit(TOP).alias("tree"), F.col("tree").alias("name"), "id", "hash")
    top = numbered(over, ["name"]) if over.count() > MOST_SENT else _ranked(over.coalesce(1))
    root, more = tree_nodes(top.withColumn("row", F.lit(None).cast("long")).drop("name"))
    nothing = rows.sparkSession.createDataFrame([], NODES)
    nodes = nothing
    for linked in [*links[1:], *more]:
        nodes = nodes.union(linked)
    found = root.first()  # one row, or none for an empty table
    return Manifest(
        subroots, links[0] if links else nothing, stored(nodes), found["hash"] if found else None
    )


# A row holds the siblings that it takes next; behind the root there are none, and no place. Digests
# are hashed as hex text, and kept as bytes.
CLIMB = """
WITH RECURSIVE climb MAX RECURSION LEVEL 100 AS (
  SELECT doc_id, tree, leaf, place, sides, siblings, given AS folded, CAST('' AS BINARY) AS proof
  FROM {start}
  UNION ALL
  SELECT {hint} doc_id, tree, leaf, n.parent, n.sides, n.siblings, aggregate(
      sequence(0, CAST(length(c.sides) / 2 AS INT)), named_struct('h', folded, 'done', 0),
      (fold, k) -> if(k = 0, fold, named_struct(
        'h', sha2(concat(
          lower(hex(substring(c.siblings, 32 * fold.done + 1, 32 * int(substring(c.sides, 2 * k - 1, 1))))),
          fold.h,
          lower(hex(substring(c.siblings, 32 * (fold.done + int(substring(c.sides, 2 * k - 1, 1))) + 1,
            32 * int(substring(c.sides, 2 * k, 1)))))), 256),
        'done', fold.done + int(substring(c.sides, 2 * k - 1, 1)) + int(substring(c.sides, 2 * k, 1)))),
      fold -> fold.h),
    concat(proof, c.siblings)
  FROM climb c LEFT JOIN {nodes} n ON n.id = c.place WHERE c.place IS NOT NULL)
SELECT doc_id, tree, leaf, folded, sha2(lower(hex(proof)), 256) AS proof_sha256
FROM climb WHERE place IS NULL
"""


def climbed(rows: DataFrame, tree: Manifest) -> DataFrame:
    """(doc_id, tree, leaf, folded, proof_sha256) of every row of :func:`leaves`: the root that follows
    from the hash that was ``given`` and the siblings of the manifest, and the hash of these siblings.

    One recursive query takes all rows up together, each by its own chain of parents. A leaf brings
    its own node row; the higher ones are few, one for hundreds of rows, and sent to all tasks where
    their number allows it."""
    spark = rows.sparkSession
    # The leaf of a tree of one row is the root of that tree.
    alone = node_id(F.col("tree"), F.lit(0), F.lit(0))
    start = rows.join(
        tree.leaves.select("row", "parent", "sides", "siblings"), "row", "left"
    ).select(
        "doc_id",
        "tree",
        "leaf",
        F.coalesce("parent", alone).alias("place"),
        F.coalesce("sides", F.lit("")).alias("sides"),
        F.coalesce("siblings", F.lit(b"")).alias("siblings"),
        "given",
    )
    hint = "/*+ BROADCAST(n) */" if tree.nodes.count() <= MOST_SENT else ""
    before = spark.conf.get(RECURSION_ROWS, None)
    spark.conf.set(RECURSION_ROWS, "-1")  # any number of rows
    try:
        return stored(spark.sql(CLIMB.replace("{hint}", hint), start=start, nodes=tree.nodes))
    finally:
        if before is None:
            spark.conf.unset(RECURSION_ROWS)
        else:
            spark.conf.set(RECURSION_ROWS, before)


def verified(docs: DataFrame, changed: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row of ``docs``
    (doc_id, source, lang, n_chars, text), as a reader finds them who meets ``changed`` rows (by
    default those of :func:`tampered`).

    Null values have a mark of their own, so null and empty text differ. A null language has its
    own tree, which comes first. Repeated rows are leaves of their own with the same hash. A row
    without doc_id is a leaf before all others and is not tampered with; nor is one without
    ``n_chars``. A lone row is its own subroot and root, with an empty proof. An empty table gives
    no rows. Further columns are not read.
    """
    rows = leaves(docs, tampered() if changed is None else changed)
    tree = manifest(rows)
    subroots = tree.subroots.select("tree", F.col("hash").alias("subroot"))
    return (
        climbed(rows, tree)
        .join(subroots, "tree")
        .select(
            "doc_id",
            "leaf",
            "subroot",
            F.lit(tree.root).cast("string").alias("root"),
            "proof_sha256",
            F.col("folded").alias("folded_root"),
            (F.col("folded") == F.lit(tree.root)).alias("verified"),
        )
    )
