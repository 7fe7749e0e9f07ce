"""Merkle manifest of a dataset: one tree for each language, one over their roots.

JVM expressions only.  A leaf is the digest of a row; texts are never shuffled.
Leaves get their place by a range sort and the counts of its partitions, so no
language is gathered in one task.  Trees grow eight levels at a time from runs
of 256 neighbours.  Proofs come by pointer jumping: a node knows the siblings on
the way to the ancestor ``d`` levels above; joined with that ancestor's own
segment it knows them for ``2d``.  Only nodes at levels that are a multiple of
the distance are jumped from again, so a round joins the leaves and little else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot.llm.tables import keep, release

# Levels grown at a time, of runs of 2 ** STEP neighbours.
STEP = 8
# Bytes of a broadcast side, and what its row has besides digests.
BROADCAST_BYTES = 8 << 20
ROW_BYTES = 128
TAMPER_EVERY = 7


def _field(column: Column) -> Column:
    value = column.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value), F.lit(":"), value))


def leaf_digest(*columns: Column) -> Column:
    """Digest of the columns, each ``-`` if null, else ``bytes:value``."""
    return F.sha2(F.concat(*(_field(c) for c in columns)), 256)


def _if_small(table: DataFrame, row_bytes: int) -> DataFrame:
    return F.broadcast(table) if table.count() * row_bytes <= BROADCAST_BYTES else table


def _numbered(leaves: DataFrame, order: list[str]) -> tuple[DataFrame, list[DataFrame]]:
    """``leaves`` with ``idx`` (place in its ``tree`` by ``order``) and ``n``
    (leaves of the tree); and the kept tables it reads."""
    ranged = leaves.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    placed = keep(ranged.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), "leaves")
    # At most a row for each partition and tree.
    runs = placed.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    tree = Window.partitionBy("tree")
    before = F.sum("rows").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    runs = keep(
        runs.select("tree", "part", "first", F.coalesce(before, F.lit(0)).alias("before"), F.sum("rows").over(tree).alias("n")),
        "runs",
    )
    numbered = placed.join(_if_small(runs, ROW_BYTES), ["tree", "part"]).withColumn("idx", F.col("before") + F.col("at") - F.col("first"))
    return numbered.drop("part", "at", "first", "before"), [placed, runs]


def _height(n: Column) -> Column:
    """Levels above the leaves: the bits of n - 1."""
    return F.when(n <= 1, 0).otherwise(F.length(F.bin(n - 1))).cast("int")


def _nodes_at(n: Column, level: Column) -> Column:
    return F.call_function("shiftrightunsigned", n + F.call_function("shiftleft", F.lit(1).cast("long"), level) - 1, level)


def _shift(value: Column, by: Column | int) -> Column:
    return F.call_function("shiftrightunsigned", value, by if isinstance(by, Column) else F.lit(by))


def _above(level: Column) -> Column:
    """The level above, of a run of neighbours that starts at an even place."""
    pairs = F.sequence(F.lit(0), (F.size(level) - 1).cast("int"), F.lit(1))
    starts = F.filter(pairs, lambda k: k % 2 == 0)
    return F.transform(starts, lambda k: F.sha2(F.concat(F.get(level, k), F.coalesce(F.get(level, k + 1), F.lit(""))), 256))


def _grown(base: DataFrame, level: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes of the levels ``level`` to ``level + STEP - 1`` with their siblings,
    the nodes of the next base level, and the kept table of both.  ``base``:
    (tree, n, idx, digest, payload) of all nodes of ``level``."""
    left = F.greatest(F.col("height") - level, F.lit(0))
    runs = (
        base.groupBy("tree", "n", _shift(F.col("idx"), STEP).alias("run"))
        .agg(F.array_sort(F.collect_list(F.struct("idx", "digest", "payload"))).alias("members"))
        .withColumn("height", _height(F.col("n")))
        .withColumn("level_0", F.col("members.digest"))
    )
    for k in range(1, STEP + 1):
        grown = F.when(left >= k, _above(F.col(f"level_{k - 1}"))).otherwise(F.array().cast("array<string>"))
        runs = runs.withColumn(f"level_{k}", grown)
    runs = keep(runs, "subtrees")

    def nodes(k: int) -> Column:
        digests = F.col(f"level_{k}")
        first = F.call_function("shiftleft", F.col("run"), F.lit(STEP - k))
        return F.transform(
            digests,
            lambda digest, i: F.struct(
                F.lit(level + k).alias("level"), (first + i).alias("idx"), digest.alias("digest"),
                # The root has no sibling; the last node of a level may have none.
                F.unhex(F.when(left > k, F.get(digests, i.bitwiseXOR(F.lit(1))))).alias("sibling"),
                (F.get(F.col("members.payload"), i) if k == 0 else F.lit(None)).alias("payload"),
            ),
        )

    # Whole runs of a level above STEP levels are nodes of the next base.
    every = runs.select("tree", "n", "height", F.explode(F.concat(*(nodes(k) for k in range(STEP)))).alias("node"))
    inner = every.select("tree", "n", "height", "node.*")
    top = runs.where(F.size(f"level_{STEP}") > 0)
    next_base = top.select("tree", "n", F.col("run").alias("idx"), F.col(f"level_{STEP}")[0].alias("digest"))
    return inner, next_base, runs


def _jumped(nodes: DataFrame, distance: int) -> DataFrame:
    """Segments of twice the distance, of nodes at levels that are a multiple of it."""
    by = min(distance, 63)
    own = nodes.where(F.col("level") % (2 * distance) == 0).withColumns(
        {"to": F.col("level") + distance, "to_idx": _shift(F.col("idx"), by)}
    )
    ancestors = nodes.where(F.col("level") % (2 * distance) == distance).select(
        "tree", F.col("level").alias("to"), F.col("idx").alias("to_idx"), F.col("segment").alias("more")
    )
    joined = own.join(_if_small(ancestors, ROW_BYTES + 32 * distance), ["tree", "to", "to_idx"], "left")
    whole = F.concat("segment", F.coalesce("more", F.lit(b"")))
    return joined.withColumn("segment", whole).select(nodes.columns)


def _proofs(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((tree, n, idx, payload, segment) of each leaf, (tree, digest) of each
    root).  ``leaves``: (tree, n, idx, digest, payload).  A segment is the
    siblings' digests, 32 bytes each, from the leaf upwards."""
    parts, base, level, behind = [], leaves, 0, []
    highest = leaves.agg(F.max(_height(F.col("n")))).first()[0] or 0
    none = F.lit(None).cast(leaves.schema["payload"].dataType)
    while level <= highest:
        inner, next_base, runs = _grown(base, level)
        behind.append(runs)
        parts.append(inner.withColumn("payload", F.col("payload") if level == 0 else none))
        base, level = next_base.withColumn("payload", none), level + STEP
    nodes = parts[0]
    for part in parts[1:]:
        nodes = nodes.unionByName(part)
    roots = keep(nodes.where(F.col("level") == F.col("height")).select("tree", "digest"), "roots")
    nodes = keep(
        nodes.where((F.col("level") == 0) | (F.col("level") < F.col("height"))).select(
            "tree", "n", "height", "level", "idx", "payload", F.coalesce("sibling", F.lit(b"")).alias("segment")
        ),
        "nodes",
    )
    release(*behind)
    distance = 1
    while distance < highest:
        nodes, before = keep(_jumped(nodes, distance), "segments"), nodes
        release(before)
        distance *= 2
    return nodes.where("level = 0"), roots


def _folded(digest: Column, n: Column, idx: Column, segment: Column) -> Column:
    """The root that a leaf's digest and its siblings lead to."""
    state = "struct<digest:string,used:int>"

    def step(so_far: Column, level: Column) -> Column:
        place = _shift(idx, level)
        met = place.bitwiseXOR(F.lit(1)) < _nodes_at(n, level)
        sibling = F.when(met, F.lower(F.hex(F.substring(segment, so_far["used"] * 32 + 1, F.lit(32))))).otherwise(F.lit(""))
        both = F.when(place % 2 == 1, F.concat(sibling, so_far["digest"])).otherwise(F.concat(so_far["digest"], sibling))
        return F.struct(F.sha2(both, 256).alias("digest"), (so_far["used"] + met.cast("int")).alias("used")).cast(state)

    first = F.struct(digest.alias("digest"), F.lit(0).alias("used")).cast(state)
    levels = F.sequence(F.lit(0), _height(n) - 1)
    return F.when(_height(n) == 0, digest).otherwise(F.aggregate(levels, first, step)["digest"])


def tampered(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % TAMPER_EVERY == 0, F.lit(False))


def manifest(documents: DataFrame, id_col: str = "doc_id", tree_col: str = "lang") -> DataFrame:
    """(doc_id, leaf, subroot, root, proof, proof_sha256, folded_root, verified)
    of each row.

    ``proof`` is the siblings' digests from the leaf through its language's
    subroot to the root, 32 bytes each.  Rows for which 7 divides crc32 of the
    id are checked with one added to ``n_chars``; null counts stay.

    Any column may be null (``-`` in the digest); null ids come first in their
    language and are never tampered with, a null language is a tree of its own
    and comes first.  Empty texts are texts.  Repeated rows are leaves of their
    own, side by side; rows of one id are ordered by their digest.  No rows, no
    result.  Columns other than the five of documents are ignored.
    """
    fields = lambda n_chars: [F.col(c) for c in (id_col, "source", "lang")] + [n_chars, F.col("text")]
    n_chars = F.col("n_chars").cast("long")
    other = F.when(tampered(id_col) & n_chars.isNotNull(), leaf_digest(*fields(n_chars + 1)))
    leaves = documents.select(
        F.coalesce(F.concat(F.lit("="), F.col(tree_col).cast("string")), F.lit("")).alias("tree"),
        F.col(id_col).alias("doc_id"), leaf_digest(*fields(n_chars)).alias("leaf"), F.unhex(other).alias("tampered"),
    )
    numbered, behind = _numbered(leaves, ["doc_id", "leaf"])
    payload = F.struct("doc_id", F.unhex("leaf").alias("leaf"), "tampered")
    own, subroots = _proofs(numbered.select("tree", "n", "idx", F.col("leaf").alias("digest"), payload.alias("payload")))
    release(*behind)

    whole = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("lang"), "digest")
    ranked, behind = _numbered(whole, ["lang"])
    upper, roots = _proofs(ranked.select("tree", "n", "idx", "digest", F.struct("lang", "digest").alias("payload")))
    release(*behind)
    upper = upper.join(F.broadcast(roots.select(F.col("digest").alias("root"))), F.lit(True), "left").select(
        F.col("payload.lang").alias("tree"), F.col("payload.digest").alias("subroot"), "root",
        F.col("n").alias("upper_n"), F.col("idx").alias("upper_idx"), F.col("segment").alias("upper_segment"),
    )
    upper = keep(upper, "upper")
    both = own.join(_if_small(upper, 4 * ROW_BYTES), "tree")
    proof = F.concat("segment", "upper_segment")
    leaf = F.lower(F.hex("payload.leaf"))
    shown = F.coalesce(F.lower(F.hex("payload.tampered")), leaf)
    subroot = _folded(shown, F.col("n"), F.col("idx"), F.col("segment"))
    folded = both.withColumn("folded_subroot", subroot).withColumn(
        "folded_root", _folded(F.col("folded_subroot"), F.col("upper_n"), F.col("upper_idx"), F.col("upper_segment"))
    )
    return folded.select(
        F.col("payload.doc_id").alias("doc_id"), leaf.alias("leaf"), "subroot", "root", proof.alias("proof"),
        F.sha2(F.lower(F.hex(proof)), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )
