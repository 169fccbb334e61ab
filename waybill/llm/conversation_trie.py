"""A trie of conversations: every distinct beginning of a conversation is a node, all counted by ROLLUP.

A conversation is laid out in blocks of ``WIDTH`` positional columns of turn ids. One ``GROUP BY block, ROLLUP (t1, ..., tWIDTH)``
over the blocks of all conversations aggregates all beginnings together; ``grouping_id()`` tells how deep a group is. A longer
conversation continues in further blocks, keyed by the node that ends the block before: the exclusive or, over the turns so far,
of two 64-bit hashes of turn id and position. So blocks need no order, and there is no loop over the depth.

What a node says of the whole tree below it is a sum over the conversations that begin with it, so a second ROLLUP yields it:

* a node is *owned* by its smallest conversation. A conversation owns the nodes of its path from one depth on (``since``), as
  each node has fewer members than its parent. The first ROLLUP finds ``since``;
* a node's leaves are the members that own a leaf; its children the members that own a node one turn deeper; the bytes spared
  below it are those of each member's turns that the member does not own.

A turn id is 128 bits of a SHA-256 of role and text, with the text's bytes counted. No text is shuffled. Hot beginnings are combined
before the exchange. The ids that end at a node are sorted over all tasks and reach their node as pieces of text, in order.

Null roles and texts are empty. Turns are ordered by turn, null first, then by id; a row repeated exactly is a turn again. Rows
without a conversation id belong to no conversation and are left out. An empty table has no node, not even a root. Other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import written

WIDTH = 4  # turns in a block: a ROLLUP makes WIDTH + 1 rows of each block
NOTHING = hashlib.sha256(b"").hexdigest()
_KEY = ["k1", "k2", "depth"]


def turn_ids(rows: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, place, id) of every turn, place counting from 1; id: hash and bytes of the text."""
    role, text = (F.coalesce(rows[c], F.lit("")) for c in (role_col, text_col))
    spelled = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    ident = F.struct(F.unhex(F.substring(F.sha2(spelled, 256), 1, 32)).alias("hash"), F.octet_length(text).cast("bigint").alias("bytes"))
    turns = rows.where(rows[conv_col].isNotNull()).select(rows[conv_col].alias("conv_id"), rows[turn_col].alias("turn"), ident.alias("id"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "id.hash")
    return turns.select("conv_id", F.row_number().over(order).cast("bigint").alias("place"), "id")


def with_heads(turns: DataFrame, head_of: Column, most: int, length: Column) -> DataFrame:
    """The turns with each conversation's first ``length`` (at most ``most``) taken from the conversation ``head_of``.

    Both columns are over ``conv_id``. A conversation that has no turn left keeps one row without place and id.
    """
    turns = written(turns, "turns")
    convs = turns.where("place = 1").select("conv_id", head_of.alias("head"), length.alias("length"))
    heads = turns.where(F.col("place") <= most).select(F.col("conv_id").alias("head"), "place", "id")
    head = convs.join(heads, "head").where("place <= length").select("conv_id", "place", "id")
    rest = turns.where(F.col("place") > length).select("conv_id", (F.col("place") + most).alias("place"), "id")
    none = F.lit(None).cast(turns.schema["id"].dataType)
    return head.unionByName(rest).unionByName(convs.select("conv_id", F.lit(None).cast("bigint").alias("place"), none.alias("id")))


def _mark(ident: str, depth: Column, seed: int) -> Column:
    """What a turn at that depth adds to the key of its node."""
    return F.when(F.col(ident).isNotNull(), F.xxhash64(F.col(f"{ident}.hash"), depth, F.lit(seed))).otherwise(F.lit(0).cast("bigint"))


def _laid_out(turns: DataFrame) -> DataFrame:
    """Rows that begin a block, with its columns, and rows that end a conversation, from (conv_id, place, id)."""
    # a first row without a turn stands for the root
    roots = turns.select("conv_id").distinct().select("conv_id", F.lit(0).alias("place"), F.lit(None).cast(turns.schema["id"].dataType).alias("id"))
    rows = turns.where("id is not null").unionByName(roots)
    path = Window.partitionBy("conv_id").orderBy("place")
    so_far, whole = path.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy("conv_id")
    rows = rows.withColumn("depth", (F.row_number().over(path) - 1).cast("bigint"))
    rows = rows.withColumn("m1", _mark("id", F.col("depth"), 1)).withColumn("m2", _mark("id", F.col("depth"), 2))
    size = F.coalesce("id.bytes", F.lit(0).cast("bigint"))
    rows = rows.select(
        "conv_id", "depth", F.bit_xor("m1").over(so_far).alias("k1"), F.bit_xor("m2").over(so_far).alias("k2"),
        *[F.lead("id", k).over(path).alias(f"t{k}") for k in range(1, WIDTH + 1)],
        (F.sum(size).over(whole) - F.sum(size).over(so_far)).alias("bytes_left"), (F.count("*").over(whole) - 1).alias("last"),
    )
    return rows.where((F.col("depth") % WIDTH == 0) | (F.col("depth") == F.col("last")))


_LEVEL = f"({WIDTH} - bit_count(grouping_id()))"
_COLUMNS = ", ".join(f"t{k}" for k in range(1, WIDTH + 1))
_DEPTH = f"block + {_LEVEL}"
# a group is a node if its last column holds a turn; the root is the first block's group of no column
_IS_NODE = f"if({_LEVEL} = 0, block = 0, case " + " ".join(f"when {_LEVEL} = {k} then t{k} is not null" for k in range(1, WIDTH + 1)) + " end) AS is_node"
# bytes from the turn at the group's depth on
_LEFT = "bytes_left" + "".join(f" - if({_LEVEL} > {k}, t{k}.bytes, 0)" for k in range(1, WIDTH))


def _owners(blocks: DataFrame) -> DataFrame:
    """(conv_id, since, leaf): the depth from which a conversation owns its path, and whether it owns a leaf."""
    nodes = blocks.sparkSession.sql(
        f"""SELECT min(conv_id) AS conv_id, {_DEPTH} AS depth, sum(int(last > {_DEPTH})) = 0 AS leaf, {_IS_NODE}
        FROM {{blocks}} GROUP BY block, k1, k2, ROLLUP ({_COLUMNS})""", blocks=blocks)
    return nodes.where("is_node").groupBy("conv_id").agg(F.min("depth").alias("since"), F.max("leaf").alias("leaf"))


def _counted(blocks: DataFrame) -> DataFrame:
    """All nodes, with their keys and their parents', from blocks with ``since``, ``leaf`` and the bytes owned."""
    found = blocks.sparkSession.sql(
        f"""SELECT block, k1, k2, {_COLUMNS}, {_LEVEL} AS level, {_DEPTH} AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        sum(int(since <= {_DEPTH} + 1 AND {_DEPTH} < last)) AS n_children, sum(int(leaf)) AS n_leaves,
        sum(CASE WHEN since IS NULL THEN {_LEFT} WHEN since > {_DEPTH} THEN {_LEFT} - owned ELSE 0 END) AS saved_bytes,
        sum(if(since <= {_DEPTH}, since, 0)) AS since, {_IS_NODE}
        FROM {{blocks}} GROUP BY block, k1, k2, ROLLUP ({_COLUMNS})""", blocks=blocks)

    def key(seed: int, *, parent: bool) -> Column:
        out = F.col(f"k{seed}")
        for k in range(1, WIDTH + 1):
            mark = _mark(f"t{k}", (F.col("block") + k).cast("bigint"), seed)
            out = out.bitwiseXOR(F.when(F.col("level") == k, 0).otherwise(mark) if parent else mark)
        return out

    last_turn = F.coalesce(*[F.when(F.col("level") == k, F.col(f"t{k}.hash")) for k in range(1, WIDTH + 1)])
    return found.where("is_node").select(
        key(1, parent=False).alias("k1"), key(2, parent=False).alias("k2"), "depth",
        key(1, parent=True).alias("p1"), key(2, parent=True).alias("p2"), last_turn.alias("turn_hash"),
        "conv_id", "since", "n_convs", "n_children", "n_leaves", "saved_bytes",
    )


def _ids_digest(ends: DataFrame) -> DataFrame:
    """(k1, k2, depth, ends_sha256): the hash of a node's ids in order, comma-joined.

    The ids are sorted over all tasks. Each batch sends a node's run of ids on as one piece of text, and the task that has the node
    reads the pieces in order, holding one batch of them.
    """

    def runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
        keys = [batch.column(c).to_numpy() for c in _KEY]
        cuts = [i + 1 for i in range(batch.num_rows - 1) if any(k[i] != k[i + 1] for k in keys)]
        yield from zip([0, *cuts], [*cuts, batch.num_rows])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            spans = list(runs(batch))
            ids = pc.cast(batch.column("conv_id"), pa.string()).to_pylist()
            at = pa.array([a for a, _ in spans])
            yield pa.record_batch(
                [*(batch.column(c).take(at) for c in [*_KEY, "conv_id"]), pa.array([",".join(ids[a:b]) for a, b in spans])],
                names=[*_KEY, "first", "piece"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def row(key: tuple, digest: str) -> list:
            return [*key, digest]

        for batch in batches:
            out = []
            for *key, piece in zip(*(batch.column(c).to_pylist() for c in [*_KEY, "piece"])):
                if key == now:
                    state.update(b",")
                else:
                    if now is not None:
                        out.append(row(now, state.hexdigest()))
                    now, state = key, hashlib.sha256()
                state.update(piece.encode())
            yield table(out)
        if now is not None:
            yield table([row(now, state.hexdigest())])

    def table(rows: list) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        return pa.record_batch([pa.array([r[i] for r in rows], kinds[i]) for i in range(4)], names=[*_KEY, "ends_sha256"])

    key = "k1 bigint, k2 bigint, depth bigint"
    cut = ends.orderBy(*_KEY, "conv_id").mapInArrow(pieces, f"{key}, first bigint, piece string")
    return cut.repartition(*_KEY).sortWithinPartitions(*_KEY, "first").mapInArrow(digests, f"{key}, ends_sha256 string")


def prefix_nodes(turns: DataFrame) -> DataFrame:
    """One row per node, from (conv_id, place, id), places in any order and with gaps.

    conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_bytes (over its subtree, of every
    text the bytes that its node's further members repeat), ends_sha256 and turn_hash, see ``spelled``.
    """
    rows = written(_laid_out(turns), "trie-rows")
    blocks = rows.where((F.col("depth") % WIDTH == 0) & ((F.col("depth") == 0) | F.col("t1").isNotNull()))
    blocks = blocks.withColumnRenamed("depth", "block")
    owned = blocks.join(_owners(blocks.drop("bytes_left")), "conv_id", "left")
    # bytes from the first owned turn on, found in the block that holds it
    at = F.col("since") - F.col("block")
    left = F.col("bytes_left")
    here = F.when((at <= 1) & (at >= F.when(F.col("block") == 0, 0).otherwise(1)), left)
    for k in range(1, WIDTH):
        left = left - F.coalesce(f"t{k}.bytes", F.lit(0))
        here = here.when(at == k + 1, left)
    owned = owned.withColumn("owned", F.max(here).over(Window.partitionBy("conv_id")))
    nodes = written(_counted(owned), "trie-nodes")
    ends = _ids_digest(rows.where("depth = last").select(*_KEY, "conv_id"))
    full = nodes.join(ends, _KEY, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING)))
    # the parent of the first node that a conversation owns is another's; of the others it is its own
    parents = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"))
    branch = (F.col("depth") > 0) & (F.col("since") == F.col("depth"))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_bytes", "ends_sha256", "turn_hash"]
    inner = full.where(~branch).withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.col("conv_id")))
    return inner.select(*out).unionByName(full.where(branch).join(parents, ["p1", "p2", "depth"]).select(*out))


def spelled(nodes: DataFrame, rows: DataFrame, *, role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The nodes with role and text of their last turn; null at the root."""
    role, text = (F.coalesce(rows[c], F.lit("")) for c in (role_col, text_col))
    hashed = F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))
    turns = rows.select(hashed.alias("turn_hash"), role.alias("role"), text.alias("text")).dropDuplicates(["turn_hash"])
    return nodes.join(turns, "turn_hash", "left")
