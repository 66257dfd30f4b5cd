"""Prefix trie of conversations by the Euler-tour technique.

Every distinct sequence of first turns is a node, decided by 128-bit hashes; a node
is named by its smallest member and its depth.  Each node has an enter and an exit
arc; enter leads to the first child (or the own exit), exit to the next sibling (or
the parent's exit), children in the order of their names.  Nodes of one name's
conversation are a path, on which arcs that follow each other are first drawn
together to chains.  ``rank`` then ranks the list of chains: chains jump to the
next ruler (a random sixteenth of them), rulers are ranked by the same means until
few are left, and all others take their ruler's place.  Besides the places it adds
up leaves and saved tokens, so prefix sums at a node's enter and exit give the sums
of its subtree.

``rebuilt`` makes the conversations of the report; ``trie`` takes any (conv_id,
pos, h1, h2, n_bytes).  Texts are hashed where they are read and never shuffled.

Cases: rows without a conv_id take no part; a NULL role or text is empty; turns of
equal number (NULL counts as one) stand in the order of the hash of role and text,
so repeated rows are turns of their own; a conversation without turns ends in the
root; long texts are hashed as a whole; a list of members is hashed as a stream;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featloom.llm.common import stored

GROUP, SPREAD = 5, 9  # conversations of a group start alike; most turns they share, plus one
RULERS = 16  # one element in so many is a ruler
BASE = 2**17  # rulers that one task ranks; more are ranked through rulers of their own
IDS = 4096  # conversation ids in a piece of a list
NODE = ["depth", "k1", "k2"]


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, h1, h2, n_bytes): the turns by number, as hashes."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.xxhash64(F.lit(1), role, text).alias("h1"), F.xxhash64(F.lit(2), text, role).alias("h2"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    rows = rows.withColumn("base", base).repartition("base")
    order = Window.partitionBy("base", "conv_id").orderBy(F.col("turn").asc_nulls_first(), "h1", "h2")
    return rows.withColumn("pos", F.row_number().over(order) - 1).drop("turn")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id) of all conversations, and their turns (conv_id, pos, h1, h2, n_bytes) as the report rebuilds them."""
    rows = turns(conversations)
    share = (F.crc32(F.col("conv_id").cast("string")) % SPREAD).cast("int")
    turn = F.struct("pos", "h1", "h2", "n_bytes")
    heads = rows.where((F.col("conv_id") == F.col("base")) & (F.col("pos") < SPREAD - 1))
    heads = heads.groupBy("base").agg(F.array_sort(F.collect_list(turn)).alias("head"))
    each = rows.select("base", "conv_id").distinct()
    each = each.join(heads, "base", "left").withColumn("share", share)
    head = F.slice(F.coalesce("head", F.array().cast("array<struct<pos:int,h1:bigint,h2:bigint,n_bytes:bigint>>")), F.lit(1), F.col("share"))
    each = each.select("base", "conv_id", "share", head.alias("head"))
    first = each.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.pos", "t.h1", "t.h2", "t.n_bytes")
    own = rows.join(each.select("base", "conv_id", "share", F.size("head").alias("taken")), ["base", "conv_id"]).where("pos >= share")
    own = own.select("conv_id", (F.col("pos") - F.col("share") + F.col("taken")).alias("pos"), "h1", "h2", "n_bytes")
    return each.select("conv_id"), first.unionByName(own)


def prefixes(rows: DataFrame) -> DataFrame:
    """(conv_id, depth, k1, k2, up1, up2, n_bytes, length): the key of each prefix and of the one before it."""
    order = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("conv_id")
    keyed = rows.withColumns({"t1": F.xxhash64(F.lit(1), "pos", "h1", "h2"), "t2": F.xxhash64(F.lit(2), "pos", "h2", "h1")})
    keyed = keyed.withColumns({"k1": F.bit_xor("t1").over(order), "k2": F.bit_xor("t2").over(order), "length": F.count(F.lit(1)).over(whole)})
    depth = (F.col("pos") + 1).cast("long").alias("depth")
    up = [F.col(f"k{i}").bitwiseXOR(F.col(f"t{i}")).alias(f"up{i}") for i in (1, 2)]
    return keyed.select("conv_id", depth, "k1", "k2", *up, "n_bytes", "length")


def list_hashes(rows: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256) of the ascending conversation ids of each node.

    Ranges of (node, id) are first joined to pieces of some thousand ids, then a node's
    pieces stream through one hash.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for key, ids in groupby(zip(*(batch.column(c).to_pylist() for c in [*NODE, "conv_id"])), key=lambda r: r[:3]):
                ids = [r[3] for r in ids]
                made += [(*key, ids[a], ",".join(map(str, ids[a : a + IDS]))) for a in range(0, len(ids), IDS)]
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*made)], names=[*NODE, "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def out(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=[*NODE, "ends_sha256"])

        for batch in batches:
            done = []
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in [*NODE, "ids"])):
                if key != now:
                    if state is not None:
                        done.append((*now, state.hexdigest()))
                    now, state = key, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            if done:
                yield out(done)
        if state is not None:
            yield out([(*now, state.hexdigest())])

    node = "depth long, k1 long, k2 long"
    cut = rows.repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    cut = cut.select(*NODE, "conv_id").mapInArrow(pieces, f"{node}, first long, ids string")
    return cut.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(hashed, f"{node}, ends_sha256 string")


def named_nodes(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_bytes, ends_sha256) of every node, the root included."""
    keyed = stored(prefixes(rows), "prefixes")
    nodes = keyed.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("n_bytes").alias("n_bytes"),
        F.max("up1").alias("up1"), F.max("up2").alias("up2"),
    )
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    root = root.select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), "conv_id", "n_convs", zero.alias("n_bytes"))
    ends = keyed.where("depth = length").select("conv_id", *NODE)
    empty = convs.join(ends.select("conv_id"), "conv_id", "left_anti")
    ends = ends.unionByName(empty.select("conv_id", zero.alias("depth"), zero.alias("k1"), zero.alias("k2")))
    nodes = nodes.unionByName(root, allowMissingColumns=True)
    nodes = stored(nodes.join(list_hashes(ends), NODE, "left"), "nodes")
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("up1"), F.col("k2").alias("up2"), F.col("conv_id").alias("parent_conv_id"))
    none = F.sha2(F.lit(""), 256)
    named = nodes.join(above, ["depth", "up1", "up2"], "left")
    return named.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_bytes", F.coalesce("ends_sha256", none).alias("ends_sha256"))


def next_siblings(nodes: DataFrame) -> DataFrame:
    """``nodes`` with the name of the parent's next child, ``sibling``.

    Children stand in ranges of (parent, name), so a parent of very many is no single
    task; the next range's first row, one for each range, closes the gaps.
    """
    keys = ["depth", "parent_conv_id", "conv_id"]
    rows = nodes.repartitionByRange(*keys).withColumn("part", F.spark_partition_id())
    rows = stored(rows, "siblings")
    inside = Window.partitionBy("part").orderBy(*keys)
    following = F.struct("depth", "parent_conv_id", "conv_id")
    heads = rows.groupBy("part").agg(F.min(following).alias("head"))
    heads = heads.select("part", F.lead("head").over(Window.orderBy("part")).alias("after"))
    rows = rows.withColumn("then", F.lead(following).over(inside)).join(F.broadcast(heads), "part")
    then = F.coalesce("then", "after")
    same = (then["depth"] == F.col("depth")) & then["parent_conv_id"].eqNullSafe(F.col("parent_conv_id"))
    return rows.withColumn("sibling", F.when(same, then["conv_id"])).drop("part", "then", "after")


def arcs(nodes: DataFrame) -> DataFrame:
    """Enter and exit arcs in the order of their path, with chain and following arc.

    An arc's name is (conv_id, at): ``at`` is -1 for the entry of a path and the depth
    for an exit; ``next_conv`` and ``next_at`` name what follows the last arc of a chain.
    """
    own = (F.col("first_child") == F.col("conv_id")) & F.col("first_child").isNotNull()
    enter = F.struct(
        F.lit(True).alias("enter"), F.col("depth").alias("seq"), (F.col("n_children") == 0).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"), (own | F.col("first_child").isNull()).alias("on"),
        F.col("first_child").alias("next_conv"), F.lit(-1).cast("long").alias("next_at"),
    )
    up = F.col("parent_conv_id") == F.col("conv_id")
    to_sibling = F.col("sibling").isNotNull()
    leave = F.struct(
        F.lit(False).alias("enter"), (-F.col("depth") - 1).alias("seq"), F.lit(0).cast("long").alias("leaf"),
        F.lit(0).cast("long").alias("saved"), (~to_sibling & up).alias("on"),
        F.coalesce("sibling", "parent_conv_id").alias("next_conv"),
        F.when(to_sibling, F.lit(-1)).when(F.col("parent_conv_id").isNotNull(), F.col("depth") - 1).cast("long").alias("next_at"),
    )
    # enters by growing depth, then exits by falling depth: exits have negative numbers and come second
    rows = nodes.select("conv_id", "depth", F.explode(F.array(enter, leave)).alias("a")).select("conv_id", "depth", "a.*")
    path = Window.partitionBy("conv_id").orderBy(F.col("enter").desc(), "seq")
    before = F.coalesce(F.lag("on").over(path), F.lit(False))
    rows = rows.withColumn("starts", (~before).cast("int"))
    rows = rows.withColumn("chain", F.sum("starts").over(path.rowsBetween(Window.unboundedPreceding, 0)))
    inside = Window.partitionBy("conv_id", "chain").orderBy(F.col("enter").desc(), "seq").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    return rows.withColumns({
        "arcs_before": F.coalesce(F.count(F.lit(1)).over(inside), zero),
        "leaves_before": F.coalesce(F.sum("leaf").over(inside), zero),
        "saved_before": F.coalesce(F.sum("saved").over(inside), zero),
    })


SUMS = ["arcs", "leaves", "saved"]


def chains(rows: DataFrame) -> DataFrame:
    """The chains of ``arcs`` as a list: (conv_id, at, chain, next_conv, next_at) and what each sums up."""
    order = F.struct(~F.col("enter"), "seq")
    at = F.when(F.col("enter"), F.lit(-1)).otherwise(F.col("depth")).cast("long")
    return rows.groupBy("conv_id", "chain").agg(
        F.min_by(at, order).alias("at"), F.max_by("next_conv", order).alias("next_conv"), F.max_by("next_at", order).alias("next_at"),
        F.count(F.lit(1)).alias("arcs"), F.sum("leaf").alias("leaves"), F.sum("saved").alias("saved"),
    )


def _ranked_alone(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums from each element to the end of the list, for a list of at most ``BASE`` elements."""
    parts = [part for part in batches if len(part)]
    if not parts:
        return
    table = pd.concat(parts)
    by_name = {key: i for i, key in enumerate(zip(table["conv_id"], table["at"]))}
    follows = [by_name.get(key, -1) for key in zip(table["next_conv"], table["next_at"])]
    rest = [-1] * len(table)  # what stands before each
    for i, j in enumerate(follows):
        if j >= 0:
            rest[j] = i
    i, order = next(i for i, j in enumerate(follows) if j < 0), []
    while i >= 0:
        order.append(i)
        i = rest[i]
    yield table.iloc[order][["conv_id", "at", *SUMS]].assign(**{s: table[s].iloc[order].cumsum() for s in SUMS})


def rank(items: DataFrame, level: int = 0, base: int = BASE) -> DataFrame:
    """(conv_id, at, arcs, leaves, saved): sums of the list from each element to its end, itself included.

    ``items`` are (conv_id, at, next_conv, next_at) and the summands; the last has no next.
    """
    name, follows = ["conv_id", "at"], ["next_conv", "next_at"]

    def ruler(conv: Column, at: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(level), conv, at), F.lit(RULERS)) == 0

    done = F.col("next_conv").isNull() | ruler(F.col("next_conv"), F.col("next_at"))
    now = stored(items.select(*name, *follows, *SUMS).withColumn("done", done), "jumps")
    while not now.where("NOT done").isEmpty():
        ahead = now.select(*[F.col(c).alias(f"a_{c}") for c in now.columns])
        here = [F.col("next_conv") == F.col("a_conv_id"), F.col("next_at") == F.col("a_at")]
        jumped = now.where("NOT done").join(ahead, here).select(
            *name, *[F.col(f"a_{c}").alias(c) for c in follows], *[(F.col(s) + F.col(f"a_{s}")).alias(s) for s in SUMS],
            F.col("a_done").alias("done"),
        )
        now = stored(now.where("done").unionByName(jumped), "jumps")
    rulers = stored(now.where(ruler(F.col("conv_id"), F.col("at"))).drop("done"), "rulers")
    schema = "conv_id long, at long, arcs long, leaves long, saved long"
    if rulers.count() > base:
        ranked = rank(rulers, level + 1, base)
    else:
        ranked = stored(rulers.coalesce(1).mapInPandas(_ranked_alone, schema), "ranked")
    ranked = ranked.select(F.col("conv_id").alias("next_conv"), F.col("at").alias("next_at"), *[F.col(s).alias(f"r_{s}") for s in SUMS])
    sums = [(F.col(s) + F.coalesce(f"r_{s}", F.lit(0))).alias(s) for s in SUMS]
    return now.join(ranked, follows, "left").select(*name, *sums)


def trie(convs: DataFrame, rows: DataFrame, base: int = BASE) -> DataFrame:
    """The nodes, with their children and the nodes, leaves and saved tokens of their subtrees."""
    nodes = stored(named_nodes(convs, rows), "named")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent_conv_id").alias("conv_id")).agg(
        F.count(F.lit(1)).alias("n_children"), F.min("conv_id").alias("first_child")
    )
    nodes = next_siblings(nodes).join(children, ["conv_id", "depth"], "left")
    nodes = stored(nodes.withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "linked")
    tour = stored(arcs(nodes), "arcs")
    listed = stored(chains(tour), "chains")
    ranked = rank(listed, base=base).join(listed.select("conv_id", "at", "chain"), ["conv_id", "at"])
    ranked = ranked.select("conv_id", "chain", *[F.col(s).alias(f"to_end_{s}") for s in SUMS])
    placed = tour.join(ranked, ["conv_id", "chain"])
    sums = {s: F.col(f"to_end_{s}") - F.col(f"{s}_before") for s in SUMS}

    def at(which: str, total: Column) -> Column:
        return F.max(F.when(F.col("enter") == F.lit(which == "enter"), total))

    subtrees = placed.groupBy("conv_id", "depth").agg(
        ((at("enter", sums["arcs"]) - at("exit", sums["arcs"]) + 1) / 2).cast("long").alias("n_nodes"),
        (at("enter", sums["leaves"]) - at("exit", sums["leaves"])).alias("n_leaves"),
        (at("enter", sums["saved"]) - at("exit", sums["saved"])).alias("saved_tokens"),
    )
    found = nodes.join(subtrees, ["conv_id", "depth"])
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "n_nodes")


def report(conversations: DataFrame) -> DataFrame:
    convs, rows = rebuilt(conversations)
    return trie(stored(convs, "conversations"), stored(rows, "turns"))


# fixed value: the polynomial of crc32
CRC_SQL = """xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(s) + 1), lambda i: CAST(ascii(s[i]) AS BIGINT))),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda u, k: xor(u >> 1, (u & 1) * 3988292384))), 4294967295)"""
SQL = f"""WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS txt, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
word AS (SELECT *, dense_rank() OVER (ORDER BY role, txt) AS tid, strlen(txt) AS n FROM t),
conv AS (SELECT conv_id, conv_id - conv_id % {GROUP} AS base, {CRC_SQL} % {SPREAD} AS h FROM (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS s FROM t)),
sized AS (SELECT conv.*, least(h, coalesce(m, 0)) AS k FROM conv LEFT JOIN (SELECT conv_id AS base, count(*) AS m FROM t GROUP BY 1) USING (base)),
rebuilt AS (
  SELECT c.conv_id, w.pos, tid, n FROM sized c JOIN word w ON w.conv_id = c.base AND w.pos < c.h
  UNION ALL SELECT c.conv_id, w.pos - c.h + c.k, tid, n FROM sized c JOIN word w ON w.conv_id = c.conv_id AND w.pos >= c.h),
step AS (SELECT conv_id, pos + 1 AS depth, n, list(tid) OVER (PARTITION BY conv_id ORDER BY pos) AS path, count(*) OVER (PARTITION BY conv_id) AS last FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, CAST([] AS BIGINT[]), coalesce(l, 0) FROM conv LEFT JOIN (SELECT conv_id, count(*) AS l FROM rebuilt GROUP BY 1) USING (conv_id)),
node AS MATERIALIZED (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(n) AS n,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE depth = last), '')) AS ends_sha256
  FROM step GROUP BY path, depth),
linked AS MATERIALIZED (SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n, c.ends_sha256, c.path
  FROM node c LEFT JOIN node p ON c.depth > 0 AND p.depth = c.depth - 1 AND p.path = c.path[1:c.depth - 1]),
child AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS m FROM linked WHERE depth > 0 GROUP BY 1, 2),
worth AS (SELECT l.*, coalesce(m, 0) AS n_children, (n_convs - 1) * n AS saved FROM linked l LEFT JOIN child USING (conv_id, depth)),
above AS (SELECT conv_id, depth, saved, n_children, path[1:e] AS path FROM (SELECT *, unnest(range(depth + 1)) AS e FROM worth)),
sums AS (SELECT path, CAST(count(*) FILTER (WHERE n_children = 0) AS BIGINT) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens, count(*) AS n_nodes FROM above GROUP BY path)
SELECT conv_id, CAST(depth AS BIGINT) AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, n_nodes FROM worth JOIN sums USING (path)"""
