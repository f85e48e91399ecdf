"""Prefix trie of conversations, built as a burst trie.

Sequences of turns meet in a trie. Its upper part, the heads, are the prefixes
under which more than ``CONTAINER`` turns lie; below them the rest of each
conversation waits in a container, one for each next turn of a head. A container
that is larger bursts by its next turn, and so on down. How much lies under every prefix
is one aggregate, so all bursts happen in the same round, not one job a level.

Containers are bounded. Their suffixes are sorted and swept into nodes: neighbours
in that order share the longest beginnings, so a stack of open nodes suffices.

Heads may have any number of members and are never gathered: all that is asked of a
node is a sum over its members. A node is owned by its smallest member;
members only get fewer on the way down, so a conversation owns the end of its path
from some depth on. What is to be counted once per node is therefore counted at the
owner, and sums over a subtree need no walk through the trie.

A turn is known by two 64-bit hashes of role and text, a prefix by the exclusive-or
of its turns' hashes with their depths, so prefixes come from a running aggregate. It
runs in slices of ``SLICE`` turns, which are put together by their totals: a conversation that
holds a third of the table is no task of its own. The list of members that end in
a node is hashed in the order of ids; ids are first sorted over all tasks and packed
into pieces of text.

Defined cases: null role or text is empty. A null turn number comes first; turns with
equal numbers are ordered by hashes of their role and text. Repeated rows are turns of their own.
Rows without a conversation id belong to no conversation and are left out. Very long texts only count
their characters. An empty table gives no nodes, as the root has no member. Other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import joined, table, whole, whole_groups
from tidemark.llm.registry import query
from tidemark.operators.scale import attach, running_totals
from tidemark.session import materialise, store

CONTAINER = 50_000  # turns
SLICE = 4096  # turns of a conversation that are summed at a time
PIECE = 1 << 16  # characters of a piece of a list of ids
_NO_TURN = -(1 << 63)
_NODE = (
    "pa bigint, pb bigint, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
    "n_leaves bigint, saved_tokens bigint, ends_sha256 string, top boolean, chars_below bigint"
)


def sequences(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, depth (from 1), ha and hb (hashes of role and text) and chars of every turn of a conversation with an id."""
    number = F.col(f"`{turn}`").cast("long")
    r, t = whole(F.col(f"`{role}`")), whole(F.col(f"`{text}`"))
    rows = turns.select(
        F.col(f"`{conv}`").cast("long").alias("conv"), number.isNotNull().alias("numbered"), F.coalesce(number, F.lit(_NO_TURN)).alias("turn"),
        F.xxhash64(r, t).alias("ha"), F.xxhash64(t, F.lit(1), r).alias("hb"), F.length(t).cast("long").alias("chars"),
        F.monotonically_increasing_id().alias("tie"), F.lit(1).cast("long").alias("one"),
    )
    cells = store(rows.filter(F.col("conv").isNotNull()), "turns")
    ordered = running_totals(cells, ["conv"], ["numbered", "turn", "ha", "hb", "tie"], "one")
    return ordered.select("conv", (F.col("before") + 1).alias("depth"), "ha", "hb", "chars")


# -- prefixes ------------------------------------------------------------------

_SUMS = {"pa": lambda: F.bit_xor("a"), "pb": lambda: F.bit_xor("b"), "cum": lambda: F.sum("chars")}


def _prefixes(turns: DataFrame, slice_turns: int) -> DataFrame:
    """conv, depth, chars, a and b (of the turn there), pa and pb (of the prefix), cum (characters up to there), len and total."""
    at = turns.select(
        "conv", "depth", "chars", F.xxhash64("ha", "hb", "depth").alias("a"), F.xxhash64("hb", "depth", "ha").alias("b"),
        F.floor((F.col("depth") - 1) / slice_turns).alias("slice"),
    )
    whole_convs = store(turns.groupBy("conv").agg(F.max("depth").alias("len"), F.sum("chars").alias("total"), F.count(F.lit(1)).alias("n")), "convs")
    inside = Window.partitionBy("conv", "slice").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    run = at.withColumns({c: f().over(inside) for c, f in _SUMS.items()})
    if (whole_convs.df.agg(F.max("len")).first()[0] or 0) > slice_turns:
        totals = at.groupBy("conv", "slice").agg(*[f().alias(c) for c, f in _SUMS.items()])
        before = Window.partitionBy("conv").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
        fold = {"pa": F.bit_xor, "pb": F.bit_xor, "cum": F.sum}
        offsets = totals.select(F.col("conv").alias("_c"), F.col("slice").alias("_s"), *[F.coalesce(f(c).over(before), F.lit(0)).alias(f"_{c}") for c, f in fold.items()])
        offsets = store(offsets.filter("_s > 0"), "offsets")
        run = joined(run, offsets, (F.col("conv") == F.col("_c")) & (F.col("slice") == F.col("_s")), "left")
        zero = {c: F.coalesce(f"_{c}", F.lit(0)) for c in fold}
        run = run.withColumns({"pa": F.col("pa").bitwiseXOR(zero["pa"]), "pb": F.col("pb").bitwiseXOR(zero["pb"]), "cum": F.col("cum") + zero["cum"]})
    return attach(run.drop("slice", *[c for c in run.columns if c.startswith("_")]), whole_convs, ["conv"], "n")


# -- containers ----------------------------------------------------------------


class Node:
    __slots__ = ("above", "below", "chars", "children", "depth", "ends", "first", "key", "leaves", "n", "saved")

    def __init__(self, key: tuple[int, int], depth: int, chars: int, above: Node | None) -> None:
        self.key, self.depth, self.chars, self.above = key, depth, chars, above
        self.n = self.children = self.leaves = self.saved = self.below = 0
        self.first: int | None = None
        self.ends: list[int] = []


def sweep(suffixes: list[tuple[list[tuple[int, int]], list[int], int]], depth: int) -> list[Node]:
    """The nodes of a container, from its suffixes: prefix keys and characters turn by turn, and the conversation.

    The first turn of a suffix stands at ``depth``.
    """
    nodes: list[Node] = []
    path: list[Node] = []

    def close(down_to: int) -> None:
        while len(path) > down_to:
            node = path.pop()
            node.n += len(node.ends)
            own = min(node.ends, default=None)
            node.first = own if node.first is None else node.first if own is None else min(own, node.first)
            node.leaves = node.leaves or 1
            node.saved += (node.n - 1) * node.chars
            node.below += node.chars
            if path:
                up = path[-1]
                up.n, up.children, up.leaves = up.n + node.n, up.children + 1, up.leaves + node.leaves
                up.saved, up.below = up.saved + node.saved, up.below + node.below
                up.first = node.first if up.first is None else min(up.first, node.first)

    for keys, chars, conv in sorted(suffixes):
        shared = 0
        while shared < len(path) and shared < len(keys) and path[shared].key == keys[shared]:
            shared += 1
        close(shared)
        for k in range(shared, len(keys)):
            path.append(Node(keys[k], depth + k, chars[k], path[-1] if path else None))
            nodes.append(path[-1])
        path[-1].ends.append(conv)
    close(0)
    return nodes


def ends_hash(ids: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()


def _swept(rows: pd.DataFrame, first: np.ndarray) -> pd.DataFrame:
    conv, depth, pa, pb, chars = (rows[c].tolist() for c in ("conv", "depth", "pa", "pb", "chars"))
    out = []
    for a, b in zip(first, [*first[1:], len(rows)]):
        suffixes: list[tuple[list[tuple[int, int]], list[int], int]] = []
        for i in range(a, b):
            if i == a or conv[i] != conv[i - 1]:
                suffixes.append(([], [], conv[i]))
            suffixes[-1][0].append((pa[i], pb[i]))
            suffixes[-1][1].append(chars[i])
        for n in sweep(suffixes, depth[a]):
            parent = n.above.first if n.above else 0
            out.append((*n.key, n.first, n.depth, parent, n.n, n.children, n.leaves, n.saved, ends_hash(n.ends), n.above is None, n.below))
    return pd.DataFrame(out, columns=[c.split()[0] for c in _NODE.split(", ")])


# -- heads ---------------------------------------------------------------------


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted (pa, pb, conv) as pieces of text of neighbouring conversations of a node."""
    held: tuple | None = None  # pa, pb, first conversation, ids
    for batch in batches:
        out = []
        for pa, pb, conv in zip(*(batch[c].tolist() for c in ("pa", "pb", "conv"))):
            if held is not None and held[:2] == (pa, pb) and len(held[3]) < PIECE // 8:
                held[3].append(str(conv))
                continue
            if held is not None:
                out.append((*held[:3], ",".join(held[3])))
            held = (pa, pb, conv, [str(conv)])
        if out:
            yield pd.DataFrame(out, columns=["pa", "pb", "conv", "ids"])
    if held is not None:
        yield pd.DataFrame([(*held[:3], ",".join(held[3]))], columns=["pa", "pb", "conv", "ids"])


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One hash per node, of its pieces in their order."""
    now, sha = None, None
    for batch in batches:
        out = []
        for pa, pb, ids in zip(*(batch[c].tolist() for c in ("pa", "pb", "ids"))):
            if now == (pa, pb):
                sha.update(b"," + ids.encode())
                continue
            if now is not None:
                out.append((*now, sha.hexdigest()))
            now, sha = (pa, pb), hashlib.sha256(ids.encode())
        if out:
            yield pd.DataFrame(out, columns=["pa", "pb", "ends_sha256"])
    if now is not None:
        yield pd.DataFrame([(*now, sha.hexdigest())], columns=["pa", "pb", "ends_sha256"])


def _ends(rows: DataFrame) -> DataFrame:
    """pa, pb and the hash of the conversations of each node."""
    dealt = rows.repartitionByRange("pa", "pb", "conv").sortWithinPartitions("pa", "pb", "conv")
    pieces = materialise(dealt.mapInPandas(_packed, "pa bigint, pb bigint, conv bigint, ids string"), "ends")
    together = pieces.repartition("pa", "pb").sortWithinPartitions("pa", "pb", "conv")
    return together.mapInPandas(_hashed, "pa bigint, pb bigint, ends_sha256 string")


def _same(a: str = "", b: str = "_"):
    return (F.col(f"{a}pa") == F.col(f"{b}pa")) & (F.col(f"{a}pb") == F.col(f"{b}pb"))


def nodes(turns: DataFrame, convs: DataFrame, container: int = CONTAINER, slice_turns: int = SLICE) -> DataFrame:
    """The nodes of the trie of all conversations in ``convs`` (conv), whose turns are as ``sequences`` has them.

    conv_id, the smallest member; depth; parent_conv_id; n_convs; n_children; n_leaves and saved_tokens of the subtree; and
    ends_sha256, the hash of the members that end here.
    """
    # The root is the prefix of depth 0 of every conversation.
    root = convs.select(
        "conv", *[F.lit(0).cast("long").alias(c) for c in ("depth", "chars", "a", "b", "pa", "pb", "cum")]
    )
    paths = materialise(_prefixes(turns, slice_turns), "paths")
    sizes = paths.groupBy("pa", "pb").agg(F.sum(F.col("len") - F.col("depth") + 1).alias("size")).filter(F.col("size") > container)
    burst = store(sizes.select(F.col("pa").alias("_pa"), F.col("pb").alias("_pb")), "burst")
    marked = materialise(joined(paths, burst, _same(), "left").withColumn("head", F.col("_pa").isNotNull()).drop("_pa", "_pb"), "marked")

    # Below the heads: one container for each first turn there.
    below = marked.filter(~F.col("head"))
    start = F.min(F.struct("depth", "pa", "pb", F.col("pa").bitwiseXOR(F.col("a")).alias("ua"), F.col("pb").bitwiseXOR(F.col("b")).alias("ub"))).alias("s")
    starts = below.groupBy("conv").agg(start, F.count(F.lit(1)).alias("n"))
    starts = store(starts.select("conv", F.col("s.pa").alias("ca"), F.col("s.pb").alias("cb"), F.col("s.ua").alias("ua"), F.col("s.ub").alias("ub"), "n"), "starts")
    held = attach(below.select("conv", "depth", "pa", "pb", "chars"), starts, ["conv"], "n")
    swept = materialise(whole_groups(held.drop("ua", "ub"), ["ca", "cb"], _swept, _NODE, order=["conv", "depth"]), "swept")
    tops = swept.filter("top")
    above = starts.df.groupBy("ca", "cb").agg(F.min(F.struct("ua", "ub")).alias("u")).select(
        F.col("ca").alias("_pa"), F.col("cb").alias("_pb"), F.col("u.ua").alias("ua"), F.col("u.ub").alias("ub")
    )
    tops = materialise(joined(tops, store(above, "above"), _same()).drop("_pa", "_pb"), "tops")

    # Heads: first what each is, then who owns it.
    members = marked.filter("head").select("conv", "depth", "chars", "a", "b", "pa", "pb", "cum").unionByName(root)
    up = F.min(F.struct(F.col("pa").bitwiseXOR(F.col("a")).alias("ua"), F.col("pb").bitwiseXOR(F.col("b")).alias("ub"))).alias("up")
    heads = members.groupBy("pa", "pb").agg(F.min("conv").alias("first"), F.max("depth").alias("depth"), F.count(F.lit(1)).alias("n_convs"), up)
    heads = store(heads.select("pa", "pb", "first", "depth", "n_convs", F.col("up.ua").alias("ua"), F.col("up.ub").alias("ub")), "heads")
    children = heads.df.filter("depth > 0").select("ua", "ub").unionByName(tops.select("ua", "ub")).groupBy("ua", "ub").agg(F.count(F.lit(1)).alias("n_children"))
    grown = heads.df.drop("ua", "ub").join(children.withColumnsRenamed({"ua": "_pa", "ub": "_pb"}), _same(), "left").drop("_pa", "_pb")
    known = store(grown.withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long")), "known")

    named = store(known.df.select(F.col("pa").alias("_pa"), F.col("pb").alias("_pb"), "first", "n_children"), "named")
    owned = materialise(joined(members, named, _same()).withColumn("owner", F.col("conv") == F.col("first")).drop("_pa", "_pb", "first"), "members")
    before = F.col("cum") - F.col("chars")
    per_conv = owned.groupBy("conv").agg(
        F.min(F.when(F.col("owner"), F.col("depth"))).alias("own_from"),
        F.max("cum").alias("cum_heads"),
        F.min(F.when(F.col("owner"), before)).alias("before_own"),
        F.sum(F.when(F.col("owner") & (F.col("n_children") == 0), 1).otherwise(0)).alias("leaf_heads"),
        F.max("depth").alias("cut"),
        F.count(F.lit(1)).alias("n"),
    )
    contained = tops.select(F.col("conv_id").alias("conv"), "chars_below", F.col("n_leaves").alias("leaves_below"))
    totals = turns.groupBy("conv").agg(F.max("depth").alias("len"), F.sum("chars").alias("total"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    facts = per_conv.join(contained, "conv", "left").join(totals, "conv", "left").select(
        "conv", "own_from", "cum_heads", "before_own", "leaf_heads", "cut", *map(zero, ("chars_below", "leaves_below", "len", "total")), "n"
    )
    facts = store(facts, "facts")
    row = attach(owned, facts, ["conv"], "n")
    # Characters that the conversation owns from here on: of heads, and of its container.
    mine = F.when(F.col("own_from").isNull(), 0).otherwise(F.col("cum_heads") - F.when(F.col("depth") >= F.col("own_from"), before).otherwise(F.col("before_own")))
    summed = row.groupBy("pa", "pb").agg(
        F.sum(F.col("total") - before - mine - F.col("chars_below")).alias("saved_tokens"),
        F.sum(F.col("leaf_heads") + F.col("leaves_below")).alias("n_leaves"),
    )
    here = row.filter((F.col("len") == F.col("depth"))).select("pa", "pb", "conv")
    second = lambda df, *cols: df.select(F.col("pa").alias("_pa"), F.col("pb").alias("_pb"), *cols)
    upper = known.df.join(second(summed, "saved_tokens", "n_leaves"), _same()).drop("_pa", "_pb")
    upper = upper.join(second(_ends(here), "ends_sha256"), _same(), "left").drop("_pa", "_pb")
    links = heads.df.select(F.col("pa").alias("_pa"), F.col("pb").alias("_pb"), "ua", "ub")
    upper = upper.join(links, _same()).drop("_pa", "_pb")

    # Parents of heads and of the tops of containers are heads.
    parents = store(known.df.select(F.col("pa").alias("_pa"), F.col("pb").alias("_pb"), F.col("first").alias("parent")), "parents")
    to_parent = (F.col("ua") == F.col("_pa")) & (F.col("ub") == F.col("_pb"))
    result = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    of_heads = joined(upper, parents, to_parent, "left").select(
        F.col("first").alias("conv_id"), "depth", F.when(F.col("depth") > 0, F.col("parent")).alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(ends_hash([]))).alias("ends_sha256"),
    )
    of_tops = joined(tops.drop("parent_conv_id"), parents, to_parent, "left").withColumnRenamed("parent", "parent_conv_id")
    return of_heads.unionByName(of_tops.select(*result)).unionByName(swept.filter("NOT top").select(*result))


# -- the query -----------------------------------------------------------------


def rebuilt(turns: DataFrame, convs: DataFrame, most: int = 5, group: int = 100) -> DataFrame:
    """Each conversation c begins with the first h turns of conversation c - c % group, h = crc32(c) % (most + 1), instead of its own."""
    first = F.crc32(F.col("conv").cast("string").cast("binary")) % (most + 1)
    base = F.col("conv") - F.col("conv") % group
    rows = turns.withColumns({"h": first, "base": base})
    is_base = F.col("conv") == F.col("base")
    # Of each base: how many turns it can lend, and these; at most ``most``.
    lent = rows.groupBy("base").agg(
        F.sum(F.when(is_base & (F.col("depth") <= most), 1).otherwise(0)).alias("lends"), F.count(F.lit(1)).alias("n")
    )
    lent = store(lent, "lent")
    own = attach(rows.filter(F.col("depth") > F.col("h")), lent, ["base"], "n")
    own = own.withColumn("depth", F.col("depth") - F.col("h") + F.least("h", "lends"))
    columns = ("conv", "depth", "ha", "hb", "chars")
    heads = rows.filter(is_base & (F.col("depth") <= most)).select(F.col("base").alias("_base"), "depth", "ha", "hb", "chars")
    begun = convs.select("conv").withColumns({"h": first, "base": base}).join(heads, (F.col("base") == F.col("_base")) & (F.col("depth") <= F.col("h")))
    return begun.select(*columns).unionByName(own.select(*columns))


@query(
    """
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p,
    {'r': coalesce(role, ''), 'x': coalesce(text, '')} AS m
  FROM conversations
),
l AS (
  SELECT c, list(m ORDER BY p) AS s,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 6 AS h
  FROM t GROUP BY c
),
b AS (
  SELECT l.c, list_concat(coalesce(o.s[1:l.h], []), l.s[l.h + 1:]) AS s
  FROM l LEFT JOIN l AS o ON o.c = l.c - l.c % 100
),
n AS (
  SELECT s[1:d] AS k, d, min(c) AS first, count(*) AS n,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len(s) = d), '')) AS ends
  FROM b, unnest(range(len(s) + 1)) AS u(d) GROUP BY ALL
),
child AS (SELECT k[1:d - 1] AS k, count(*) AS children FROM n WHERE d > 0 GROUP BY ALL),
m AS (SELECT n.*, coalesce(children, 0) AS children FROM n LEFT JOIN child USING (k)),
below AS (
  SELECT k[1:e] AS k, count(*) FILTER (children = 0) AS leaves, sum(CASE WHEN d = 0 THEN 0 ELSE (n - 1) * length(k[-1].x) END) AS saved
  FROM m, unnest(range(d + 1)) AS v(e) GROUP BY ALL
)
SELECT m.first AS conv_id, m.d AS depth, p.first AS parent_conv_id, m.n AS n_convs, m.children AS n_children,
  leaves AS n_leaves, saved::BIGINT AS saved_tokens, m.ends AS ends_sha256
FROM m JOIN below USING (k) LEFT JOIN m AS p ON p.k = m.k[1:m.d - 1] AND p.d = m.d - 1"""
)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = materialise(sequences(table(spark, sf_dir, "conversations")), "sequences")
    convs = materialise(turns.select("conv").distinct(), "conversations")
    return nodes(materialise(rebuilt(turns, convs), "rebuilt"), convs)
