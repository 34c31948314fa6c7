"""Operator 12: the prefix trie of conversations by van Emde Boas recursion."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricegrain.llm.common import IdRanges, map_batches, materialize
from pricegrain.operators.ordered import numbered

#: Conversations of one group share the head of its first; so many turns a head can have.
GROUP, HEADS = 20, 4
#: Turns of a piece (a power of two) that one row holds; longer sequences are cut at half depth until pieces are that short.
PIECE = 16
#: Members of an end whose ids are joined at once.
ENDS_PER_RANGE = 4096
WORD = r"[^\x20\x09-\x0D]+"


def name(*parts: Column) -> Column:
    """The name of a sequence, from names of its parts."""
    return F.unhex(F.sha2(F.concat(*parts), 256))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), turn (its name), words: turns by turn, nulls first, equal ones by role and text; rows without a conv_id are left out."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("at"), role.alias("role"), text.alias("text"))
    named = rows.select("conv_id", "at", F.struct("role", F.sha2("text", 256)).alias("by"), name(F.encode(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), "UTF-8")).alias("turn"), F.size(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).cast("long").alias("words"))
    return numbered(named, ["conv_id"], ["at", "by"], "pos").select("conv_id", F.col("pos").cast("long").alias("pos"), "turn", "words")


def rebuilt(turns: DataFrame) -> DataFrame:
    """conv_id, length, depth, turn, words of every conversation as it is rebuilt; the root is its turn of depth 0."""
    lengths = materialize(turns.groupBy("conv_id").agg(F.max("pos").alias("own")), "conversations")
    base, head = F.col("conv_id") - F.col("conv_id") % GROUP, (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("long")
    convs = lengths.withColumns({"base": base, "head": head}).join(lengths.select(F.col("conv_id").alias("base"), F.col("own").alias("there")), "base", "left")
    convs = convs.withColumn("taken", F.least("head", F.coalesce("there", F.lit(0).cast("long")))).withColumn("length", F.col("taken") + F.greatest(F.lit(0).cast("long"), F.col("own") - F.col("head")))
    convs = materialize(convs.select("conv_id", "base", "head", "taken", "length"), "rebuilt")
    own = turns.join(convs, "conv_id").filter("pos > head").select("conv_id", "length", (F.col("pos") - F.col("head") + F.col("taken")).alias("depth"), "turn", "words")
    heads = turns.filter(F.col("pos") < HEADS).select(F.col("conv_id").alias("base"), F.col("pos").alias("depth"), "turn", "words")
    given = convs.filter("taken > 0").join(heads, "base").filter("depth <= taken").select("conv_id", "length", "depth", "turn", "words")
    root = convs.select("conv_id", "length", F.lit(0).cast("long").alias("depth"), F.unhex(F.lit("")).alias("turn"), F.lit(0).cast("long").alias("words"))
    return own.unionByName(given).unionByName(root)


def whole(turns: list[bytes]) -> bytes:
    """The name of a complete piece: that of its halves' names, so in turn down to single turns."""
    if len(turns) == 1:
        return turns[0]
    half = len(turns) // 2
    return hashlib.sha256(whole(turns[:half]) + whole(turns[half:])).digest()


def before_each(root: bytes, turns: list[bytes], width: int) -> list[bytes]:
    """For each turn of a piece of up to ``width`` turns the name of the prefix before it.

    The upper half hangs on the piece's root, the lower half on the name of the prefix that the cut leaves above it.
    """
    if width == 1 or not turns:
        return [root] * len(turns)
    half = width // 2
    out = before_each(root, turns[:half], half)
    return out + before_each(hashlib.sha256(root + whole(turns[:half])).digest(), turns[half:], half) if len(turns) > half else out


def climb(pieces: DataFrame, join: Callable[[Column, Column], Column], depth: int) -> list[DataFrame]:
    """Tables (conv_id, i, value) of pieces on ``depth`` levels, each of pairs of the one before."""
    levels = [pieces]
    odd = F.col("i") % 2 == 1
    for _ in range(depth - 1):
        pairs = levels[-1].groupBy("conv_id", F.floor(F.col("i") / 2).cast("long").alias("half")).agg(F.max(F.when(~odd, F.col("value"))).alias("l"), F.max(F.when(odd, F.col("value"))).alias("r"))
        levels.append(materialize(pairs.select("conv_id", F.col("half").alias("i"), join(F.col("l"), F.col("r")).alias("value")).filter("value is not null"), "pieces"))
    return levels


def descend(tops: DataFrame, levels: list[DataFrame], lower: Callable[[Column, Column], Column], upper: Callable[[Column, Column], Column]) -> DataFrame:
    """(conv_id, i, last, given) of all pieces: what each level gives its two halves, from what it was given and what they hold.

    ``tops`` has what each conversation is given as a whole and ``last``, the number of its last piece.
    """
    now = tops
    for k in range(len(levels) - 1, -1, -1):
        halves = levels[k].groupBy("conv_id", F.floor(F.col("i") / 2).cast("long").alias("i")).agg(F.max(F.when(F.col("i") % 2 == 0, F.col("value"))).alias("l"), F.max(F.when(F.col("i") % 2 == 1, F.col("value"))).alias("r"))
        both = now.join(halves, ["conv_id", "i"], "left")
        parts = F.array(F.struct((2 * F.col("i")).alias("i"), upper(F.col("given"), F.col("r")).alias("given")), F.struct((2 * F.col("i") + 1).alias("i"), lower(F.col("given"), F.col("l")).alias("given")))
        now = both.select("conv_id", "last", F.explode(parts).alias("p")).select("conv_id", "p.i", "last", "p.given").filter(F.shiftleft(F.col("i"), k) <= F.col("last"))
        now = materialize(now, "pieces")
    return now


def piece_of(depth: Column) -> Column:
    return F.floor(depth / PIECE).cast("long")


def named_prefixes(sequences: DataFrame) -> DataFrame:
    """conv_id, length, depth, node, parent, words: each prefix of a conversation with its name and that of the prefix before.

    A sequence is cut at half depth, the cut prefix is named, and the lower half hangs on that name; so in turn, all halves of
    a level at once. Names depend on a prefix alone, since cuts lie at the same depths in all conversations.
    """
    pieces = sequences.groupBy("conv_id", "length", piece_of(F.col("depth")).alias("i")).agg(F.sort_array(F.collect_list(F.struct("depth", "turn", "words"))).alias("turns"))
    pieces = materialize(pieces.select("conv_id", "length", "i", F.col("turns.turn").alias("turns"), F.col("turns.words").alias("words")), "sequences")
    last, nothing = piece_of(F.col("length")), F.unhex(F.lit(""))
    long = pieces.filter(last > 0)
    depth = int(long.agg(F.max(last)).first()[0] or 0).bit_length()
    complete = map_batches(long.filter(F.size("turns") == PIECE).select("conv_id", "i", "turns"), "conv_id long, i long, value binary", lambda batches: ({"conv_id": b["conv_id"], "i": b["i"], "value": [whole(t) for t in b["turns"]]} for b in batches))
    levels = climb(materialize(complete, "pieces"), name, depth) if depth else []
    roots = descend(long.filter("i = 0").select("conv_id", "i", last.alias("last"), nothing.alias("given")), levels, lower=lambda given, left: name(given, left), upper=lambda given, _: given)
    rows = pieces.join(roots.select("conv_id", "i", F.col("given").alias("root")), ["conv_id", "i"], "left").select("conv_id", "length", "i", F.coalesce("root", nothing).alias("root"), "turns", "words")

    def nodes(batches):
        for b in batches:
            named = [[hashlib.sha256(x + b"/" + t).digest() for x, t in zip(before_each(root, turns, PIECE), turns, strict=True)] for root, turns in zip(b["root"], b["turns"], strict=True)]
            yield {k: b[k] for k in ("conv_id", "length", "i", "words")} | {"nodes": named}

    rows = materialize(map_batches(rows, "conv_id long, length long, i long, words array<long>, nodes array<binary>", nodes), "named")
    ends = rows.filter(last > 0).select("conv_id", (F.col("i") + 1).alias("i"), F.element_at("nodes", -1).alias("above"))
    linked = rows.join(ends, ["conv_id", "i"], "left").withColumn("parents", F.slice(F.array_insert("nodes", 1, F.col("above")), 1, F.size("nodes")))
    linked = linked.select("conv_id", "length", "i", F.posexplode(F.arrays_zip("parents", "nodes", "words")).alias("k", "t"))
    return linked.select("conv_id", "length", (F.col("i") * PIECE + F.col("k")).alias("depth"), F.col("t.nodes").alias("node"), F.col("t.parents").alias("parent"), F.col("t.words").alias("words"))


def totals(rows: DataFrame, own: DataFrame, names: list[str]) -> DataFrame:
    """Sums of ``names`` over each node's subtree.

    A node counts once, with its smallest member (``own``: conv_id, depth, names). What a conversation holds at a depth and below
    is summed in its piece, what its lower pieces hold is grafted upward along the recursion, and the members'
    sums are the subtree's.
    """
    value = F.struct(*[F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in names])
    both = rows.join(own, ["conv_id", "depth"], "left").select("conv_id", "length", "depth", "node", value.alias("v"))
    pieces = both.groupBy("conv_id", "length", piece_of(F.col("depth")).alias("i")).agg(F.sort_array(F.collect_list(F.struct("depth", "node", "v"))).alias("turns"))
    pieces = materialize(pieces, "pieces")
    add = lambda a, b: F.struct(*[(a[n] + b[n]).alias(n) for n in names])
    none = F.struct(*[F.lit(0).cast("long").alias(n) for n in names])
    field = lambda n: lambda a, t: a + t["v"][n]
    summed = lambda turns: F.struct(*[F.aggregate(turns, F.lit(0).cast("long"), field(n)).alias(n) for n in names])
    last = piece_of(F.col("length"))
    long = pieces.filter(last > 0)
    depth = int(long.agg(F.max(last)).first()[0] or 0).bit_length()
    levels = climb(materialize(long.select("conv_id", "i", summed(F.col("turns")).alias("value")), "pieces"), lambda left, right: F.when(right.isNull(), left).otherwise(add(left, right)), depth) if depth else []
    below = descend(long.filter("i = 0").select("conv_id", "i", last.alias("last"), none.alias("given")), levels, lower=lambda given, _: given, upper=lambda given, right: F.when(right.isNull(), given).otherwise(add(given, right)))
    rest = pieces.join(below.select("conv_id", "i", "given"), ["conv_id", "i"], "left").withColumn("given", F.coalesce("given", none))
    tails = F.transform("turns", lambda t, k: F.struct(t["node"].alias("node"), add(F.col("given"), summed(F.slice("turns", k + 1, F.size("turns")))).alias("v")))
    return rest.select(F.explode(tails).alias("t")).groupBy("t.node").agg(*[F.sum(f"t.v.{n}").alias(n) for n in names])


def end_digests(rows: DataFrame) -> DataFrame:
    """node, ends_sha256 of the nodes at which conversations end: ids are joined in ranges, a node's ranges are digested in order, one at a time."""
    ends = materialize(rows.filter("depth = length").select("node", "conv_id"), "ends")
    ranges = IdRanges(ends, "conv_id", ENDS_PER_RANGE)
    joined = ends.groupBy("node", ranges.of(F.col("conv_id")).alias("range")).agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    joined = joined.repartition("node").sortWithinPartitions("node", "range")

    def digest(batches):
        node, state = None, None
        for batch in batches:
            done = {"node": [], "ends_sha256": []}
            for n, ids in zip(batch["node"], batch["ids"], strict=True):
                if n == node:
                    state.update(b",")
                else:
                    if state is not None:
                        done["node"].append(node)
                        done["ends_sha256"].append(state.hexdigest())
                    node, state = n, hashlib.sha256()
                state.update(ids.encode())
            yield done
        if state is not None:
            yield {"node": [node], "ends_sha256": [state.hexdigest()]}

    return map_batches(joined.select("node", "ids"), "node binary, ends_sha256 string", digest)


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """Nodes of the trie of rebuilt conversations, which share the head of their group's first one.

    Returns conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256. Rows without
    a conv_id are left out; null roles and texts are empty; turns of one number, nulls first, go by role and
    text's digest; repeated rows are turns of their own. No rows give no nodes, not even a root. Texts of any length are digested and
    counted whole and go no further; conversations of any length are cut into pieces.
    """
    rows = materialize(named_prefixes(rebuilt(ordered_turns(conversations))), "prefixes")
    nodes = rows.groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("depth").alias("depth"), F.min("parent").alias("parent"), F.max("words").alias("words"))
    nodes = materialize(nodes, "nodes")
    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = materialize(nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "nodes")
    own = nodes.select("conv_id", "depth", (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"))
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(above, "parent", "left").join(totals(rows, own, ["n_leaves", "saved_tokens"]), "node").join(end_digests(rows), "node", "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
