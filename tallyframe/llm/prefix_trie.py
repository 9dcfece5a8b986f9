"""Prefix trie of conversations by van Emde Boas recursion.

A conversation is a sequence of turns (role, text). The nodes of the trie are the distinct prefixes; the name of a node
is the smallest conversation that starts with it, so (depth, name) identifies a node.

**Down.** The depths below 2^K form one problem. A problem of height 2^k is cut at half depth: the sequences that reach
the cut are grouped by their root and by the hash of their upper half, and each group gets its name. The upper problem
goes on with one sequence per group (cut off there, standing for all of them), the lower ones with the sequences
that go past the cut, under the named prefix as their root. All problems of one height are solved by the same Spark
job, so a trie of depth d takes log2(d) rounds. A sequence that has been cut off at depth d meets the root just above
it in the end: these rows are the nodes, with their parents.

**Up and down again.** Totals of a problem are the totals of its upper problem plus those of the lower problems grafted at
the cut, added up by root; then each cut node gets what hangs below it, first inside the problem, then below its end.

Halves are compared by 128 bits: turns are hashed together with their place, and a half is the exclusive or of its
turns. Texts never travel; a row of the recursion has under 100 bytes. Groups are summed before the shuffle, and the
ranks of the turns of one conversation come from a global sort with counts per range, so a conversation with a third
of all turns, or a prefix with a third of all conversations, does not meet in one task. Only the identifiers that end at
one node pass through one task, as strings in order, because SHA-256 reads them one after the other; the task streams
them and holds about a megabyte.

Defined cases: a null role or text is empty; null turns come first; rows of one conversation and turn are ordered by role,
then by a hash of the text (equal rows are interchangeable and all count); rows without a conv_id belong to no
conversation; a text of any length counts whole; an empty table has no node; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import number_rows, prepare, running_total, store

# the shared head of a conversation has fewer turns than this
HEADS = 6
# identifiers per piece of the list that is hashed
PIECE = 1 << 16


def _turn_hash(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "role", "text")


def turns_in_order(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, a, b, size``: place, 128-bit hash and code points of every turn."""
    rows = conversations.where("conv_id is not null").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    rows = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", _turn_hash(1).alias("a"), _turn_hash(2).alias("b"),
        F.char_length("text").cast("long").alias("size"), F.lit(1).alias("one"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("a"), F.col("b")]
    placed = running_total(number_rows(rows, order, "trie-turns"), "one", by=["conv_id"], out="pos")
    return placed.select("conv_id", F.col("pos").cast("long").alias("pos"), "a", "b", "size")


def head_turns(conv: Column) -> Column:
    """How many first turns a conversation takes from the first one of its hundred."""
    return F.crc32(conv.cast("string").cast("binary")) % HEADS


def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations ``conv_id, n`` and their turns ``conv_id, pos, a, b, size``, heads shared by each hundred."""
    sizes = turns.groupBy("conv_id").agg((F.max("pos") + 1).alias("own"))
    convs = sizes.select("conv_id", "own", (F.col("conv_id") - F.col("conv_id") % 100).alias("first"), head_turns(F.col("conv_id")).alias("h"))
    firsts = sizes.select(F.col("conv_id").alias("first"), F.col("own").alias("n_first"))
    convs = convs.join(firsts, "first", "left").withColumn("head", F.least("h", F.coalesce("n_first", F.lit(0))))
    convs = convs.withColumn("n", F.col("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    convs = store(convs.select("conv_id", "first", "h", "head", "n"), "trie-conversations")
    heads = turns.where((F.col("pos") < HEADS) & (F.col("conv_id") % 100 == 0)).withColumnRenamed("conv_id", "first")
    shared = heads.join(convs, "first").where("pos < h").select("conv_id", "pos", "a", "b", "size")
    # h needs no join here: only the number of turns the head really has
    tails = turns.where(F.col("pos") >= head_turns(F.col("conv_id"))).join(convs.select("conv_id", "h", "head"), "conv_id")
    tails = tails.select("conv_id", (F.col("pos") - F.col("h") + F.col("head")).alias("pos"), "a", "b", "size")
    return convs.select("conv_id", "n"), store(shared.unionByName(tails), "trie-rebuilt")


def _xor_hash(seed: int) -> Column:
    return F.bit_xor(F.xxhash64(F.lit(seed), "pos", "a", "b"))


def _halves(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """``k, j, conv_id, a, b``: the hash of every whole upper half, turns [j, j + 1) * 2^k with even j."""
    rows = turns.join(convs, "conv_id")
    rows = rows.withColumn("k", F.explode(F.sequence(F.lit(0), F.floor(F.log2("n")).cast("int"))))
    rows = rows.withColumn("j", F.expr("shiftright(pos, k)")).where("j % 2 = 0 and shiftleft(j + 1, k) <= n")
    return rows.groupBy("k", "j", "conv_id").agg(_xor_hash(3).alias("a"), _xor_hash(4).alias("b"))


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


_LONGS = [(c, pa.int64()) for c in ("n", "a", "b", "conv_id", "weight")]


def _pieces(size: int):
    """Neighbouring rows of one sequence become pieces of its list of identifiers."""
    schema = pa.schema([*_LONGS, ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, out = None, [], []
        for batch in batches:
            for n, a, b, conv in zip(*(batch.column(c).to_pylist() for c in ("n", "a", "b", "conv_id")), strict=True):
                if (n, a, b) != key or len(ids) >= size:
                    if ids:
                        out.append((*key, ids[0], len(ids), ",".join(map(str, ids)).encode()))
                    key, ids = (n, a, b), []
                ids.append(conv)
            if out:
                yield _table(out, schema)
                out = []
        if ids:
            yield _table([(*key, ids[0], len(ids), ",".join(map(str, ids)).encode())], schema)

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per sequence from its pieces in order: smallest member, members, SHA-256 of the list."""
    schema = pa.schema([*_LONGS, ("ends_sha256", pa.string())])
    key, low, size, digest, out = None, None, 0, None, []
    for batch in batches:
        for n, a, b, first, count, ids in zip(*(batch.column(c).to_pylist() for c in ("n", "a", "b", "conv_id", "weight", "ids")), strict=True):
            if (n, a, b) != key:
                if key is not None:
                    out.append((*key, low, size, digest.hexdigest()))
                key, low, size, digest = (n, a, b), first, 0, hashlib.sha256()
            if size:
                digest.update(b",")
            digest.update(ids)
            size += count
        if out:
            yield _table(out, schema)
            out = []
    if key is not None:
        yield _table([(*key, low, size, digest.hexdigest())], schema)


def _sequences(convs: DataFrame, turns: DataFrame, piece: int) -> DataFrame:
    """Distinct sequences ``n, conv_id, weight, ends_sha256``; equal ones stand together under the smallest member."""
    whole = turns.groupBy("conv_id").agg(_xor_hash(5).alias("a"), _xor_hash(6).alias("b"))
    zero = F.lit(0).cast("long")
    named = convs.join(whole, "conv_id", "left").select(
        F.col("n").cast("long").alias("n"), F.coalesce("a", zero).alias("a"), F.coalesce("b", zero).alias("b"), "conv_id"
    )
    order = ["n", "a", "b", "conv_id"]
    pieces = named.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _pieces(piece), "n long, a long, b long, conv_id long, weight long, ids binary"
    )
    return pieces.repartition("n", "a", "b").sortWithinPartitions(*order).mapInArrow(
        _digests, "n long, a long, b long, conv_id long, weight long, ends_sha256 string"
    ).drop("a", "b")


def _add(a: DataFrame, b: DataFrame, by: list[str]) -> DataFrame:
    return a.unionByName(b).groupBy(*by).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def prefix_trie(conversations: DataFrame, piece: int = PIECE) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``,
    ``ends_sha256``.
    """
    spark = prepare(conversations.sparkSession)
    convs, turns = rebuild(store(turns_in_order(conversations), "trie-places"))
    sequences = store(_sequences(convs, turns, piece), "trie-sequences")
    halves = store(_halves(convs, turns), "trie-halves")
    top = convs.agg(F.max("n"), F.min("conv_id"), F.count("*")).first()
    if not top[2]:
        return spark.createDataFrame([], _SCHEMA)
    levels = int(top[0] or 0).bit_length()
    root = F.lit(top[1]).cast("long")

    # down: name the cut prefixes of all problems of one height, from the whole trie to single depths
    items = sequences.where("n > 0").select("conv_id", F.lit(0).cast("long").alias("j"), root.alias("root"), "weight", "n", F.lit(True).alias("ends"))
    links, stops = {}, []
    for k in range(levels, 0, -1):
        mid = F.expr(f"(2 * j + 1) * {1 << (k - 1)}L")
        items = items.withColumn("mid", mid)
        reach = items.where("n >= mid").join(halves.where(F.col("k") == k - 1).select("conv_id", F.expr("j div 2").alias("j"), "a", "b"), ["conv_id", "j"])
        groups = reach.groupBy("j", "root", "a", "b").agg(F.min("conv_id").alias("name"))
        links[k] = link = store(reach.join(groups, ["j", "root", "a", "b"]).drop("a", "b"), f"trie-links-{k}")
        stops.append(link.where("ends and n = mid").select(F.col("conv_id").alias("sequence"), F.col("mid").alias("depth"), F.col("name").alias("conv_id")))
        upper = link.groupBy("j", "root", "name", "mid").agg(F.sum("weight").alias("weight")).select(
            F.col("name").alias("conv_id"), (F.col("j") * 2).alias("j"), "root", "weight", F.col("mid").alias("n"), F.lit(False).alias("ends")
        )
        lower = link.where("n > mid").select("conv_id", (F.col("j") * 2 + 1).alias("j"), F.col("name").alias("root"), "weight", "n", "ends")
        short = items.where("n < mid").select("conv_id", (F.col("j") * 2).alias("j"), "root", "weight", "n", "ends")
        items = store(upper.unionByName(lower).unionByName(short), f"trie-items-{k - 1}")

    # nodes: every depth is the cut of one height, so each node is left as one sequence under its parent
    nodes = items.select("conv_id", (F.col("j") + 1).alias("depth"), F.col("root").alias("parent"), F.col("weight").alias("n_convs"))
    last = turns.select("conv_id", (F.col("pos") + 1).alias("depth"), "size")
    children = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("conv_id")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(last, ["conv_id", "depth"]).join(children, ["conv_id", "depth"], "left").select(
        "conv_id", "depth", "parent", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("size")).alias("saving"),
    )
    nodes = store(nodes, "trie-nodes")

    # up: totals below the root of every problem, a lower problem grafted onto its cut node
    by = ["j", "root"]
    below = {0: store(nodes.groupBy((F.col("depth") - 1).alias("j"), F.col("parent").alias("root")).agg(F.sum("leaf").alias("leaves"), F.sum("saving").alias("saved")), "trie-below-0")}
    cuts = {k: links[k].select("j", "root", "name").distinct() for k in links}
    for k in range(1, levels):
        lower = below[k - 1].where("j % 2 = 1").select(F.expr("j div 2").alias("j"), F.col("root").alias("name"), "leaves", "saved")
        upper = below[k - 1].where("j % 2 = 0").select(F.expr("j div 2").alias("j"), "root", "leaves", "saved")
        below[k] = store(_add(upper, cuts[k].join(lower, ["j", "name"]).select(*by, "leaves", "saved"), by), f"trie-below-{k}")

    # down again: a cut node gets its lower problem and what hangs below the end of its own problem
    zero = F.lit(0).cast("long")
    hanging = []
    for k in range(levels, 0, -1):
        lower = below[k - 1].where("j % 2 = 1").select(((F.col("j") - 1) * (1 << (k - 1)) + (1 << (k - 1))).alias("depth"), F.col("root").alias("conv_id"), "leaves", "saved")
        if hanging:
            done = reduce(DataFrame.unionByName, hanging)
            ended = links[k].where("not ends and n > mid").select("conv_id", F.col("n").alias("depth"), F.col("mid").alias("at"), "name")
            passed = ended.join(done, ["conv_id", "depth"]).select(F.col("at").alias("depth"), F.col("name").alias("conv_id"), "leaves", "saved")
            lower = _add(lower, passed, ["depth", "conv_id"])
        hanging.append(store(lower, f"trie-hanging-{k}"))
    stop_rows = sequences.select(F.col("conv_id").alias("sequence"), "ends_sha256")
    total = nodes
    if hanging:
        total = nodes.join(reduce(DataFrame.unionByName, hanging), ["conv_id", "depth"], "left")
        ends = reduce(DataFrame.unionByName, stops).join(stop_rows, "sequence").drop("sequence")
        total = total.join(ends, ["conv_id", "depth"], "left").select(
            "conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
            (F.col("leaf") + F.coalesce("leaves", zero)).alias("n_leaves"), (F.col("saving") + F.coalesce("saved", zero)).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(_NOTHING)).alias("ends_sha256"),
        )
    else:
        total = spark.createDataFrame([], _SCHEMA)
    whole = nodes.agg(
        F.coalesce(F.sum(F.when(F.col("depth") == 1, 1)), zero).alias("n_children"), F.coalesce(F.sum("leaf"), zero).alias("n_leaves"),
        F.coalesce(F.sum("saving"), zero).alias("saved_tokens"),
    )
    # the root: at most one sequence has no turn
    empty = sequences.where("n = 0").agg(F.max("ends_sha256").alias("ends_sha256"))
    both = whole.withColumn("one", F.lit(1)).join(empty.withColumn("one", F.lit(1)), "one")
    top_row = both.select(
        root.alias("conv_id"), zero.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), F.lit(top[2]).cast("long").alias("n_convs"),
        "n_children", F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")).cast("long").alias("n_leaves"), "saved_tokens",
        F.coalesce("ends_sha256", F.lit(_NOTHING)).alias("ends_sha256"),
    )
    return total.unionByName(top_row)


_NOTHING = hashlib.sha256(b"").hexdigest()
_SCHEMA = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)
