"""Prefix trie of conversations by the recursion of van Emde Boas.

1. Sequences of turns (hashes of role and text, with the text's length) are cut at half
   of their height.  Each cut prefix gets a name, a 128-bit hash chained over its turns.
2. The upper halves, of which equal ones fold to one, are sequences of the upper trie; the
   rest of each sequence, hung below the name of its cut, is one of the lower forests.
   Both go on in one table, so all parts of the recursion are cut side by side and it is
   as many steps deep as the binary logarithm of the longest sequence.  At height one
   each part is a node.
3. On the way back the totals of each lower forest are grafted to the nodes of the
   upper part that lie above its cut.

Texts never move, only 20 bytes a turn.  Equal prefixes are counted before each
shuffle, so a first turn or a whole conversation that many share costs one row a
task; parents with very many children are joined by broadcast.  The one thing that
streams through a single task is the digest of a node's ids, since SHA-256 has no
parallel form: eight bytes an id, constant memory.

Defined cases: rows without conv_id are left out; turns are ordered by turn (null
first), ties by role, then by a hash of the text; a null role or text is empty; rows
that repeat are turns of their own; one conversation is one row of 20 bytes a turn;
other columns are not looked at; no conversations give no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.frames import freeze, parallelism, small_batches

ROOT = bytes(16)
KEY, LEN = 16, 4
GROUP, SHARED = 100, 6      # the contract's rebuilding: base conversation, and modulus of h
_SEGMENT = "end binary, top binary, lo int, keys binary, lens binary, conv_id long, n long"


# ---------------------------------------------------------------------- sequences
def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as (a, b, n), n the text's code points."""
    small_batches(conversations.sparkSession)
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        blank("role").alias("role"), blank("text").alias("text")).where("conv_id IS NOT NULL")
    turns = rows.select("conv_id", F.struct(
        "turn", "role", F.xxhash64("role", "text").alias("a"), F.xxhash64(F.lit(3), "role", "text").alias("b"),
        F.char_length("text").alias("n")).alias("s"))
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("s")).alias("s")) \
        .select("conv_id", F.expr("transform(s, x -> named_struct('a', x.a, 'b', x.b, 'n', x.n))").alias("turns"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """The contract's sequences: h turns of conversation c - c % 100, then c's own after its first h."""
    own = freeze(sequences(conversations), "turns")
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(SHARED)).cast("int")
    heads = own.where(f"conv_id % {GROUP} = 0").select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, SHARED - 1).alias("head"))
    met = own.withColumn("h", h).join(heads, F.expr(f"conv_id - conv_id % {GROUP} = base"), "left")
    return met.selectExpr("conv_id", """concat(slice(coalesce(head, slice(turns, 1, 0)), 1, h),
                                               slice(turns, h + 1, greatest(size(turns) - h, 0))) AS turns""")


# ---------------------------------------------------------------- cuts, downwards
def _names(top: bytes, keys: bytes) -> Iterator[bytes]:
    """The names of the prefixes that go on from ``top`` turn by turn."""
    for i in range(0, len(keys), KEY):
        top = hashlib.blake2b(top + keys[i:i + KEY], digest_size=16).digest()
        yield top


def _name(top: bytes, keys: bytes) -> bytes:
    for top in _names(top, keys):  # noqa: B007, B020
        pass
    return top


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each sequence as one segment from the root, named by its end."""
    for b in batches:
        turns = b.column("turns")
        at, flat = turns.offsets.to_numpy(), turns.values
        key = np.stack([flat.field(0).to_numpy(zero_copy_only=False),
                        flat.field(1).to_numpy(zero_copy_only=False)], axis=1).astype("<i8") \
            if len(flat) else np.zeros((0, 2), "<i8")
        n = flat.field(2).to_numpy(zero_copy_only=False).astype("<i4")
        keys = [key[i:j].tobytes() for i, j in zip(at[:-1], at[1:])]
        lens = [n[i:j].tobytes() for i, j in zip(at[:-1], at[1:])]
        yield pa.record_batch([pa.array([_name(ROOT, k) for k in keys], pa.binary()), pa.array(keys, pa.binary()),
                               pa.array(lens, pa.binary()), b.column("conv_id")],
                              names=["end", "keys", "lens", "conv_id"])


def _cut(half: int):
    """A segment higher than ``half`` becomes its upper part and what hangs below the cut."""
    types = [pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.bool_()]

    def run(batches):
        for b in batches:
            out = []
            for end, top, lo, keys, lens, conv, n in zip(*(c.to_pylist() for c in b.columns)):
                upper = keys[:KEY * half]
                cut = end if len(keys) == len(upper) else _name(top, upper)
                out.append((cut, top, lo, upper, lens[:LEN * half], conv, n, True))
                if len(keys) > len(upper):
                    out.append((end, cut, lo + half, keys[KEY * half:], lens[LEN * half:], conv, n, False))
            cols = zip(*out) if out else [[]] * len(types)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, types)],
                                  names=[*(x.split()[0] for x in _SEGMENT.split(", ")), "upper"])
    return run


def _folded(segments: DataFrame) -> DataFrame:
    """Equal segments as one: the smallest conversation, and how many there are."""
    return segments.groupBy("end", "lo").agg(
        F.first("top").alias("top"), F.first("keys").alias("keys"), F.first("lens").alias("lens"),
        F.min("conv_id").alias("conv_id"), F.sum("n").alias("n")) \
        .select("end", "top", "lo", "keys", "lens", "conv_id", "n")


def _levels(segments: DataFrame) -> dict[int, DataFrame]:
    """Height -> the segments that are left when all are cut to it; at 1 they are the nodes."""
    top = segments.agg(F.max(F.length("keys") / KEY).cast("int").alias("h")).first()["h"]
    half = 1 << max(0, (top or 1) - 1).bit_length()
    levels = {half: segments}
    while half > 1:
        half //= 2
        cut = freeze(levels[2 * half].mapInArrow(_cut(half), _SEGMENT + ", upper boolean"), "cuts")
        # what hangs below different cuts, or differs below one, is different: only upper parts fold
        levels[half] = freeze(_folded(cut.where("upper").drop("upper"))
                              .unionByName(cut.where("NOT upper").drop("upper")), "segments")
    return levels


# --------------------------------------------------------------- totals, upwards
def _above(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each node on an upper segment, with the totals of the forest below its end."""
    for b in batches:
        names, tops, depths, rows = [], [], [], []
        for i, (top, lo, keys) in enumerate(zip(*(b.column(c).to_pylist() for c in ("top", "lo", "keys")))):
            for d, name in enumerate(_names(top, keys), 1):
                names.append(name)
                tops.append(top)
                depths.append(lo + d)
                rows.append(i)
                top = name
        rows = pa.array(rows, pa.int32())
        yield pa.record_batch([pa.array(names, pa.binary()), pa.array(tops, pa.binary()), pa.array(depths, pa.int32()),
                               b.column("leaves").take(rows), b.column("saved").take(rows)],
                              names=["name", "top", "depth", "leaves", "saved"])


def _totals(nodes: DataFrame, levels: dict[int, DataFrame]) -> DataFrame:
    """(name, top, depth, leaves, saved), to be summed by name: own values, and what is grafted."""
    cols = ["name", "top", "depth", "leaves", "saved"]
    known = nodes.select(*cols)
    half = 1
    while 2 * half in levels:
        # what hangs at cuts of this height, whole: all lower cuts have been grafted to it
        below = known.where(f"(depth - 1) % {2 * half} = {half}").groupBy(F.col("top").alias("cut")).agg(
            F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        upper = levels[half].where(f"lo % {2 * half} = 0 AND length(keys) = {KEY * half}")
        grafts = below.join(upper, F.col("cut") == F.col("end")).select("top", "lo", "keys", "leaves", "saved") \
            .mapInArrow(_above, "name binary, top binary, depth int, leaves long, saved long")
        known = known.unionByName(freeze(grafts.groupBy("name", "top", "depth").agg(
            F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")), "grafts"))
        half *= 2
    return known


# -------------------------------------------------------------------------- ends
def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each end's ids, which come sorted: ids stream by, one digest is open."""
    last, sha, done = None, None, []
    for b in batches:
        for end, conv in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if end != last:
                if sha:
                    done.append((last, sha.hexdigest()))
                last, sha = end, hashlib.sha256(str(conv).encode())
            else:
                sha.update(b",%d" % conv)
        if done:
            yield _pairs(done)
            done = []
    if sha:
        yield _pairs([(last, sha.hexdigest())])


def _pairs(rows) -> pa.RecordBatch:
    end, sha = zip(*rows)
    return pa.record_batch([pa.array(end, pa.binary()), pa.array(sha)], names=["_end", "sha"])


def prefix_trie(seqs: DataFrame) -> DataFrame:
    """The trie's nodes from (conv_id, turns): one row for each distinct prefix, the empty one too.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)
    """
    parts = parallelism(seqs)
    whole = freeze(seqs.mapInArrow(_whole, "end binary, keys binary, lens binary, conv_id long"), "sequences")
    segments = freeze(_folded(whole.where("length(keys) > 0").select(
        "end", F.lit(ROOT).alias("top"), F.lit(0).alias("lo"), "keys", "lens", "conv_id",
        F.lit(1).cast("long").alias("n"))), "segments")
    levels = _levels(segments)
    # four bytes, the lowest first
    chars = F.expr(
        "cast(conv(concat(substr(hex(lens), 7, 2), substr(hex(lens), 5, 2), substr(hex(lens), 3, 2),"
        " substr(hex(lens), 1, 2)), 16, 10) AS long)")
    nodes = levels[1].select(F.col("end").alias("name"), "top", (F.col("lo") + 1).alias("depth"), "conv_id", "n",
                             chars.alias("chars"))
    kids = freeze(nodes.groupBy(F.col("top").alias("_top")).agg(F.count("*").alias("n_children")), "children")
    nodes = freeze(nodes.join(kids, F.col("name") == F.col("_top"), "left").select(
        "name", "top", "depth", "conv_id", F.col("n").alias("n_convs"),
        F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("leaves"),
        ((F.col("n") - 1) * F.col("chars")).alias("saved")), "nodes")
    totals = freeze(_totals(nodes, levels).groupBy("name", "top").agg(
        F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens")), "totals")
    # parents with many children: at most 2 parts of them
    many = max(1000, nodes.count() // (2 * parts))
    crowded = F.broadcast(nodes.where(F.col("n_children") > many).select(
        F.col("name").alias("_parent"), F.col("conv_id").alias("parent_conv_id")))
    others = nodes.where(F.col("n_children").between(1, many)).select(
        F.col("name").alias("_parent"), F.col("conv_id").alias("parent_conv_id"))
    whose = F.col("top") == F.col("_parent")
    first = whole.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).first()
    below = totals.where(F.col("top") == F.lit(ROOT)).agg(
        F.count("*"), F.sum("n_leaves"), F.sum("saved_tokens")).first()
    start = F.lit(first["conv_id"]).cast("long")
    inner = nodes.where(F.col("top") != F.lit(ROOT))
    named = nodes.where(F.col("top") == F.lit(ROOT)).withColumn("parent_conv_id", start) \
        .unionByName(inner.join(crowded, whose).drop("_parent")) \
        .unionByName(inner.join(crowded, whose, "left_anti").join(others, whose).drop("_parent"))
    own = totals.select(F.col("name").alias("_name"), "n_leaves", "saved_tokens")
    cols = ["name", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    rows = named.join(own, F.col("name") == F.col("_name")).select(*cols)
    root = seqs.sparkSession.range(1 if first["n_convs"] else 0).select(
        F.lit(ROOT).alias("name"), start.alias("conv_id"), F.lit(0).alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"), F.lit(first["n_convs"]).alias("n_convs"),
        F.lit(below[0]).alias("n_children"), F.lit(below[1] or 1).alias("n_leaves"),
        F.lit(below[2] or 0).alias("saved_tokens"))
    ends = whole.select("end", "conv_id").repartition(parts, "end").sortWithinPartitions("end", "conv_id") \
        .mapInArrow(_digests, "_end binary, sha string")
    out = rows.unionByName(root).join(ends, F.col("name") == F.col("_end"), "left")
    return out.select(*[F.col(c).cast("long").alias(c) for c in cols[1:]],
                      F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
